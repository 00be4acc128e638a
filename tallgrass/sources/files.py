"""Files of the archive: raw API pages, query results, transcripts, tables; and writing them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, StructField, StructType

from tallgrass.operators.archive import RAW_SCHEMA
from tallgrass.operators.export import Document
from tallgrass.sources import versioned

BINDING = "struct<value:string>"
PARTICIPANTS = f"results struct<bindings:array<struct<speaker:{BINDING},speakerLabel:{BINDING},date:{BINDING}>>>"
PEOPLE_FIELDS = ("speaker", "speakerLabel", "speakerDescription", "svArticle", "enArticle", "gender", "genderLabel", "birthDate", "birthPrecision", "deathDate", "deathPrecision", "citizenship", "citizenshipLabel", "occupation", "occupationLabel")
SEGMENT = "struct<start:double,end:double,text:string>"

# The tables' columns, in the order in which they are written.
EPISODES = "sr_episode_id bigint, sr_audio_id bigint, source_title string, date string, year int, program_type string, episode_url string, mp3_url string, length_seconds bigint, audio_file_size_bytes bigint, image_url string, image_credit string, short_summary string, is_listeners_host boolean, episode_speakers array<string>, speaker_ages array<int>"
PERSON = "wikidata_label string, wikidata_description string, wikipedia_url string, gender string, gender_id string, birth_date string, death_date string, citizenships array<string>, citizenship_ids array<string>, occupations array<string>, occupation_ids array<string>"
SPEAKERS = f"wikidata_id string, speaker string, sr_names array<string>, episode_count int, episode_ids array<bigint>, ages_at_episodes array<int>, {PERSON}"
APPEARANCES = f"{EPISODES}, speaker_index int, speaker_appearance_id string, speaker string, wikidata_id string"
MUSIC = "sr_episode_id bigint, track_number int, title string, artist string, composer string, lyricist string, album string, record_label string, is_theme_song boolean"


def episodes_json(spark: SparkSession, path: str) -> DataFrame:
    """Raw episode records from saved API pages; unreadable pages give no rows."""
    pages = spark.read.schema(f"episodes array<struct<{RAW_SCHEMA.replace(' bigint', ':bigint').replace(' string', ':string').replace('downloadpodfile ', 'downloadpodfile:').replace('listenpodfile ', 'listenpodfile:')}>>").json(path, multiLine=True, mode="PERMISSIVE")
    return pages.select(F.explode("episodes").alias("e")).select("e.*")


def participants_json(spark: SparkSession, path: str) -> DataFrame:
    """``date``, ``wikidata_id``, ``label`` of season participants."""
    rows = spark.read.schema(PARTICIPANTS).json(path, multiLine=True, mode="PERMISSIVE").select(F.explode("results.bindings").alias("b"))
    return rows.select(F.col("b.date.value").alias("date"), F.element_at(F.split("b.speaker.value", "/"), -1).alias("wikidata_id"), F.col("b.speakerLabel.value").alias("label"))


def people_json(spark: SparkSession, path: str) -> DataFrame:
    """Flat rows of speaker metadata with their place ``pos``, as ``archive.merge_people`` wants them."""
    schema = "results struct<bindings:array<struct<" + ",".join(f"{f}:{BINDING}" for f in PEOPLE_FIELDS) + ">>>"
    rows = spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE").select(F.posexplode("results.bindings").alias("pos", "b"))
    return rows.select("pos", *[F.col(f"b.{f}.value").alias(f) for f in PEOPLE_FIELDS])


def transcripts_json(spark: SparkSession, folder: str, limit: int | None = None, metadata: str = "sommar_i_parquet") -> DataFrame:
    """Segments of ``<id>.json`` files: ``sr_episode_id``, ``segment_index``, ``start``, ``end``, ``text``.

    Files whose name is not a number and files that cannot be read are left out; with ``limit`` only the first that many by
    number are read. The id in the object ``metadata`` goes before that of the file's name.
    """
    schema = f"segments array<{SEGMENT}>, {metadata} struct<sr_episode_id:bigint>"
    paths: str | list[str] = f"{folder}/*.json"
    if limit is not None:
        # Only the names are listed, and the first ``limit`` by number are opened.
        fs, place, system = versioned.files_of(spark, folder)
        names = [f.getPath().getName() for f in system.listStatus(place)]
        paths = [f"{folder}/{n}" for n in sorted((n for n in names if re.fullmatch(r"\d+\.json", n)), key=lambda n: (int(n[:-5]), n))[:limit]]
        if not paths:
            return spark.createDataFrame([], "sr_episode_id bigint, segment_index int, start double, end double, text string")
    rows = spark.read.schema(schema).json(paths, multiLine=True, mode="PERMISSIVE").withColumn("__stem", F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1))
    rows = rows.filter("__stem <> ''")
    rows = rows.filter("segments is not null")
    ident = F.coalesce(f"{metadata}.sr_episode_id", F.col("__stem").cast("bigint"))
    return rows.select(ident.alias("sr_episode_id"), F.posexplode("segments").alias("segment_index", "s")).select("sr_episode_id", "segment_index", "s.*")


def lookup(spark: SparkSession, path: str, ident: int, needed: str = "mp3_url") -> dict:
    """One row by its id, read with a pushed-down filter; an error where it is missing or ``needed`` is empty."""
    rows = spark.read.parquet(path).filter(F.col("sr_episode_id") == ident).limit(1).collect()
    if not rows:
        raise KeyError(f"no episode {ident}")
    if not rows[0][needed]:
        raise ValueError(f"episode {ident} has no {needed}")
    return rows[0].asDict(recursive=True)


def by_key(spark: SparkSession, path: str, key: str = "sr_episode_id") -> DataFrame:
    """A table with one row for each key: of several the last one in the files' order."""
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    rows = spark.read.parquet(path).withColumn("__p", place)
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in (key, "__p")]), "__p").alias("__v")).select(key, "__v.*")


def to_half(rows: DataFrame, vector: str) -> DataFrame:
    """``vector`` as little-endian 16-bit floats in a binary column: half the size of single precision."""
    schema = StructType([StructField(f.name, BinaryType()) if f.name == vector else f for f in rows.schema.fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(vector)
            packed = [None if v is None else np.asarray(v, "<f2").tobytes() for v in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()) if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)

    return rows.mapInArrow(pack, schema)


def from_half(rows: DataFrame, vector: str) -> DataFrame:
    """The reverse of ``to_half``, as an array of single-precision numbers."""
    schema = StructType([StructField(f.name, ArrayType(FloatType())) if f.name == vector else f for f in rows.schema.fields])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(vector)
            lists = [None if v is None else np.frombuffer(v, "<f2").astype(np.float32).tolist() for v in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.float32())) if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)

    return rows.mapInArrow(unpack, schema)


def write_report(report: DataFrame, path: str) -> None:
    """The text of a table of one row and one column as one file in the folder ``path``."""
    report.coalesce(1).write.mode("overwrite").text(path)


def write_document(document: Document, path: str) -> None:
    """Writes a document in parts, as a new version of the folder ``path``: every section is sorted by ranges of its keys, a part a range.

    The manifest's ``layout`` lists texts and parts in order. A part ends with a comma, which does not count in a section's last one. No task holds a section, and
    a run that fails leaves the version before.
    """
    spark = document.sections[0].rows.sparkSession

    def write(folder: str) -> dict:
        layout: list[dict] = []
        for number, section in enumerate(document.sections):
            own = f"{number:04d}"
            rows = section.rows.repartitionByRange(*section.keys).sortWithinPartitions(*section.keys)
            rows.select("json").write.option("lineSep", ",").text(f"{folder}/{own}")
            fs, place, system = versioned.files_of(spark, f"{folder}/{own}")
            found = sorted((f.getPath().getName(), f.getLen()) for f in system.listStatus(place))
            parts = [{"part": f"{own}/{name}", "bytes": size} for name, size in found if name.startswith("part-") and size]
            if parts:
                parts[-1]["bytes"] -= 1
            layout += [{"text": section.opening}, *parts]
        return {"layout": [*layout, {"text": document.closing}]}

    versioned.publish(spark, path, write)


def join_document(spark: SparkSession, path: str, out: str) -> None:
    """One file of a document's current version, copied part after part by streams; it appears under its name when it is whole."""
    said = versioned.manifest(spark, path)
    fs, target, system = versioned.files_of(spark, out)
    fresh = fs.Path(f"{out}.{said['version']}")
    stream = system.create(fresh, True)
    try:
        for piece in said["layout"]:
            if "text" in piece:
                stream.write(piece["text"].encode())
                continue
            _, part, there = versioned.files_of(spark, f"{path}/{said['version']}/{piece['part']}")
            source = there.open(part)
            spark._jvm.org.apache.commons.io.IOUtils.copyLarge(source, stream, 0, piece["bytes"])
            source.close()
    finally:
        stream.close()
    system.delete(target, False)
    system.rename(fresh, target)


def of_ids(rows: DataFrame, ids: Iterable[int], key: str = "sr_episode_id") -> DataFrame:
    """The rows of a list of ids; an error where one is missing."""
    wanted = rows.sparkSession.createDataFrame([(i,) for i in sorted(set(ids))], f"{key} bigint")
    missing = [r[0] for r in wanted.join(rows.select(key), key, "left_anti").limit(10).collect()]
    if missing:
        raise KeyError(f"missing: {missing}")
    return rows.join(wanted, key, "left_semi")


def write_table(rows: DataFrame, path: str, schema: str, mode: str = "overwrite") -> None:
    """Zstandard Parquet with exactly the columns of ``schema``, in its order; Spark's committer makes it appear at once."""
    empty = rows.sparkSession.createDataFrame([], schema)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in empty.schema.fields]
    rows.select(*columns).write.mode(mode).option("compression", "zstd").parquet(path)


def write_split(rows: DataFrame, path: str, bad, schema: str) -> None:
    """Rows for which ``bad`` holds go to ``quarantine``, the others to ``clean``."""
    write_table(rows.filter(~bad), f"{path}/clean", schema)
    write_table(rows.filter(bad), f"{path}/quarantine", schema)
