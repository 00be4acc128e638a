"""An index for texts that contain a text: bitmaps of the rows that hold a run of three characters.

Rows have places in the order of their identifiers and stand in blocks of as many as a bitmap has bits, a partition each. A search reads the bitmaps of its own
runs, intersects them block by block, and reads only the blocks that are left; of these the rows whose bit is set are candidates, in which the text is looked for.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallgrass.operators.incremental import numbered
from tallgrass.sources import versioned
from tallgrass.staging import stage

#: Characters of a run, and what stands behind a text, so that every character begins one: a text of fewer characters is the beginning of runs.
RUN, END = 3, "\0\0"
#: Bits of a bitmap of Spark, and bitmaps that are made at once.
BITS, MAPS = 32_768, 512


def runs_of(text: Column) -> Column:
    """The different runs of three characters of a text and its end, which the index holds; none for null."""
    runs = lambda c: F.array_distinct(F.transform(F.slice(c, 1, F.size(c) - RUN + 1), lambda x, i: F.concat(x, F.get(c, i + 1), F.get(c, i + 2))))
    chars = F.split(F.concat(text, F.lit(END)), "")
    return F.coalesce(F.get(F.transform(F.array(chars), runs), F.lit(0)), F.array().cast("array<string>"))  # so a text is split once


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch (``block``, ``bit``, ``text``) that hold a run, as a list of bits for each run and block: what ``runs_of`` gives, in numpy."""
    for batch in batches:
        block, bit, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy(), []
        for text in batch.column(2):
            codes = np.frombuffer((text.as_py() + END).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            keys.append(np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]))  # 21 bits a character
        row, key = np.repeat(np.arange(len(keys)), [len(x) for x in keys]), np.concatenate([np.zeros(0, np.int64), *keys])
        number, names = pd.factorize(key)  # few different ones, by which the rest is sorted: short numbers go quickest
        blocks, of = np.unique(block, return_inverse=True)
        number = number * len(blocks) + of[row]
        order = np.argsort(number.astype(np.uint16) if len(names) * len(blocks) < 1 << 16 else number, kind="stable")
        row, key, number = row[order], key[order], number[order]
        new = np.flatnonzero(np.diff(number, prepend=-1))
        runs = ["".join(chr(k >> s & 0x1FFFFF) for s in (42, 21, 0)) for k in key[new].tolist()]
        bits = pa.ListArray.from_arrays(pa.array(np.r_[new, len(key)].astype(np.int32)), pa.array(bit[row].astype(np.int16)))
        yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), pa.array(block[row[new]]), bits], ["run", "__block", "at"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps from lists of bits in the order of ``run`` and ``__block``: a run and block may have several lists, one after another."""
    last, held = None, np.zeros(BITS, bool)

    def packed(keys: list[tuple], maps: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([m.tobytes() for m in np.packbits(maps, axis=1, bitorder="little")], pa.binary())], ["run", "__block", "bits"])

    for batch in batches:
        for first in range(0, len(batch), MAPS):
            part = batch.slice(first, MAPS)
            keys = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
            places = [k for i, k in enumerate(keys) if not i or k != keys[i - 1]]
            group = np.cumsum([i > 0 and k != keys[i - 1] for i, k in enumerate(keys)])
            lists = part.column(2)
            maps = np.zeros((len(places), BITS), bool)
            maps[np.repeat(group, np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()] = True
            if last is not None and last == places[0]:
                maps[0] |= held
            elif last is not None:
                yield packed([last], held[None])
            last, held = places[-1], maps[-1].copy()
            if len(places) > 1:
                yield packed(places[:-1], maps[:-1])
    if last is not None:
        yield packed([last], held[None])


def runs_wanted(text: str) -> list[str]:
    """The runs that a text has to have if it contains ``text``; of a short one the beginning of the runs of which it needs any."""
    size = min(RUN, len(text))
    return sorted({text[i : i + size] for i in range(len(text) - size + 1)}) if size else []


def build(rows: DataFrame, ident: str, column: str, path: str) -> None:
    """Writes the rows, all columns, with the index of ``column`` in lower case to the folder ``path``, in place of the version before once it is whole.

    Rows without an identifier are left out; rows that repeat one are found together with it or not at all, as their texts say. Null texts are never found.
    """
    place = numbered(rows, ident, "__place").withColumn("__place", F.col("__place") + 1)
    placed = rows.join(place, ident).select(*rows.columns, F.bitmap_bucket_number("__place").alias("__block"), F.bitmap_bit_position("__place").alias("__bit"))

    def write(folder: str) -> dict:
        placed.repartition("__block").write.partitionBy("__block").parquet(f"{folder}/rows")
        whole = rows.sparkSession.read.schema(placed.schema).parquet(f"{folder}/rows")
        texts = whole.select(F.col("__block").cast("long").alias("block"), F.col("__bit").cast("int").alias("bit"), F.lower(column).alias("text")).filter("text IS NOT NULL")
        lists = stage(texts.mapInArrow(_positions, "run string, __block long, at array<short>"), "runs")  # the ranges are sampled, so it would be made twice
        lists = lists.repartitionByRange("run", "__block").sortWithinPartitions("run", "__block")  # a frequent run's blocks lie in many files
        lists.mapInArrow(_bitmaps, "run string, __block long, bits binary").write.parquet(f"{folder}/runs")
        return {"ident": ident, "column": column, "schema": whole.schema.json()}

    versioned.publish(rows.sparkSession, path, write)


def containing(spark: SparkSession, path: str, text: str) -> DataFrame:
    """The indexed rows whose text contains ``text`` in lower case, less white space at both ends; all that have a text where nothing is left of it."""
    folder, said, wanted = versioned.current(spark, path), versioned.manifest(spark, path), text.strip().lower()
    rows = spark.read.schema(StructType.fromJson(json.loads(said["schema"]))).parquet(f"{folder}/rows")
    if runs := runs_wanted(wanted):
        maps = spark.read.schema("run string, __block long, bits binary").parquet(f"{folder}/runs")
        if len(wanted) < RUN:
            shared = maps.filter(F.col("run").startswith(wanted)).groupBy("__block").agg(F.bitmap_or_agg("bits").alias("__bits"))
        else:
            shared = maps.filter(F.col("run").isin(runs)).groupBy("__block").agg(F.bitmap_and_agg("bits").alias("__bits"), F.count(F.lit(1)).alias("__runs")).filter(F.col("__runs") == len(runs))
        # As a table its size is known: Spark broadcasts it where it is small, and then reads its blocks only.
        shared = stage(shared.select("__block", "__bits", F.bitmap_count("__bits").alias("__n")), "blocks").filter("__n > 0")
        byte = F.conv(F.hex(F.substring("__bits", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        rows = rows.join(shared.drop("__n"), "__block").filter(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1)
    return rows.filter(F.lower(said["column"]).contains(wanted)).drop("__block", "__bit", "__bits")
