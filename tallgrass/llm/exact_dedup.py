"""Exact dedup by content sort, with DataFrame functions only.

Sampled splitters range-partition the normalised texts, each range is sorted externally so that equal texts are
neighbours, and neighbours are compared in full. The range key is (first characters, 64-bit hash, hash of the
identifier): equal texts share its first two parts, and the third one lets splitters fall inside a large group
of copies, so that no group has to fit into one task. A group can be cut only by a splitter with its own hash: the
runs of all such hashes are joined through a table of about two rows a splitter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.llm.workspace import ascii_lower, stage

#: Characters of the text in the range key. Whole texts are compared; this only orders the ranges.
PREFIX_CHARS = 24
#: Seed of the identifier's hash in the range key. It is not the hash by which the sample is drawn: else all splitters inside
#: a group of copies would stand at the group's beginning, and leave its rest to one range.
SPREAD_SEED = 7
#: Sampled keys per splitter.
OVERSAMPLING = 24


def _range_key(norm: Column, ident: Column) -> Column:
    # No zero character but the two separators, so that keys are in the order of their parts.
    return F.concat(F.replace(F.substring(norm, 1, PREFIX_CHARS), F.lit("\x00"), F.lit("\x01")), F.lit("\x00"), F.hex(F.xxhash64(norm)), F.lit("\x00"), F.hex(F.xxhash64(ident, F.lit(SPREAD_SEED))))


def sample_splitters(rows: DataFrame, ranges: int) -> list[str]:
    """Keys that cut ``rows`` (id, norm) into about equal ranges; at most ``ranges - 1``.

    The sample holds the rows whose identifiers hash lowest, ``OVERSAMPLING`` for each range, so that it is the same in
    every run; only the keys, of bounded length, come to the driver.
    """
    size = ranges * OVERSAMPLING
    by_hash = F.xxhash64("id")
    lowest = rows.select(by_hash.alias("x")).orderBy("x").limit(size).agg(F.max("x")).first()[0]
    if lowest is None:
        return []
    picked = rows.filter(by_hash <= F.lit(lowest)).limit(2 * size)
    keys = sorted((r[0] for r in picked.select(_range_key(F.col("norm"), F.col("id"))).collect()), key=lambda k: k.encode())
    return list(dict.fromkeys(keys[len(keys) * i // ranges] for i in range(1, ranges)))


def _dealt(rows: DataFrame, splitters: list[str]) -> DataFrame:
    """Adds ``range``, the number of splitters that are at most the row's key, and ``cut``, whether a splitter has its text's hash.

    The splitters travel as one row, and are searched in two steps of about the root of their number.
    """
    keys = rows.withColumn("key", _range_key(F.col("norm"), F.col("id")))
    if not splitters:
        return keys.withColumns({"range": F.lit(0), "cut": F.lit(False)}).drop("key")
    width = max(1, round(len(splitters) ** 0.5))
    groups = [splitters[i : i + width] for i in range(0, len(splitters), width)]
    table = rows.sparkSession.createDataFrame([([g[0] for g in groups], groups)], "heads array<string>, nested array<array<string>>")
    at_most = lambda found: F.size(F.filter(found, lambda s: s <= F.col("key")))
    keys = keys.join(F.broadcast(table)).withColumn("group", at_most("heads"))
    keys = keys.withColumn("near", F.element_at("nested", F.greatest("group", F.lit(1)))).drop("nested")
    keys = keys.withColumn("place", F.when(F.col("group") == 0, F.lit(0)).otherwise(at_most("near")))
    # The splitters on both sides: one between two keys of equal texts begins like both, so it has their hash.
    sides = F.get("near", F.col("place") - 1), F.coalesce(F.get("near", F.col("place")), F.get("heads", F.col("group")))
    same = [F.coalesce(F.split_part(s, F.lit("\x00"), F.lit(2)) == F.hex(F.xxhash64("norm")), F.lit(False)) for s in sides]
    number = F.when(F.col("group") == 0, F.lit(0)).otherwise((F.col("group") - 1) * width + F.col("place"))
    return keys.withColumns({"range": number.cast("int"), "cut": same[0] | same[1]}).drop("key", "heads", "near", "group", "place")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", ranges: int | None = None, carry: bool = False) -> DataFrame:
    """One row for each row of ``df``: the identifier, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z. ``keep`` says whether the smallest or the largest
    identifier stays. A null text counts as empty. Null identifiers come last: they stay only where a group has no
    other, with a null ``keep_id``. Of repeated rows (same identifier, same text) one stays. Other columns are not
    read, unless ``carry`` asks for the whole row in a struct ``row``; an empty table gives an empty result.
    """
    spark = df.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Either the normalised text moves, or the row as it is, which is then normalised again behind the exchange.
    rows = df.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("norm"), *([F.struct(*[df[c] for c in df.columns]).alias("row")] if carry else []))
    splitters = sample_splitters(rows.select("id", "norm"), ranges)
    rows = _dealt(rows, splitters)
    if carry:
        rows = rows.drop("norm")
    # Every range is a partition of its own: hashes of their numbers would put several into one and none into others.
    rows = rows.repartitionById(len(splitters) + 1, "range")
    if carry:
        rows = rows.withColumn("norm", ascii_lower(F.col("row").getField(text_col)))

    best, order = (F.min, F.asc_nulls_last("id")) if keep == "min" else (F.max, F.desc_nulls_last("id"))
    sort = Window.partitionBy("range").orderBy("norm", order)
    before = F.lag("norm").over(sort)
    runs = (
        rows.withColumn("starts", before.isNull() | (before != F.col("norm")))
        .withColumn("edge", F.when(F.col("starts") & F.col("cut"), F.col("norm")))
        .withColumn("sha", F.sha2("norm", 256))
        .withColumn("run", F.sum(F.col("starts").cast("int")).over(sort.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("norm", "cut")
    )
    run = Window.partitionBy("range", "run")
    runs = stage(runs.withColumns({"best": best("id").over(run), "size": F.count(F.lit(1)).over(run)}), "dedup-runs")

    # Runs with a splitter's hash, by whole text: one row for each run, in few ranges unless a group fills many.
    edges = runs.filter(F.col("edge").isNotNull()).select("range", "run", "edge", "best", "size")
    joined = edges.groupBy("edge").agg(best("best").alias("all_best"), F.sum("size").alias("all_size"), F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("range", "run")).alias("parts"))
    joined = joined.filter("n > 1").select("all_best", "all_size", F.explode("parts").alias("p")).select("all_best", "all_size", "p.range", "p.run")
    # Of several parts of a group, only the one that holds the best identifier (or, without one, the first part) keeps a row.
    out = runs.join(F.broadcast(joined), ["range", "run"], "left")
    keep_id, size = F.when(F.col("all_size").isNull(), F.col("best")).otherwise(F.col("all_best")), F.coalesce("all_size", "size")
    out = out.withColumns({"keep_id": keep_id, "group_size": size})
    kept = F.col("starts") & F.col("id").eqNullSafe(F.col("keep_id"))
    return out.select(F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"), *(["row"] if carry else []))


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``df``, all columns, without copies; of rows that repeat an identifier and text, one stays."""
    rows = exact_dedup(df, id_col, text_col, keep, carry=True)
    return rows.filter("kept").select(*[F.col("row").getField(c).alias(c) for c in df.columns])


#: The same result in DuckDB.
SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm
"""
