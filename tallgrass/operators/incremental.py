"""Cached values: what is there is joined, what is missing is computed, and only current keys stay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.sources import versioned


def pending(now: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Rows of ``now`` whose key the cache lacks."""
    return now.join(cache.select(key), key, "left_anti")


def upsert(now: DataFrame, cache: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``now`` with the cached columns, computed where missing, and ``origin``; the result's keys are those of ``now``.

    ``compute`` gets the missing rows once and returns the key and the cached columns.
    """
    fresh = compute(pending(now, cache, key)).withColumn("origin", F.lit("computed"))
    known = cache.withColumn("origin", F.lit("cached"))
    return now.join(known.unionByName(fresh), key)


def content_key(columns: list[str], recipe: str) -> Column:
    """What a computed value depends on: the values of ``columns``, null or not, and the recipe (a model's name, its settings)."""
    return F.sha2(F.concat(F.lit(recipe + "\x00"), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})), 256)


def refresh(now: DataFrame, path: str, columns: list[str], recipe: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``now`` with the computed columns and ``origin``, from a cache in the folder ``path`` that afterwards holds what ``now`` needs and no more.

    Values are kept by ``content_key``, so that equal contents are computed once, and anew where the recipe changes. ``compute`` gets ``content_key`` and
    ``columns`` of what is missing and returns ``content_key`` and its own columns. The new cache is a version beside the old one, in whose place
    it comes when it is whole; a run that breaks off before has no effect.
    """
    spark, keyed = now.sparkSession, now.withColumn("content_key", content_key(columns, recipe))
    wanted = keyed.select("content_key", *columns).dropDuplicates(["content_key"])
    old = versioned.current(spark, path)
    cache = spark.read.parquet(old) if old else None

    def write(folder: str) -> None:
        fresh = compute(pending(wanted, cache, "content_key") if cache is not None else wanted).withColumn("origin", F.lit("computed"))
        if cache is not None:
            fresh = cache.withColumn("origin", F.lit("cached")).join(wanted.select("content_key"), "content_key", "left_semi").unionByName(fresh)
        fresh.write.parquet(folder)

    versioned.publish(spark, path, write)
    return keyed.join(spark.read.parquet(versioned.current(spark, path)), "content_key").drop("content_key")


#: Keys of the sample that cuts the key range, and parts that it is cut into at most.
SAMPLE_KEYS, MOST_PARTS = 20_000, 1000


def numbered(keys: DataFrame, key: str, column: str = "position") -> DataFrame:
    """Distinct keys that are not null, with their place from 0 in ascending order.

    Sampled splitters cut the range; places are those within a part after the sizes of the parts before. A key's part
    depends on the key alone, so nothing changes when a task runs again, and no task sorts all keys.
    """
    distinct = keys.filter(F.col(key).isNotNull()).select(key).distinct()
    some = distinct.orderBy(F.xxhash64(key)).limit(SAMPLE_KEYS)
    parts = F.least(F.lit(MOST_PARTS), F.floor(F.size("__s") / 20) + 1).cast("int")
    splits = some.agg(F.sort_array(F.collect_list(key)).alias("__s"))
    splits = splits.select(F.transform(F.sequence(F.lit(1), parts), lambda i: F.get("__s", (F.floor(F.size("__s") * i / parts) - 1).cast("int"))).alias("__splits"))
    placed = distinct.join(F.broadcast(splits)).withColumn("__part", F.size(F.filter("__splits", lambda x: x < F.col(key)))).drop("__splits")  # one row
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).drop("__n")  # MOST_PARTS + 1 rows at most
    within = F.row_number().over(Window.partitionBy("__part").orderBy(key)) - 1
    return placed.withColumn("__within", within).join(F.broadcast(before), "__part").select(key, (F.col("__before") + F.col("__within")).alias(column))


def batches(keys: DataFrame, key: str, size: int = 100) -> DataFrame:
    """Distinct keys in ascending order with the number of their batch, ``size`` to a batch."""
    return numbered(keys, key).select(key, F.floor(F.col("position") / size).cast("long").alias("batch"))


def fetch_plan(wanted: DataFrame, ids: DataFrame, cache: DataFrame, key: str, order: list[str], most: int | None = None) -> DataFrame:
    """Rows of ``wanted`` whose key is in ``ids``, the first ``most`` in ``order``, each ``cached`` or to ``fetch``; ``position`` from 1 keeps the order."""
    if most is not None and most < 1:
        raise ValueError("most must be positive")
    chosen = wanted.join(ids.select(key).distinct(), key, "left_semi").orderBy(*order)
    chosen = chosen.limit(most) if most is not None else chosen
    known = cache.select(key).distinct().withColumn("__hit", F.lit(True))
    place = F.row_number().over(Window.orderBy(*order)) if most is not None else F.lit(None).cast("int")  # ``most`` rows
    rows = chosen.join(known, key, "left").withColumn("origin", F.when(F.col("__hit"), "cached").otherwise("fetch")).drop("__hit")
    return rows.withColumn("position", place)
