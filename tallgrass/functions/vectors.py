"""Vector expressions on array columns, and vector aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector divided by its length, which is 1e-12 at least."""
    length = F.greatest(norm(a), F.lit(1e-12))
    # Inside the function of an element the length would be computed for every element: it is bound once.
    return F.get(F.transform(F.array(length), lambda by: scale(a, by)), F.lit(0))


def scale(a: Column, by: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double") / by)


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))


def mean_vectors(df: DataFrame, keys: list[str], vector: str, weight: Column | None = None) -> DataFrame:
    """Weighted mean of ``vector`` by ``keys``: positions are summed in parallel, so no task holds a group's vectors."""
    weight = F.lit(1.0) if weight is None else weight.cast("double")
    long = df.select(*keys, weight.alias("__w"), F.posexplode(vector).alias("__i", "__x"))
    means = long.groupBy(*keys, "__i").agg((F.sum(F.col("__x").cast("double") * F.col("__w")) / F.sum("__w")).alias("__m"))
    ordered = F.array_sort(F.collect_list(F.struct("__i", "__m")))  # as many entries as the vector has positions
    return means.groupBy(*keys).agg(F.transform(ordered, lambda p: p["__m"]).alias(vector))
