"""Connected components by alternating large and small stars, with DataFrame functions; few edges can be joined in one task."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.workspace import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest one."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


#: Edges up to this number may be joined in one task.
LOCAL_EDGES = 1_000_000


def _joined(part: pa.Table) -> pa.Table:
    """Components of a bounded number of edges, by union-find."""
    above: dict = {}

    def top(x):
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True):
        x, y = top(a), top(b)
        above[max(x, y)] = min(x, y)
    nodes, kind = list(above), part.schema.field("a").type
    return pa.table({"node": pa.array(nodes, kind), "component": pa.array([top(x) for x in nodes], kind)})


def components(edges: DataFrame, a: str = "a", b: str = "b", local: bool = False) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node that has an edge to another node.

    Minima are aggregated before they are shuffled, so a hub does not land in one task, and neither edges nor labels come
    to the driver. Edges with a null end are ignored. Every round halves the depth of the trees at least; the rounds end
    when the edges no longer change, as seen by their number and the sum of their hashes. With ``local`` one Python task joins
    them where they are LOCAL_EDGES at most.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges, state = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"), None
    if local and edges.limit(LOCAL_EDGES + 1).count() <= LOCAL_EDGES:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_joined, f"node {kind}, component {kind}")
    while True:
        seen = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == state or not seen[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
        state, edges = seen, stage(_small_star(_large_star(edges)), "edges")
