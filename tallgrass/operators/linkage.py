"""A tree of average linkage over vectors, by rounds of groups that are each other's nearest.

The mean cosine of two groups is the product of their mean vectors, so a group is a sum and a number. A round merges all pairs of groups that are each
other's nearest; a merged group is as far from a third one as one of its parts at least, so the others keep their nearest, and only groups that are new or
have lost theirs are compared with all, block against block. The last ``LOCAL_GROUPS`` are merged on the driver.
Where many groups have the same nearest one, a round merges one pair of them, so there can be as many rounds as groups in the worst case.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.functions import vectors as V
from tallgrass.operators.incremental import numbered
from tallgrass.staging import stage

#: Groups that are merged on the driver, rows of a block, the least rows for which a block of its own is worth it, and rows that are multiplied at a time.
LOCAL_GROUPS, BLOCK_ROWS, LEAST_ROWS, PART_ROWS = 2048, 8192, 1024, 2048
#: A merge: the round, both sides by their smallest leaf and the round they came from (0 for a leaf), the distance, and the leaves below.
_MERGES = "born int, a long, a_born int, b long, b_born int, distance double, leaves long"


def _chain(names: list[int], born: list[int], heights: list[float], leaves: np.ndarray, sums: np.ndarray, after: int) -> list[tuple]:
    """Merges of the groups, whose names ascend, by chains of nearest neighbours: rows of ``_MERGES`` in the order of their distances."""
    n = len(names)
    sums, held, alive, chain, merges = sums.copy(), leaves.astype(float), np.ones(n, bool), [], []
    for _ in range(n - 1):
        chain = chain or [int(alive.argmax())]
        while True:
            last = chain[-1]
            apart = np.where(alive, 1 - (sums @ sums[last]) / (held * held[last]), np.inf)
            apart[last] = np.inf
            before = chain[-2] if len(chain) > 1 else None
            near = int(apart.argmin())
            if before is not None and apart[before] <= apart[near] + 1e-15:
                break
            chain.append(near)
        distance = float(apart[before])
        i, j = sorted((chain.pop(), chain.pop()))
        merges.append((distance, i, j))
        sums[i] += sums[j]
        held[i] += held[j]
        alive[j] = False
    merges.sort(key=lambda m: m[0])
    into, born, heights, size, out = list(range(n)), list(born), list(heights), [int(x) for x in leaves], []

    def top(i: int) -> int:
        while into[i] != i:
            i = into[i]
        return i

    for step, (distance, i, j) in enumerate(merges):
        i, j = sorted((top(i), top(j)))
        height = max(distance, heights[i], heights[j])
        out.append((after + step, names[i], born[i], names[j], born[j], height, size[i] + size[j]))
        into[j], born[i], heights[i], size[i] = i, after + step, height, size[i] + size[j]
    return out


def _packed(groups: DataFrame, blocks: int) -> DataFrame:
    """A row a block: names, and mean vectors as bytes."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        means = np.stack(part["s"].tolist()) / part["leaves"].to_numpy(float)[:, None]
        return pd.DataFrame({"own": part["own"].iloc[:1], "ids": [part["id"].to_numpy(np.int64).tobytes()], "vs": [means.tobytes()]})

    rows = groups.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return rows.select("own", "id", "leaves", "s").groupBy("own").applyInPandas(pack, "own int, ids binary, vs binary")


def _nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each group of the first block the nearest one in the second; of equal ones the smaller name."""
    for batch in batches:
        for row in batch.itertuples():
            mine, theirs = (np.frombuffer(x, np.int64) for x in (row.ids, row.ids2))
            own, other = (np.frombuffer(v).reshape(len(i), -1) for v, i in ((row.vs, mine), (row.vs2, theirs)))
            for at in range(0, len(own), PART_ROWS):
                ids = mine[at : at + PART_ROWS]
                found, best = np.full(len(ids), np.inf), np.zeros(len(ids), np.int64)
                for first in range(0, len(other), PART_ROWS):
                    d = np.round(1 - own[at : at + PART_ROWS] @ other[first : first + PART_ROWS].T, 12)  # equal ones stay equal whatever the block
                    d[ids[:, None] == theirs[None, first : first + PART_ROWS]] = np.inf
                    top = d.argmin(axis=1)
                    d = d[np.arange(len(top)), top]
                    better = d < found
                    found[better], best[better] = d[better], first + top[better]
                fine = np.isfinite(found)
                yield pd.DataFrame({"id": ids[fine], "near": theirs[best[fine]], "d": found[fine]})


def _with_nearest(groups: DataFrame, number: int, block_rows: int) -> DataFrame:
    """``groups`` with ``near`` and ``d`` for those that lack them."""
    open_ = groups.filter("near IS NULL")
    cores = groups.sparkSession.sparkContext.defaultParallelism
    count = lambda n: max(1, -(-n // block_rows), min(cores, n // LEAST_ROWS))
    blocks = count(number)
    there = _packed(groups, blocks).select(F.col("own").alias("other"), F.col("ids").alias("ids2"), F.col("vs").alias("vs2"))
    pairs = _packed(open_, count(open_.count())).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(there, "other")
    found = pairs.mapInPandas(_nearest, "id long, near long, d double").groupBy("id").agg(F.min(F.struct("d", "near")).alias("e"))
    rows = groups.join(found, "id", "left")
    return rows.select("id", "born", "height", "leaves", "s", F.coalesce("near", "e.near").alias("near"), F.coalesce("d", "e.d").alias("d"))


def _pairs(known: DataFrame) -> DataFrame:
    """Pairs of groups that are each other's nearest, merged."""
    sides = [known.select(*[F.col(c).alias(f"{side}_{c}") for c in ("id", "born", "height", "leaves", "s", "near", "d")]) for side in "ab"]
    both = sides[0].filter("a_id < a_near").join(sides[1], (F.col("a_near") == F.col("b_id")) & (F.col("b_near") == F.col("a_id")))
    return both.select(F.col("a_id").alias("a"), "a_born", F.col("b_id").alias("b"), "b_born", F.greatest("a_d", "a_height", "b_height").alias("distance"), (F.col("a_leaves") + F.col("b_leaves")).alias("leaves"), F.zip_with("a_s", "b_s", lambda x, y: x + y).alias("s"))


def _copies(leaf: DataFrame, points: DataFrame) -> DataFrame:
    """Merges of equal vectors, one copy after another in the order of their names; a vector's copies are numbered over many tasks."""
    rows = leaf.join(points.select("s", F.col("id").alias("a")), "s").filter("id <> a").select(F.struct("a", "id").alias("copy"))
    placed = stage(numbered(rows, "copy", "place"), "copies")
    first = placed.groupBy(F.col("copy.a").alias("a")).agg(F.min("place").alias("start"))
    nth = (F.col("place") - F.col("start")).cast("int")
    placed = placed.withColumn("a", F.col("copy.a")).join(first, "a")
    return placed.select((nth + 1).alias("born"), "a", nth.alias("a_born"), F.col("copy.id").alias("b"), F.lit(0).alias("b_born"), F.lit(0.0).alias("distance"), (nth + 2).cast("long").alias("leaves"))


def merge_tree(centroids: DataFrame, ident: str, vector: str, local_groups: int = LOCAL_GROUPS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``step``, ``part_a``, ``part_b``, ``node``, ``distance``, ``leaves``: a row for each merge of two clusters into one.

    Equal vectors are merged first. Distances are the mean of 1 less the cosine over all pairs of vectors. Nodes are numbered from the largest id on in the order of their distances. Identifiers are whole
    numbers and differ; rows without one, or without a vector, are left out. Fewer than two rows have no merges. Of equal distances the smaller names go first.
    """
    spark = centroids.sparkSession
    leaf = centroids.select(F.col(ident).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    none = {"near": F.lit(None).cast("long"), "d": F.lit(None).cast("double")}
    leaf = stage(leaf.select("id", V.unit(F.col("v")).alias("s")), "leaves")
    points = stage(leaf.groupBy("s").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("leaves")), "points")
    number, total, born = points.agg(F.count(F.lit(1)), F.coalesce(F.sum("leaves"), F.lit(0)), F.coalesce(F.max("leaves") - 1, F.lit(0)).cast("int")).first()
    first = leaf.agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0]
    rounds = [stage(_copies(leaf, points), "merges")] if total > number else []
    now = points.select("id", (F.col("leaves") - 1).cast("int").alias("born"), F.lit(0.0).alias("height"), "leaves", F.transform("s", lambda x: x * F.col("leaves")).alias("s")).withColumns(none)
    while number > max(local_groups, 1):
        born += 1
        known = stage(_with_nearest(now, number, block_rows), "groups")
        pairs = stage(_pairs(known), "merges")
        merged = pairs.count()
        if not merged:  # rounding made a circle of equal ones: the nearest two go on
            one = known.orderBy("d", F.least("id", "near"), "id").select("id", "near").first()
            two = known.filter(F.col("id").isin(list(one))).withColumns({"near": F.when(F.col("id") == one[0], one[1]).otherwise(one[0]), "d": F.lit(known.agg(F.min("d")).first()[0])})
            pairs, merged = stage(_pairs(two), "merges"), 1
        rounds.append(pairs.select(F.lit(born).alias("born"), "a", "a_born", "b", "b_born", "distance", "leaves"))
        gone = pairs.select(F.explode(F.array("a", "b")).alias("gone"))
        left = known.join(gone, F.col("id") == F.col("gone"), "left_anti").join(gone, F.col("near") == F.col("gone"), "left")
        stays = F.col("gone").isNull()
        left = left.select("id", "born", "height", "leaves", "s", F.when(stays, F.col("near")).alias("near"), F.when(stays, F.col("d")).alias("d"))
        new = pairs.select(F.col("a").alias("id"), F.lit(born).alias("born"), F.col("distance").alias("height"), "leaves", "s").withColumns(none)
        now, number = stage(left.unionByName(new), "groups"), number - merged
    rows = now.select("id", "born", "height", "leaves", "s").orderBy("id").collect()  # ``local_groups`` at most
    sums = np.array([r["s"] for r in rows], float).reshape(len(rows), len(rows[0]["s"]) if rows else 0)
    last = _chain([r["id"] for r in rows], [r["born"] for r in rows], [r["height"] for r in rows], np.array([r["leaves"] for r in rows]), sums, born + 1)
    merges = reduce(DataFrame.unionByName, rounds, spark.createDataFrame(last, _MERGES)).withColumn("key", F.struct("distance", "born", "a"))
    if rounds:
        merges = stage(merges, "merges")
        merges = stage(merges.join(numbered(merges, "key", "step"), "key"), "numbered")
    else:  # they stand in their order
        merges = merges.withColumn("step", F.col("born") - 1)
    node = (F.col("step") + first).cast("long")
    named = lambda side: merges.select(F.col("a").alias(side), F.col("born").alias(side + "_born"), node.alias(side + "_node"))
    out = merges.join(named("a"), ["a", "a_born"], "left").join(named("b"), ["b", "b_born"], "left")
    return out.select(F.col("step").cast("int").alias("step"), F.coalesce("a_node", "a").alias("part_a"), F.coalesce("b_node", "b").alias("part_b"), node.alias("node"), "distance", F.col("leaves").cast("int").alias("leaves"))
