"""A map that keeps neighbourhoods: fuzzy links between neighbours, laid out by attraction along them and repulsion between samples.

A row's links fade with the distance beyond its nearest neighbour, at a rate found by bisection so that they add up to a fixed weight. Links of
both ends are joined as fuzzy sets. Positions begin at the principal components. Rows are dealt into blocks by where they lie; in a
round every block is one task that moves its own rows for some epochs, while the rows at the other ends of its links, and a
bounded sample of all rows that repels, stand still. Samples are seeded, and beginnings and weights rounded, so that the same rows give the same map.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.staging import stage

#: Rows of a block; rows that repel from outside it; rounds where there are several blocks; epochs altogether.
BLOCK_ROWS, FAR_ROWS, ROUNDS, EPOCHS = 20_000, 2000, 10, 200
#: Steps of the bisection, parts that an epoch is cut into, samples that repel for each link, and the bound of a step.
BISECTIONS, PARTS, REPEL, BOUND = 64, 8, 5, 4.0
SEED = 42


def fuzzy_links(near: DataFrame, spread: float = 1.0) -> DataFrame:
    """Links ``a`` < ``b`` with ``weight`` from a neighbour table (``id``, ``related_id``, ``similarity``): 1 to the nearest neighbours, then fading.

    The weights of a row's own list add up to the binary logarithm of its length; the weight of a link is p + q - p * q of its ends' weights.
    """
    lists = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.greatest(1 - F.col("similarity"), F.lit(0.0)).alias("d"), "related_id"))).alias("l"))  # the ranks of the table
    lists = lists.select("id", F.transform("l", lambda x: x["related_id"]).alias("to"), F.transform("l", lambda x: x["d"]).alias("d"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            row, d = np.repeat(np.arange(len(sizes)), sizes), batch.column(2).flatten().to_numpy(zero_copy_only=False)
            first = np.full(len(sizes), np.inf)
            np.minimum.at(first, row, np.where(d > 0, d, np.inf))
            beyond = np.maximum(d - np.where(np.isfinite(first), first, 0)[row], 0)
            goal, low, high, rate = np.log2(np.maximum(sizes, 2)) * spread, np.zeros(len(sizes)), np.full(len(sizes), np.inf), np.ones(len(sizes))
            for _ in range(BISECTIONS):
                more = np.bincount(row, np.exp(-beyond / rate[row]), len(sizes)) > goal
                low, high = np.where(more, low, rate), np.where(more, rate, high)
                rate = np.where(np.isinf(high), 2 * rate, (low + high) / 2)
            mean = np.bincount(row, d, len(sizes)) / np.maximum(sizes, 1)
            rate = np.maximum(rate, np.maximum(1e-3 * mean, 1e-12))
            weight = np.exp(-beyond / rate[row])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).flatten(), pa.array(weight)], ["a", "b", "w"])

    links = lists.mapInArrow(weigh, "a long, b long, w double")
    both = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w")
    return both.groupBy("a", "b").agg(F.round(1 - F.product(1 - F.col("w")), 9).alias("weight"))


def curve(min_distance: float = 0.1, spread: float = 1.0) -> tuple[float, float]:
    """``a`` and ``b`` for which 1 / (1 + a * d ** (2 b)) is nearest to a fall that begins at ``min_distance``: Gauss-Newton steps, damped."""
    d = np.linspace(1e-3, 3 * spread, 300)
    goal = np.where(d < min_distance, 1.0, np.exp(-(d - min_distance) / spread))
    p, damp = np.array([1.5, 0.9]), 1e-2
    cost = lambda q: float((((1 / (1 + q[0] * d ** (2 * q[1]))) - goal) ** 2).sum())
    for _ in range(200):
        power = d ** (2 * p[1])
        value = 1 / (1 + p[0] * power)
        slope = np.column_stack([-(value**2) * power, -(value**2) * p[0] * power * 2 * np.log(d)])
        step = np.linalg.solve(slope.T @ slope + damp * np.eye(2), slope.T @ (goal - value))
        better = cost(np.maximum(p + step, 1e-3)) < cost(p)
        p, damp = (np.maximum(p + step, 1e-3), damp / 2) if better else (p, damp * 4)
    return float(p[0]), float(p[1])


def _move(a: float, b: float, epochs: range, far: np.ndarray):
    """Moves a block's rows for some epochs. Rows: a link from the block's row ``a`` to ``b`` with both positions, and whether ``b`` is in the block too."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["a", "b"])
        ids, head = np.unique(rows["a"].to_numpy(), return_inverse=True)
        at = np.zeros((len(ids), far.shape[1]))
        at[head] = np.stack(rows["pa"].tolist())
        inside, weight = rows["inside"].to_numpy(), rows["weight"].to_numpy()
        tail, still = np.where(inside, np.searchsorted(ids, rows["b"].to_numpy()), 0), np.stack(rows["pb"].tolist())
        rng = np.random.default_rng([SEED, epochs.start, int(ids[0]) & 0x7FFFFFFF])

        def pull(node: np.ndarray, move: np.ndarray) -> None:
            for j in range(at.shape[1]):
                at[:, j] += np.bincount(node, move[:, j], len(ids))

        for epoch in epochs:
            rate = 1 - epoch / EPOCHS
            taken = np.flatnonzero(rng.random(len(weight)) < weight)  # a link is drawn as often as its weight says
            for some in np.array_split(rng.permutation(taken), PARTS):
                h, t, own = head[some], tail[some], inside[some]
                gap = at[h] - np.where(own[:, None], at[t], still[some])
                square = (gap**2).sum(axis=1)
                with np.errstate(divide="ignore"):
                    factor = np.where(square > 0, -2 * a * b * square ** (b - 1) / (1 + a * square**b), 0)
                move = rate * np.clip(factor[:, None] * gap, -BOUND, BOUND)
                pull(h, move)  # every link inside the block comes from both its ends, so its tail moves when it is the head
                h = np.repeat(h, REPEL)
                pool = rng.integers(0, len(ids) + len(far), len(h))
                gap = at[h] - np.where((pool < len(ids))[:, None], at[np.minimum(pool, len(ids) - 1)], far[np.maximum(pool - len(ids), 0)] if len(far) else 0)
                square = (gap**2).sum(axis=1)
                factor = np.where(square > 0, 2 * b / ((0.001 + square) * (1 + a * square**b)), 0)
                pull(h, rate * np.clip(factor[:, None] * gap, -BOUND, BOUND))
        return pd.DataFrame({"id": ids, "p": list(at)})

    return run


def lay_out(links: DataFrame, start: DataFrame, min_distance: float = 0.1, epochs: int = EPOCHS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id`` and position ``p`` of the rows of ``start`` (``id``, ``p``: where they begin), moved along ``links``.

    Rows without a link stay where they are. A block of up to about ``block_rows`` rows is one task, for all epochs where it is the only one, else for a part of them.
    """
    a, b = curve(min_distance)
    bounds = start.select(F.size("p").alias("d"), F.array_max(F.transform("p", F.abs)).alias("m")).agg(F.max("d"), F.max("m"), F.count(F.lit(1))).first()
    if not bounds[2]:
        return start
    dims, number, scale = bounds[0], bounds[2], 10 / max(bounds[1], 1e-12)
    # A little noise, the same for an identifier in every run, parts rows that begin at one place.
    noise = lambda i: (F.pmod(F.xxhash64("id", i), F.lit(1 << 20)) / (1 << 20) - 0.5) * 1e-3
    now = stage(start.select("id", F.transform("p", lambda x, i: F.round(x * scale, 6) + noise(i)).alias("p")), "positions")
    both = stage(links.union(links.select("b", "a", "weight")), "links")
    blocks, done = -(-number // block_rows), 0
    rounds = 1 if blocks == 1 else ROUNDS
    for turn in range(rounds):
        some = range(done, epochs * (turn + 1) // rounds)
        done = some.stop
        # Blocks are slices of the map, along another direction in every round, so that no border stays.
        angle = math.pi * turn / rounds
        along = F.get("p", F.lit(0)) * math.cos(angle) + (F.get("p", F.lit(1)) * math.sin(angle) if dims > 1 else F.lit(0.0))
        placed, far = now.withColumn("block", F.lit(0)), np.zeros((0, dims))
        if blocks > 1:
            cuts = now.select(along.alias("t")).approxQuantile("t", [i / blocks for i in range(1, blocks)], 0.2 / blocks)
            placed = now.withColumn("block", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < along)))
            far = np.array([r[0] for r in now.orderBy(F.xxhash64("id")).limit(FAR_ROWS).select("p").collect()])
        ends = both.join(placed.select(F.col("id").alias("a"), F.col("p").alias("pa"), "block"), "a").join(placed.select(F.col("id").alias("b"), F.col("p").alias("pb"), F.col("block").alias("other")), "b")
        ends = ends.select("block", "a", "b", "weight", "pa", "pb", (F.col("block") == F.col("other")).alias("inside"))
        moved = ends.groupBy("block").applyInPandas(_move(a, b, some, far), "id long, p array<double>").withColumnRenamed("p", "new")
        now = stage(now.join(moved, "id", "left").select("id", F.coalesce("new", "p").alias("p")), "positions")
    return now
