"""Exact nearest neighbours by cosine, block against block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F

#: Vectors of a block, which is shipped as a whole, the least for which a block of its own is worth it, and of the parts that are multiplied at a time.
BLOCK_ROWS, LEAST_ROWS, PART_ROWS = 32_768, 1024, 2048
#: Rows whose neighbours are looked for at a time, so that their scores stay in a processor's cache, and pairs of vectors that are multiplied again at a time.
QUERY_ROWS, CANDIDATES = 512, 1 << 15


def mean_of(df: DataFrame, vector: str, unit: bool = False) -> tuple[list[float], int]:
    """The mean vector, of vectors brought to length 1 with ``unit``, and the number of vectors: a sum and count of each task, added up by position in parallel."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(0), 0
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) if len(batch) else np.zeros((0, 0))
            if unit:
                values = values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-12)
            if len(values):
                total, number = values.sum(axis=0) + (total if number else 0), number + len(values)
        if number:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([number])], ["s", "n"])

    parts = df.select(F.col(vector).cast("array<double>").alias("v")).filter("v IS NOT NULL").mapInArrow(sums, "s array<double>, n long")
    rows = parts.select(F.posexplode("s").alias("i", "x"), "n").groupBy("i").agg((F.sum("x") / F.sum("n")).alias("m"), F.sum("n").alias("n")).collect()  # a row a position
    return [r["m"] for r in sorted(rows, key=lambda r: r["i"])], max((r["n"] for r in rows), default=0)


def _vectors(part: pd.DataFrame, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Identifiers, ascending, and vectors of length 1, as they are and less the centre."""
    part = part.sort_values("id")
    raw = np.stack([np.asarray(v, float) for v in part["v"]])
    raw /= np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-12)
    moved = raw - centre
    return part["id"].to_numpy(np.int64), raw, moved / np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)


def _packed(unit: DataFrame) -> DataFrame:
    """A row a block (column ``own``): identifiers, ascending, and vectors of length 1 as bytes."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        ids, raw, _ = _vectors(part, np.zeros(1))
        return pd.DataFrame({"own": [int(part["own"].iloc[0])], "ids": [ids.tobytes()], "raw": [raw.tobytes()]})

    return unit.groupBy("own").applyInPandas(pack, "own int, ids binary, raw binary")


def block_pairs(mine: DataFrame, theirs: DataFrame, blocks: int) -> GroupedData:
    """Every block of ``mine`` with every block of ``theirs`` (column ``own`` from 0, the others the same), as a group of two rows: ``mine`` is first by column ``side``.

    A pair is a group of its own, so a task holds two blocks at a time, and pairs are dealt evenly.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    columns = [c for c in mine.columns if c != "own"]
    left = mine.select(F.col("own").alias("__a"), every.alias("__b"), F.lit(0).alias("side"), *columns)
    return left.union(theirs.select(every.alias("__a"), F.col("own").alias("__b"), F.lit(1).alias("side"), *columns)).groupBy("__a", "__b")


def _largest(score: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the scores that are above ``least`` or about equal; of a row that has many the k best, the first ones of equal ones."""
    mask = score >= least[:, None] - 1e-11
    many = np.flatnonzero(np.count_nonzero(mask, axis=1) > 4 * k)
    if len(many):
        some = np.round(score[many], 12)
        last = np.partition(some, -k, axis=1)[:, -k][:, None] if some.shape[1] > k else np.full((len(many), 1), -np.inf)
        ties = some == last
        mask[many] = (some > last) | (ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= k))
    return np.divmod(np.flatnonzero(mask), score.shape[1])


def _near(score: np.ndarray, least: np.ndarray, k: int, error: float) -> np.ndarray:
    """Which of the rounded scores, off by ``error`` at most, may be among the k best of their row and reach ``least``."""
    mask = score >= np.maximum(least - 2 * error, -2)[:, None].astype(np.float32)  # what does not count is below any cosine
    many = np.flatnonzero(np.count_nonzero(mask, axis=1) > 4 * k)
    if len(many) and score.shape[1] > k:
        last = np.partition(score[many], -k, axis=1)[:, -k]
        mask[many] &= score[many] >= np.maximum(last - np.float32(4 * error), np.float32(-2))[:, None]
    return mask


def _best(mask: np.ndarray, mine: np.ndarray, theirs: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, exact scores and columns of the k best above ``least`` among those in ``mask``, for some rows at a time."""
    upto = np.cumsum(np.count_nonzero(mask, axis=1))
    cuts = np.unique(np.concatenate([[0], np.searchsorted(upto, np.arange(CANDIDATES, upto[-1], CANDIDATES)), [len(mask)]]))
    for begin, end in zip(cuts, cuts[1:], strict=False):
        row, col = np.divmod(np.flatnonzero(mask[begin:end]), mask.shape[1])
        row += begin
        # Equal vectors have equal sums here wherever they stand, which isn't so in a matrix product.
        s = np.concatenate([np.zeros(0), *((mine[row[i : i + CANDIDATES]] * theirs[col[i : i + CANDIDATES]]).sum(axis=1) for i in range(0, len(row), CANDIDATES))])
        exact = np.full((end - begin, mask.shape[1]), -np.inf) if len(row) > 8 * k * (end - begin) else None
        s = np.round(s, 12)  # equal ones stay equal whatever the block
        if exact is not None:  # many copies: of equal ones the first k
            exact[row - begin, col] = s
            row, col = _largest(exact, least[begin:end], k)
            s = exact[row, col]
            row += begin
        new = s > least[row]  # of equal ones the first is there already
        yield row[new], s[new], col[new]


def _without_more(copies: np.ndarray, k: int) -> np.ndarray:
    """The places, ascending, of vectors but for those that stand behind more than ``k`` equal ones: they are among no k best, since of equal ones the first goes before."""
    equal = np.unique(np.ascontiguousarray(copies).view(f"V{copies.dtype.itemsize * copies.shape[1]}").ravel(), return_inverse=True)[1]
    order = np.argsort(equal, kind="stable")
    place = np.arange(len(order)) - np.searchsorted(equal[order], equal[order])
    return np.sort(order[place <= k])


def best_of(mine: tuple[np.ndarray, np.ndarray, np.ndarray], theirs: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, allowed: Callable[[slice, slice], np.ndarray] | None = None) -> Iterator[pd.DataFrame]:
    """The k best of ``theirs`` for each of ``mine`` (identifiers ascending, raw and moved vectors), some rows at a time.

    Moved vectors are of length 1 at most. The product, nearly all of the work, is in single precision: of it only what may reach a row's k-th best so far,
    with the most that rounding can do, is multiplied again in double precision. ``allowed`` says which pairs of some rows of both count, if not all.
    """
    if allowed is None and theirs[2].shape[1] and (np.diff(theirs[0]) > 0).all():
        first_ones = _without_more(theirs[2], k)
        theirs = (theirs[0][first_ones], theirs[1][first_ones], theirs[2][first_ones])
    others, short = theirs[0], theirs[2].astype(np.float32)
    error = (short.shape[1] + 8) * 2.0**-23  # twice what a sum of so many products, in any order, can be off
    for at in range(0, len(mine[0]), QUERY_ROWS):
        ids, raw, moved = (x[at : at + QUERY_ROWS] for x in mine)
        few = moved.astype(np.float32)
        row, s, col = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        least = np.full(len(ids), -np.inf)
        for first in range(0, len(others), PART_ROWS):
            score, there = few @ short[first : first + PART_ROWS].T, others[first : first + PART_ROWS]
            if allowed is not None:
                score[~allowed(slice(at, at + QUERY_ROWS), slice(first, first + PART_ROWS))] = -np.inf
            begin, end = np.searchsorted(there, ids), np.searchsorted(there, ids, "right")
            while len(own := np.flatnonzero(begin < end)):
                score[own, begin[own]] = -np.inf
                begin[own] += 1
            mask = _near(score, least, k, error)
            if not mask.any():
                continue
            for r, new, c in _best(mask, moved, theirs[2][first : first + PART_ROWS], least, k):
                row, s, col = np.concatenate([row, r]), np.concatenate([s, new]), np.concatenate([col, first + c])
            order = np.lexsort((col, -s, row))  # of equal ones the smaller identifier, which stands first
            row, s, col = row[order], s[order], col[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            least[row[place == k - 1]] = s[place == k - 1]
            kept = (place < k) & np.isfinite(s)
            row, s, col = row[kept], s[kept], col[kept]
        yield pd.DataFrame({"id": ids[row], "related": others[col], "s": s, "r": (raw[row] * theirs[1][col]).sum(axis=1)})


def neighbours(df: DataFrame, id_col: str, vector: str, k: int = 8, centred: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id_col``, ``related_id``, ``similarity`` (that ranks), ``raw_similarity``, ``rank`` 1 to k; ties go to the smaller id.

    With ``centred`` the corpus mean is taken off the unit vectors first. Every row is compared with every other, as
    blocks in matrix products that give k candidates for each row and pair of blocks. A block is one row of bytes, which is shipped
    twice as often as there are blocks, so larger blocks move less.
    """
    unit = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    centre, number = np.zeros(1), 0
    if centred:
        mean, number = mean_of(unit, "v", unit=True)
        centre = np.array(mean or [0.0])
    number = number or df.count()
    blocks = max(1, -(-number // block_rows), min(df.sparkSession.sparkContext.defaultParallelism, number // LEAST_ROWS))
    unit = unit.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    out = "id long, related long, s double, r double"

    def alone(part: pd.DataFrame) -> pd.DataFrame:
        whole = _vectors(part, centre)
        return pd.concat(list(best_of(whole, whole, k)))

    def read(ids: bytes, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        numbers = np.frombuffer(ids, np.int64)
        there = np.frombuffer(raw).reshape(len(numbers), -1)
        moved = there - centre
        return numbers, there, moved / np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)

    def compare(pair: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = (read(r.ids, r.raw) for r in pair.sort_values("side").itertuples())
        return pd.concat(list(best_of(mine, theirs, k)))

    if blocks == 1:
        found = unit.groupBy("own").applyInPandas(alone, out)
    else:
        packed = _packed(unit)
        found = block_pairs(packed, packed, blocks).applyInPandas(compare, out)
    order = Window.partitionBy("id").orderBy(F.desc("s"), "related")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("id").alias(id_col), F.col("related").alias("related_id"), F.col("s").alias("similarity"), F.col("r").alias("raw_similarity"), "rank")
