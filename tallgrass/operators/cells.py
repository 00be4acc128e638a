"""Nearest neighbours by an inverted file: vectors are listed by cell, a query looks into the cells nearest to it.

Cells are trained on a bounded sample. How many cells a query looks into is measured: the true neighbours of a bounded
sample of queries, found among all vectors, tell in how many cells the wanted share of them lies. Lists of cells that lie close together are a
block, as are queries; a cell with a third of all vectors is many blocks. Two blocks meet where a query of the one looks into a cell of the
other, however many of them do, so a vector is shipped once for each block that it meets, not once for each cell. They are ranked by the vectors themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.operators.neighbours import LEAST_ROWS, best_of, mean_of
from tallgrass.staging import stage

#: Cells at most, vectors for each cell that they are trained on, and queries by which the number of cells to look into is measured.
MOST_CELLS, TRAIN_PER_CELL, MEASURED = 4096, 64, 256
#: Vectors in a block of lists, and queries in a block, at most.
LIST_ROWS, QUERY_ROWS = 32_768, 32_768
SEED = 42


@dataclass
class Index:
    """``rows``: ``id``, ``cell`` and vectors of length 1 (``raw``). ``centre`` is taken off them before they are compared."""

    rows: DataFrame
    number: int
    centre: np.ndarray
    centres: np.ndarray
    probes: int

    def moved(self, raw: np.ndarray) -> np.ndarray:
        out = raw - self.centre
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def near(self, moved: np.ndarray) -> np.ndarray:
        """The cells in the order in which a query looks into them."""
        return np.argsort(0.5 * (self.centres**2).sum(axis=1) - moved @ self.centres.T, axis=1, kind="stable")


def _array(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))


def _smallest(size: int, *columns: str) -> Column:
    """A filter for about ``size`` rows, chosen by the hash of the columns, of as many as are counted."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < size


def build(df: DataFrame, id_col: str, vector: str, cells: int | None = None, k: int = 8, recall: float = 0.95, probes: int | None = None) -> Index:
    """An index of all vectors of ``df``; about the root of their number of cells, if not given. Rows without identifier or vector are left out.

    ``probes`` cells are looked into, or as many as held ``recall`` of the ``k`` nearest neighbours of MEASURED vectors.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = _array(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-12))], ["id", "raw"])

    rows = stage(rows.mapInArrow(units, "id long, raw array<double>"), "units")
    mean, number = mean_of(rows, "raw")
    cells = max(1, min(cells or math.isqrt(number), MOST_CELLS, number))
    centre = np.array(mean or [0.0])

    index = Index(rows, number, centre, np.zeros((1, len(centre))), 1)
    without_rows = replace(index, rows=None)  # what tasks need of it

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_lists(without_rows.moved(_array(batch.column(0))))], ["moved"])

    if cells > 1:
        sample = rows.filter(_smallest((1 << 30) * min(1.0, cells * TRAIN_PER_CELL / max(number, 1)), "id")).select("raw")
        sample = stage(sample.mapInArrow(moved, "moved array<double>"), "sample").select(array_to_vector("moved").alias("v"))
        index.centres = np.array(KMeans(k=cells, seed=SEED, maxIter=10, featuresCol="v").fit(sample).clusterCenters())  # MOST_CELLS at most
    of_cells = replace(index, rows=None)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = of_cells.near(of_cells.moved(_array(batch.column(1))))[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell.astype(np.int32)), batch.column(1)], ["id", "cell", "raw"])

    index.rows = stage(rows.mapInArrow(placed, "id long, cell int, raw array<double>"), "cells")
    index.probes = probes or len(index.centres)
    if probes is None and cells > 1:
        index.probes = _measured(index, number, k, recall)
    return index


def _measured(index: Index, number: int, k: int, recall: float) -> int:
    """Cells that a query has to look into for ``recall`` of its ``k`` nearest neighbours."""
    asked = index.rows.filter(_smallest((1 << 30) * min(1.0, 2 * MEASURED / number), "id")).limit(MEASURED).select("id", "raw").toArrow()
    if not len(asked):
        return 1
    ids, own = asked.column("id").to_numpy(), replace(index, rows=None)
    queries = own.moved(np.array(asked.column("raw").to_pylist()))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_s, kept_c = np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int32)
        for batch in batches:
            s = queries @ own.moved(_array(batch.column(2))).T
            s[ids[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
            s, c = np.concatenate([kept_s, s], axis=1), np.concatenate([kept_c, np.broadcast_to(batch.column(1).to_numpy(), s.shape)], axis=1)
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            kept_s, kept_c = np.take_along_axis(s, top, 1), np.take_along_axis(c, top, 1)
        q, j = np.nonzero(np.isfinite(kept_s))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(kept_s[q, j]), pa.array(kept_c[q, j])], ["q", "s", "cell"])

    found = index.rows.select("id", "cell", "raw").mapInArrow(best, "q long, s double, cell int")
    order = Window.partitionBy("q").orderBy(F.desc("s"), "cell")
    found = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).select("q", "cell").toArrow()  # MEASURED times k
    if not len(found):
        return 1
    ranks = np.argsort(own.near(queries), axis=1)
    needed = np.sort(ranks[found.column("q").to_numpy(), found.column("cell").to_numpy()])
    return int(needed[min(len(needed), math.ceil(recall * len(needed))) - 1]) + 1


def _close(centres: np.ndarray, some: np.ndarray) -> list[int]:
    """The cells ``some`` in an order in which close ones stand together: halved along their main direction, again and again."""
    if len(some) < 3:
        return some.tolist()
    rest = centres[some] - centres[some].mean(axis=0)
    order = some[np.argsort(rest @ np.linalg.svd(rest, full_matrices=False)[2][0], kind="stable")]
    return _close(centres, order[: len(some) // 2]) + _close(centres, order[len(some) // 2 :])


def _blocks(index: Index, rows: DataFrame, most: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``rows`` with their block ``own``, of about ``most`` rows, and for each cell its first block and their number, 0 where it is empty.

    Cells that lie close together share a block; a cell with more rows has blocks of its own, filled by the hash of the identifiers.
    """
    sizes = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # MOST_CELLS at most
    first, number, at, filled = np.zeros(len(index.centres), np.int64), np.zeros(len(index.centres), np.int64), 0, 0
    for cell in _close(index.centres, np.arange(len(index.centres))):
        if size := sizes.get(cell, 0):
            if filled and filled + size > most:
                at, filled = at + 1, 0
            first[cell], number[cell] = at, -(-size // most)
            at, filled = (at + number[cell], 0) if size >= most else (at, filled + size)
    table = rows.sparkSession.createDataFrame([(c, int(first[c]), int(number[c])) for c in sizes], "cell int, first long, number long")
    dealt = rows.join(F.broadcast(table), "cell").withColumn("own", F.col("first") + F.pmod(F.xxhash64("id"), F.col("number")))
    return dealt.drop("first", "number"), first, number


def _packed(rows: DataFrame) -> DataFrame:
    """A row a block: identifiers, ascending, cells and vectors as bytes."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        return pd.DataFrame({"own": part["own"].iloc[:1], "ids": [part["id"].to_numpy(np.int64).tobytes()], "cells": [part["cell"].to_numpy(np.int32).tobytes()], "raw": [np.stack(part["raw"].tolist()).tobytes()]})

    return stage(rows.groupBy("own").applyInPandas(pack, "own long, ids binary, cells binary, raw binary"), "blocks")


def search(index: Index, queries: DataFrame | None = None, k: int = 8) -> DataFrame:
    """``id``, ``related_id``, ``similarity`` (by which it ranks, less the centre), ``raw_similarity`` and ``rank`` 1 to ``k`` for the index's rows whose ``id`` is in ``queries``, or for all.

    Equal ones are in the order of their identifiers. The similarities are exact; a neighbour is missing where its cell was not looked into.
    """
    own, share = replace(index, rows=None), -(-index.number // index.rows.sparkSession.sparkContext.defaultParallelism)
    upto = lambda most: min(most, max(share, LEAST_ROWS))
    listed, first, number = _blocks(index, index.rows, upto(LIST_ROWS))
    lists = _packed(listed)
    asking, asked = listed, lists
    if queries is not None or upto(QUERY_ROWS) != upto(LIST_ROWS):
        some = index.rows if queries is None else index.rows.join(queries.select("id").distinct(), "id", "left_semi")
        asking = _blocks(index, some, upto(QUERY_ROWS))[0]
        asked = _packed(asking)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[int, np.ndarray] = {}  # cells by block of queries
        for batch in batches:
            cell, block = own.near(own.moved(_array(batch.column(1))))[:, : own.probes], batch.column(0).to_numpy()
            for a in np.unique(block).tolist():
                wanted.setdefault(a, np.zeros(len(first), bool))[cell[block == a].ravel()] = True
        for a, cells in wanted.items():
            found = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.arange(first[c], first[c] + number[c]) for c in np.flatnonzero(cells))]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), a)), pa.array(found)], ["a", "b"])

    def read(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.frombuffer(row.ids, np.int64)
        raw = np.frombuffer(row.raw).reshape(len(ids), -1)
        return ids, raw, own.moved(raw)

    def compare(pair: pd.DataFrame) -> pd.DataFrame:
        left, right = pair.sort_values("side").itertuples()
        mine, theirs, cell, looks = read(left), read(right), np.frombuffer(right.cells, np.int32), {}

        def allowed(some: slice, others: slice) -> np.ndarray:
            if some.start not in looks:  # of the rows at hand only
                looks.clear()
                order = own.near(mine[2][some])
                looks[some.start] = np.zeros(order.shape, bool)
                np.put_along_axis(looks[some.start], order[:, : own.probes], True, axis=1)
            return looks[some.start][:, cell[others]]

        return pd.concat(list(best_of(mine, theirs, k, allowed if own.probes < len(own.centres) else None)))

    if own.probes < len(own.centres):
        pairs = asking.select("own", "raw").mapInArrow(meet, "a long, b long").distinct()
    else:
        pairs = asked.select(F.col("own").alias("a")).join(lists.select(F.col("own").alias("b")))
    pairs = stage(pairs, "pairs")  # two numbers for two blocks
    both = [rows.join(F.broadcast(pairs), F.col("own") == F.col(end)).select("a", "b", F.lit(side).alias("side"), "ids", "cells", "raw") for side, rows, end in ((0, asked, "a"), (1, lists, "b"))]
    found = both[0].union(both[1]).groupBy("a", "b").applyInPandas(compare, "id long, related long, s double, r double")
    order = Window.partitionBy("id").orderBy(F.desc("s"), "related")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("id", F.col("related").alias("related_id"), F.col("s").alias("similarity"), F.col("r").alias("raw_similarity"), "rank")


def recall_of(found: DataFrame, exact: DataFrame) -> float:
    """The share of the exact neighbours (``id``, ``related_id``) that were found."""
    total = exact.count()
    return exact.join(found.select("id", "related_id"), ["id", "related_id"], "left_semi").count() / max(total, 1)
