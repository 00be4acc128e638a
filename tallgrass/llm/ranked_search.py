"""Ranked lexical search with inverted treaps.

Documents are dealt into segments of bounded size. A segment holds, for each term, the documents with it in the order of their
identifiers. For a search every list becomes a treap: a binary tree in the order of the documents whose parents have at
least the impact of their children. All terms of an item walk their treaps at once. An interval of documents is bounded by the sum of the impacts
at the roots of its subtrees; where that is below the k-th best score so far, the interval goes. Else the document with the
largest part in the bound is scored by descending to it in all treaps, which also cuts each of them in two. Many intervals of many items
are worked on together by numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.llm.textops import LOWER, chunks, mix64, span_hashes
from tallgrass.llm.workspace import stage

#: A segment is closed when it holds so many postings or documents.
SEGMENT_POSTINGS, SEGMENT_DOCS = 1 << 19, 1 << 16
#: Pairs of item and term that are searched for in one pass over the segments.
BLOCK_TERMS = 1 << 18
#: Treap roots that one step works on.
STEP_ROOTS = 1 << 18

_BREAK = np.zeros(256, bool)
_BREAK[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

SEGMENT = "lengths binary, terms binary, sizes binary, docs binary, times binary"


def term_counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For pieces of a text column: the number of the first row, the terms in each row, and row, hash and times of each distinct term of a row.

    Terms are runs of ASCII digits and letters (A-Z lower-cased) and of all characters beyond ASCII.
    """
    lower = LOWER.copy()
    for chunk in chunks(column):
        starts, ends, rows = chunk.spans(_BREAK[lower[chunk.data]] | _BREAK[chunk.data])
        hashes = span_hashes(lower[chunk.data], starts, ends)
        n = np.bincount(rows, minlength=chunk.rows)
        order = np.lexsort((hashes, rows))
        rows, hashes = rows[order], hashes[order]
        first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])])[: len(rows)])
        yield chunk.first, n, rows[first], hashes[first], np.diff(np.append(first, len(rows)))


class _Open:
    """A segment that still takes documents."""

    def __init__(self) -> None:
        self.ids, self.lengths, self.rows, self.hashes, self.times, self.docs, self.postings = [], [], [], [], [], 0, 0

    def add(self, ids: pa.Array, n: np.ndarray, rows: np.ndarray, hashes: np.ndarray, times: np.ndarray) -> None:
        self.ids.append(ids)
        self.lengths.append(n)
        self.rows.append(rows + self.docs)
        self.hashes.append(hashes)
        self.times.append(times)
        self.docs, self.postings = self.docs + len(n), self.postings + len(rows)

    def close(self) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rows, hashes, times = place[np.concatenate(self.rows)], np.concatenate(self.hashes), np.concatenate(self.times)
        by = np.lexsort((rows, hashes))
        terms, sizes = np.unique(hashes[by], return_counts=True)
        parts = np.concatenate(self.lengths)[order].astype(np.int64), terms, sizes.astype(np.int32), rows[by].astype(np.int32), times[by].astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array([ids.take(pa.array(order))], pa.list_(ids.type)), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], ["ids", *(f.split()[0] for f in SEGMENT.split(", "))])


def segments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all rows and terms, in segments: identifiers in ascending order, terms of each text, and every term's documents and times.

    A null text has no term; texts without one are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Open()
        for batch in batches:
            for first, n, rows, hashes, times in term_counts(batch.column(1)):
                has = n > 0
                place = np.cumsum(has) - 1
                own.add(batch.column(0).slice(first, len(n)).filter(pa.array(has)), n[has], place[rows], hashes, times)
                if own.postings >= SEGMENT_POSTINGS or own.docs >= SEGMENT_DOCS:
                    yield own.close()
                    own = _Open()
        if own.docs:
            yield own.close()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return stage(rows.mapInArrow(build, f"ids array<{kind}>, {SEGMENT}"), "segments")


def _nearest_greater(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest one before and after it with a larger rank; the first and the last place have the largest.

    Places climb a tree of maxima until a neighbouring subtree has a larger one, and descend in it: a bounded number of steps for any order.
    """
    size = 1 << max(1, (len(rank) - 1).bit_length())
    levels = [np.full(size, np.iinfo(np.int64).max)]
    levels[0][: len(rank)] = rank
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).max(axis=1))
    inner = np.arange(1, len(rank) - 1)
    out = []
    for step in (-1, 1):
        found, at, left = np.zeros(len(rank), np.int64), inner, rank[inner]
        begun: list[tuple[np.ndarray, np.ndarray]] = []
        places = inner
        for level in levels:
            side = (at & 1) == (1 if step < 0 else 0)
            stops = side & (level[np.where(side, at + step, at)] > left)
            begun.append((places[stops], at[stops] + step))
            places, at, left = places[~stops], at[~stops] >> 1, left[~stops]
            if not len(places):
                break
        down, node = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for k in range(len(begun) - 1, -1, -1):
            down, node = np.concatenate([down, begun[k][0]]), np.concatenate([node, begun[k][1]])
            if k:
                near = 2 * node + (1 if step < 0 else 0)
                node = np.where(levels[k - 1][near] > rank[down], near, near + step)
        found[down] = node
        out.append(found)
    return out[0], out[1]


@dataclass
class Treaps:
    """The treaps of some lists, one after another: documents, impacts, both children (-1: none) of every posting, and each list's root."""

    docs: np.ndarray
    impacts: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: np.ndarray


def treaps(docs: np.ndarray, impacts: np.ndarray, sizes: np.ndarray) -> Treaps:
    """Treaps over lists of ``sizes`` postings, documents ascending in each; equal impacts are ordered by a hash, which keeps them shallow."""
    total, lists = len(docs), len(sizes)
    order = np.lexsort((mix64(docs.astype(np.uint64)), impacts))
    rank = np.empty(total, np.int64)
    rank[order] = np.arange(total)
    own = np.arange(total) + 1 + np.repeat(np.arange(lists), sizes)  # a place before each list and one at the end bound them
    fenced = np.full(total + lists + 1, total)
    fenced[own] = rank
    before, after = (x[own] for x in _nearest_greater(fenced))
    posting = np.full(len(fenced), -1)
    posting[own] = np.arange(total)
    from_left = fenced[before] < fenced[after]
    parent = posting[np.where(from_left, before, after)]
    left, right = np.full(total, -1, np.int32), np.full(total, -1, np.int32)
    at = np.flatnonzero((parent >= 0) & from_left)
    right[parent[at]] = at
    at = np.flatnonzero((parent >= 0) & ~from_left)
    left[parent[at]] = at
    roots = np.full(lists, -1)
    top = np.flatnonzero(parent < 0)
    roots[np.repeat(np.arange(lists), sizes)[top]] = top
    return Treaps(docs, impacts, left, right, roots)


def _firsts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)


@dataclass
class _Frontier:
    """Intervals (item, first and last document, both outside), and the treap roots of each: its weight and posting."""

    item: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sizes: np.ndarray
    weight: np.ndarray
    root: np.ndarray

    def some(self, kept: np.ndarray) -> _Frontier:
        each = np.repeat(kept, self.sizes)
        return _Frontier(self.item[kept], self.low[kept], self.high[kept], self.sizes[kept], self.weight[each], self.root[each])


class Best:
    """The best ``k`` scores of each item in a segment, smallest document first where they are equal, beside scores from elsewhere."""

    def __init__(self, k: int, elsewhere: np.ndarray):
        self.k, self.elsewhere = k, elsewhere
        self.scores, self.docs = np.zeros_like(elsewhere), np.full(elsewhere.shape, -1)
        self.least = np.maximum(elsewhere.min(axis=1), 1)

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        fine = score >= self.least[item]
        if not fine.any():
            return
        touched = np.unique(item[fine])
        own = np.repeat(touched, self.k)
        item = np.concatenate([own, item[fine]])
        score, doc = np.concatenate([self.scores[touched].ravel(), score[fine]]), np.concatenate([self.docs[touched].ravel(), doc[fine]])
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        places = (first[:, None] + np.arange(self.k)).ravel()  # every touched item has k at least
        self.scores[touched], self.docs[touched] = score[places].reshape(-1, self.k), doc[places].reshape(-1, self.k)
        both = np.concatenate([self.scores[touched], self.elsewhere[touched]], axis=1)
        self.least[touched] = np.maximum(np.partition(both, self.k, axis=1)[:, self.k], 1)


def _cut(trees: Treaps, root: np.ndarray, low: np.ndarray, high: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In each treap, within an interval: the posting of ``doc``, and the roots of what stands before and after it; -1 where there is none."""
    hit, before, after = np.full(len(root), -1), np.full(len(root), -1), np.full(len(root), -1)
    active, node = np.arange(len(root)), root
    while len(active):
        here, goal = trees.docs[node], doc[active]
        less, more = here < goal, here > goal
        at = active[less]
        fresh = (before[at] < 0) & (here[less] > low[at])
        before[at[fresh]] = node[less][fresh]
        at = active[more]
        fresh = (after[at] < 0) & (here[more] < high[at])
        after[at[fresh]] = node[more][fresh]
        same = ~(less | more)
        hit[active[same]] = node[same]
        following = np.where(less, trees.right[node], trees.left[node])
        on = ~same & (following >= 0)
        active, node = active[on], following[on]
    # Below the document itself the first that is inside the interval.
    for roots, child, other, outside in ((before, trees.left, trees.right, lambda d, i: d <= low[i]), (after, trees.right, trees.left, lambda d, i: d >= high[i])):
        active = np.flatnonzero((hit >= 0) & (roots < 0))
        node = child[hit[active]]
        while len(active):
            active, node = active[node >= 0], node[node >= 0]
            out = outside(trees.docs[node], active)
            roots[active[~out]] = node[~out]
            active, node = active[out], other[node[out]]
    return hit, before, after


def search_segment(trees: Treaps, item: np.ndarray, tree: np.ndarray, weight: np.ndarray, docs: int, best: Best) -> int:
    """Adds the segment's best documents for all items to ``best``; item, treap and weight of each term, items ascending. Returns the number of scored documents."""
    has = (weight > 0) & (trees.roots[tree] >= 0)
    items, sizes = np.unique(item[has], return_counts=True)
    pending = [_Frontier(items, np.full(len(items), -1), np.full(len(items), docs), sizes, weight[has], trees.roots[tree[has]])]
    scored = 0
    while pending:
        now = pending.pop()
        if not len(now.item):
            continue
        first = _firsts(now.sizes)
        bound = np.add.reduceat(trees.impacts[now.root] * now.weight, first)
        kept = bound >= best.least[now.item]
        if not kept.all():
            now, bound = now.some(kept), bound[kept]
        if not len(now.item):
            continue
        if len(now.root) > STEP_ROOTS and len(now.item) > 1:  # the better half first: it raises what the other one has to reach
            better = np.zeros(len(bound), bool)
            better[np.argsort(bound, kind="stable")[len(bound) // 2 :]] = True
            pending += [now.some(~better), now.some(better)]
            continue
        first, interval = _firsts(now.sizes), np.repeat(np.arange(len(now.item)), now.sizes)
        part = trees.impacts[now.root] * now.weight
        leads = np.flatnonzero(part == np.maximum.reduceat(part, first)[interval])
        leads = leads[np.concatenate([[True], interval[leads][1:] != interval[leads][:-1]])]
        doc = trees.docs[now.root[leads]].astype(np.int64)
        hit, before, after = _cut(trees, now.root, now.low[interval], now.high[interval], doc[interval])
        score = np.add.reduceat(np.where(hit >= 0, trees.impacts[hit] * now.weight, 0), first)
        scored += len(doc)
        best.add(now.item, doc, score)
        for roots, low, high in ((after, doc, now.high), (before, now.low, doc)):
            some = roots >= 0
            sizes = np.add.reduceat(some.astype(np.int64), first)
            on = sizes > 0
            pending.append(_Frontier(now.item[on], low[on], high[on], sizes[on], now.weight[some], roots[some]))
        if len(pending[-1].root) + len(pending[-2].root) <= STEP_ROOTS:  # few are worked on together
            a, b = pending.pop(), pending.pop()
            pending.append(_Frontier(*(np.concatenate([getattr(a, f), getattr(b, f)]) for f in ("item", "low", "high", "sizes", "weight", "root"))))
    return scored


@dataclass
class _Block:
    """Items that are searched for together: their numbers, and item (by place), term (by place) and times of each term."""

    numbers: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    item: np.ndarray
    term: np.ndarray
    times: np.ndarray


def norms(lengths: np.ndarray, n: int, words: int) -> np.ndarray:
    """25 + (75 * length * n) div words, for each length."""
    distinct, place = np.unique(lengths, return_inverse=True)
    return np.array([25 + (75 * int(x) * n) // words for x in distinct], np.int64)[place]


def impact(times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    times = times.astype(np.int64)
    return (1_000_000_000 * times) // (1000 * times + 8 * norm)


def _search(block: _Block, n: int, words: int, k: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(block.numbers)
        scores, ids = np.zeros((items, k), np.int64), np.full((items, k), None, object)
        for batch in batches:
            for r in range(len(batch)):
                names = batch.column(0)[r].values
                lengths, terms, sizes, docs, times = (np.frombuffer(batch.column(c)[r].as_buffer(), t) for c, t in ((1, np.int64), (2, np.uint64), (3, np.int32), (4, np.int32), (5, np.int32)))
                at = np.minimum(np.searchsorted(terms, block.terms), max(len(terms) - 1, 0))
                there = np.flatnonzero((terms[at] == block.terms) & (block.weights > 0)) if len(terms) else np.zeros(0, np.int64)
                tree = np.full(len(block.terms), -1)
                tree[there] = np.arange(len(there))
                begins, own = _firsts(sizes)[at[there]] if len(there) else there, sizes[at[there]].astype(np.int64) if len(there) else there
                places = np.repeat(begins - _firsts(own), own) + np.arange(int(own.sum()))
                docs, times = docs[places], times[places]
                trees = treaps(docs, impact(times, norms(lengths, n, words)[docs]), own)
                has = tree[block.term] >= 0
                best = Best(k, scores)
                search_segment(trees, block.item[has], tree[block.term[has]], block.times[has] * block.weights[block.term[has]], len(lengths), best)
                for i in np.flatnonzero((best.scores > 0).any(axis=1)):
                    found = [(-s, o is None, o, s) for s, o in zip(scores[i].tolist(), ids[i], strict=True) if s]
                    found += [(-s, o is None, o, s) for s, o in ((int(s), names[int(d)].as_py()) for s, d in zip(best.scores[i], best.docs[i], strict=True) if s)]
                    found = sorted(found, key=lambda f: f[:2] if f[1] else f[:3])[:k]
                    scores[i, : len(found)], ids[i, : len(found)] = [f[3] for f in found], [f[2] for f in found]
        i, j = np.nonzero(scores)
        yield pa.RecordBatch.from_arrays([pa.array(block.numbers[i]), pa.array(ids[i, j].tolist(), kind), pa.array(scores[i, j])], ["item", "doc", "score"])

    return run


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: the item's identifier, ``rank`` from 1, the document's identifier and ``score``.

    Every row is a document or an item of its own, repeated identifiers too. Documents without a term, null or empty texts, are
    in no result and no count; items without one have no result. Equal scores are in the order of the documents' identifiers, null ones last;
    documents with a score of 0 are left out, so that an empty table gives no rows. Terms are told apart by 64-bit hashes. Items are
    searched for in blocks of about BLOCK_TERMS terms, each in the whole index. Other columns are not read.
    """
    spark, item_kind, doc_kind = docs.sparkSession, items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, rows, hashes, times in term_counts(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + rows)), pa.array(hashes.view(np.int64)), pa.array(times.astype(np.int64))], ["item", "term", "times"])

    numbered = stage(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("name"), F.col(text_col).cast("string").alias("text")), "items")
    wanted = stage(numbered.select("item", "text").mapInArrow(asked, "item long, term long, times long"), "asked")
    blocks = -(-wanted.count() // BLOCK_TERMS)
    index = segments(docs, id_col, text_col)
    id_type = index.limit(0).toArrow().schema.field("ids").type.value_type

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                lengths, terms, sizes = (np.frombuffer(batch.column(c)[r].as_buffer(), t) for c, t in ((0, np.int64), (1, np.int64), (2, np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array([None, *terms.tolist()], pa.int64()), pa.array([len(lengths), *sizes.tolist()], pa.int64()), pa.array([int(lengths.sum()), *[0] * len(terms)], pa.int64())], ["term", "n", "words"])

    frequencies = stage(index.select("lengths", "terms", "sizes").mapInArrow(counts, "term long, n long, words long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "frequencies", 1)
    total = frequencies.filter("term IS NULL").first()
    parts = []
    for number in range(blocks if total else 0):
        own = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number) if blocks > 1 else wanted
        pairs = own.toArrow()  # about BLOCK_TERMS rows
        known = own.select("term").distinct().join(frequencies, "term").select("term", "n").toArrow()
        terms = known.column("term").to_numpy().view(np.uint64)
        order = np.argsort(terms)
        terms, weights = terms[order], np.array([weight(total.n, int(x)) for x in known.column("n").to_numpy()[order]], np.int64)
        hashes, item = pairs.column("term").to_numpy().view(np.uint64), pairs.column("item").to_numpy()
        at = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
        fine = terms[at] == hashes if len(terms) else np.zeros(len(hashes), bool)
        numbers, place = np.unique(item[fine], return_inverse=True)
        by = np.argsort(place, kind="stable")
        block = _Block(numbers, terms, weights, place[by], at[fine][by], pairs.column("times").to_numpy()[fine][by])
        if len(numbers):
            found = index.mapInArrow(_search(block, total.n, total.words, k, id_type), f"item long, doc {doc_kind}, score long")
            parts.append(stage(found, "found", 1))
    if not parts:
        return spark.createDataFrame([], f"{item_col} {item_kind}, rank int, {id_col} {doc_kind}, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "name"), "item").select(F.col("name").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


#: The same result in DuckDB.
SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL), d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
g AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM d),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY term, n_docs),
m AS (SELECT doc_id, 25 + (75 * n * n_docs) // n_words AS m FROM d, g),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
