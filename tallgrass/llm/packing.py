"""Packing documents into sequences by cutting-stock column generation.

Documents become token ids; what is longer than a sequence is cut into full sequences and a rest. The rests, by length in
units, are the demand of a cutting-stock problem: a linear program over patterns of lengths, where a knapsack by dynamic
programming prices new patterns until none improves it. Rounded-down patterns and a first-fit tail serve the whole
demand, and ranked documents are assigned to the patterns' places by arithmetic on their ranks.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.llm.textops import Words, chunks
from tallgrass.llm.workspace import stage

LENGTH = 2048
END_ID = 1
#: Lengths are rounded up to this many tokens in the linear program only.
UNIT = 8
MAX_COLUMNS = 6000
#: Bytes of the words whose ids a worker remembers for good, and number of those met lately.
MEMO_BYTES, YOUNG_WORDS = 16 << 20, 1 << 17
#: Words to a text when new words are encoded.
JOINED_WORDS = 500
#: Rows that go to a worker at once, and bytes of text that it works on: words, places and ids of a chunk take some thirty times its size.
BATCH_ROWS, CHUNK_BYTES = 250, 1 << 18
#: Bytes of words that keep their length when the tokenizer normalises them: printable ASCII but for the start of a
#: special token, and U+00C0 to U+01FF.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = _PLAIN[0xC3:0xC8] = _PLAIN[0x80:0xC0] = True
_PLAIN[ord("<")] = False


class Generation:
    """Words and their ids: ascending hashes, where each one's ids stand in ``arena``, and which words were met again."""

    def __init__(self) -> None:
        self.keys, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.again, self.arena = np.zeros(0, bool), np.zeros(0, np.uint32)

    def places(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each of ``wanted`` (ascending), -1 where it is not held."""
        if not len(self.keys):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at, -1)

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the words at ``places``, and their ids one after another."""
        sizes = self.sizes[places].astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        return sizes, self.arena[np.repeat(self.starts[places] - begin, sizes) + np.arange(int(sizes.sum()))]

    def add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Words that are not held yet."""
        starts = len(self.arena) + np.cumsum(sizes) - sizes
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys = np.concatenate([self.keys, keys])[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])[order]
        self.again = np.concatenate([self.again, np.zeros(len(keys), bool)])[order]
        self.arena = np.concatenate([self.arena, ids])

    def only(self, places: np.ndarray) -> Generation:
        out = Generation()
        sizes, ids = self.take(places)
        out.add(self.keys[places], sizes, ids)
        return out

    def size(self) -> int:
        return 21 * len(self.keys) + 4 * len(self.arena)


class WordIds:
    """Ids of words, as far as they are remembered each word encoded once: no token of the vocabulary goes across white space.

    New words stand in a young generation. When that is full, those met a second time move to the old one, and where the
    old one is full as well, the words not met since its last clearing go.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():  # one character a byte
            self.bytes_of[i] = len(name.removesuffix("</w>"))
        self.young, self.old = Generation(), Generation()

    def encode(self, words: Words, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of the words at ``wanted``. Plain words go through the tokenizer as texts of many, all others one by one."""
        sizes = np.zeros(len(wanted), np.int64)
        odd = np.concatenate([[0], np.cumsum(~_PLAIN[words.data])])
        plain = odd[words.ends[wanted]] == odd[words.starts[wanted]]
        dotted = np.flatnonzero((words.data[:-1] == 0xC4) & (words.data[1:] == 0xB0))  # a capital whose small form is longer
        if len(dotted):
            plain &= np.searchsorted(dotted, words.starts[wanted]) == np.searchsorted(dotted, words.ends[wanted])
        found: list[tuple[int, np.ndarray]] = []
        some = np.flatnonzero(plain)
        for at in range(0, len(some), 32 * JOINED_WORDS):
            part = some[at : at + 32 * JOINED_WORDS]
            length = words.ends[wanted[part]] - words.starts[wanted[part]]
            edge = np.cumsum(length + 1)
            line = np.full(int(edge[-1]), 0x20, np.uint8)
            line[np.arange(int(length.sum())) + np.repeat(np.arange(len(part)), length)] = words.data[np.repeat(words.starts[wanted[part]] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))]
            cuts = [*range(0, len(part), JOINED_WORDS), len(part)]
            texts = [line[(edge[a - 1] if a else 0) : edge[b - 1]].tobytes().decode() for a, b in zip(cuts, cuts[1:], strict=False)]
            codes = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.fromiter((x for c in codes for x in c), np.uint32, sum(map(len, codes)))
            upto, ends = np.cumsum(self.bytes_of[ids]), np.cumsum(length)
            last = np.searchsorted(upto, ends)
            if int(upto[-1]) == int(ends[-1]) and (upto[last] == ends).all():
                sizes[part] = np.diff(last, prepend=-1)
                found.append((at, ids))
            else:  # not one character a byte: a vocabulary of another kind
                plain[part] = False
        plain_ids = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint32)
        rest, alone = np.flatnonzero(~plain), []
        for at in range(0, len(rest), 2000):  # encodings hold far more than ids: not all at once
            alone += [e.ids for e in self.tokenizer.encode_batch_fast([words.text(i) for i in wanted[rest[at : at + 2000]]], add_special_tokens=False)]
        sizes[rest] = np.fromiter(map(len, alone), np.int64, len(alone))
        ids = np.zeros(int(sizes.sum()), np.uint32)
        own = np.repeat(plain, sizes)
        ids[own] = plain_ids
        ids[~own] = np.fromiter((x for c in alone for x in c), np.uint32, len(ids) - len(plain_ids))
        return sizes, ids

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the words of a chunk: the place of each among the distinct ones, and sizes and ids of those."""
        distinct, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        old, young = self.old.places(distinct), self.young.places(distinct)
        self.old.again[old[old >= 0]] = True
        self.young.again[young[young >= 0]] = True
        new = np.flatnonzero((old < 0) & (young < 0))
        sizes, parts = np.zeros(len(distinct), np.int64), []
        for where, (n, ids) in ((np.flatnonzero(old >= 0), self.old.take(old[old >= 0])), (np.flatnonzero(young >= 0), self.young.take(young[young >= 0])), (new, self.encode(words, first[new]))):
            sizes[where] = n
            parts.append((where, n, ids))
        begin = np.cumsum(sizes) - sizes
        arena = np.zeros(int(sizes.sum()), np.uint32)
        for where, n, ids in parts:
            arena[np.repeat(begin[where] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        if len(new):
            self.young.add(distinct[new], parts[2][1], parts[2][2])
            if len(self.young.keys) > YOUNG_WORDS:
                self.turn()
        return back, sizes, arena

    def turn(self) -> None:
        stay = self.young.only(np.flatnonzero(self.young.again))
        if self.old.size() + stay.size() > MEMO_BYTES:
            self.old = self.old.only(np.flatnonzero(self.old.again))
            if self.old.size() + stay.size() > MEMO_BYTES:
                self.old = Generation()
        self.old.add(stay.keys, stay.sizes.astype(np.int64), stay.arena)
        self.young = Generation()


_WORKER: dict[str, WordIds] = {}


def token_ids(column: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some rows at a time: the first row's place, all ids with ``END_ID`` after each row, and the edges of the rows."""
    memo = _WORKER.get(path) or _WORKER.setdefault(path, WordIds(path))
    for chunk in chunks(column, CHUNK_BYTES):
        words = chunk.words()
        back, own_sizes, own_ids = memo.of(words)
        # The end is a place of its own, behind the words of each row.
        places = np.insert(back, words.first[1:], len(own_sizes))
        sizes, starts = np.append(own_sizes, 1)[places], np.append(np.cumsum(own_sizes) - own_sizes, len(own_ids))[places]
        before = np.cumsum(sizes) - sizes
        ids = np.append(own_ids, np.uint32(END_ID))[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], words.first[1:] + np.arange(1, chunk.rows + 1)])]
        yield chunk.first, ids, edges


def cut_documents(docs: DataFrame, path: str, id_col: str, text_col: str, length: int = LENGTH) -> DataFrame:
    """``id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``: full pieces and the rest of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, edges in token_ids(batch.column(1), path):
                total = np.diff(edges)
                pieces = -(-total // length)
                row = np.repeat(np.arange(len(total)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
                size = np.minimum(total[row] - start, length)
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((edges[row] + start).tolist(), (edges[row] + start + size).tolist(), strict=True)]
                own = batch.column(0).take(pa.array(row + first))
                yield pa.RecordBatch.from_arrays([own, pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(total[row])], ["id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def _knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of ``sizes`` (ascending) that fits into ``room``."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        k = int(np.searchsorted(sizes, c, "right"))
        best[c] = best[c - 1]
        if k:
            option = best[c - sizes[:k]] + values[:k]
            i = int(option.argmax())
            if option[i] > best[c] + 1e-12:
                best[c], last[c] = option[i], i
    pattern, c = np.zeros(len(sizes)), room
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(best[room]), pattern


def patterns_for(demand: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (size to number) and how often each is used; together exactly ``demand``.

    Column generation on the linear program by the revised simplex method, then rounding down; what is left goes into
    the first pattern with room, large sizes first. Only the histogram of sizes is looked at.
    """
    sizes = np.array(sorted(s for s in demand if demand[s]), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[int(s)] for s in sizes], float)
    columns = [np.eye(len(sizes))[i] * (room // s) for i, s in enumerate(sizes)]
    inverse = np.diag(1.0 / (room // sizes))
    used = inverse @ need
    for priced in range(MAX_COLUMNS + 1):
        if priced == MAX_COLUMNS:
            warnings.warn(f"pricing ended after {MAX_COLUMNS} columns; the plan is valid, but may leave more padding", stacklevel=2)
            break
        value, pattern = _knapsack(inverse.sum(axis=0), sizes, room)
        if value <= 1 + 1e-7:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        used = np.maximum(used - ratio[out] * step, 0)
        used[out] = ratio[out]
        inverse[out] /= step[out]
        rest = np.arange(len(sizes)) != out
        inverse[rest] -= np.outer(step[rest], inverse[out])
        columns[out] = pattern
    left = need.astype(np.int64)
    plan: list[tuple[dict[int, int], int]] = []
    for pattern, times in zip(columns, used, strict=True):
        a = pattern.astype(np.int64)
        n = min([int(times + 1e-6), *(left[a > 0] // a[a > 0])])
        if n > 0:
            left -= n * a
            plan.append(({int(s): int(k) for s, k in zip(sizes, a, strict=True) if k}, n))
    bins: list[list] = []  # the rest is at most what the columns' fractions held
    for s, k in zip(sizes[::-1].tolist(), left[::-1].tolist(), strict=True):
        for _ in range(k):
            fit = min((b for b in bins if b[0] >= s), key=lambda b: b[0], default=None)
            if fit is None:
                bins.append(fit := [room, {}])
            fit[0] -= s
            fit[1][s] = fit[1].get(s, 0) + 1
    return plan + [(b[1], 1) for b in bins]


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per piece: identifier, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Null and empty texts are the end id alone. Documents up to ``length`` tokens stay whole, longer ones are cut at
    multiples of it. Repeated rows are packed as often as they come; null identifiers are packed like others. Pieces
    of a sequence lie without gaps from 0; every id of a document is in exactly one piece. An empty table gives none.
    """
    spark = docs.sparkSession
    pieces = stage(cut_documents(docs, path, id_col, text_col, length), "pieces", BATCH_ROWS)
    sized = pieces.withColumn("size", F.ceil(F.col("length") / UNIT).cast("int"))
    # Ranks within a size: numbers by (size, salt), then rows within. No task holds all rows of a size.
    histogram = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # length / UNIT rows at most
    # A part has an eighth of a task's share at most, so that parts land evenly.
    share = max(64, sum(histogram.values()) // (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salts = F.create_map(*[F.lit(x) for s, n in histogram.items() for x in (s, -(-n // share))]) if histogram else F.lit(None).cast("map<int,int>")
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), salts[F.col("size")]))
    numbers = salted.groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n"))
    below = numbers.withColumn("below", F.sum("n").over(Window.partitionBy("size").orderBy("salt")) - F.col("n")).drop("n")
    within = F.row_number().over(Window.partitionBy("size", "salt").orderBy("id", "start", "ids_crc32"))
    ranked = salted.withColumn("within", within).join(below, ["size", "salt"]).withColumn("rank", F.col("below") + F.col("within") - 1)

    full = length // UNIT
    plan = [({full: 1}, histogram[full])] if full in histogram else []
    plan += patterns_for({s: n for s, n in histogram.items() if s != full}, full)
    places, base, served = [], 0, dict.fromkeys(histogram, 0)
    for pattern, times in plan:
        for s, k in pattern.items():
            places.append((s, served[s], served[s] + k * times, k, base))
            served[s] += k * times
        base += times
    table = spark.createDataFrame(places, "of int, first long, beyond long, each int, base long")  # patterns x sizes rows, whatever the input
    here = (F.col("size") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("beyond"))
    placed = ranked.join(F.broadcast(table), here).withColumn("sequence_id", F.expr("base + (rank - first) div each"))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "id", "start", "ids_crc32")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return placed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset.alias("offset"))
