"""LM scoring by logistic context mixing, beside a unigram base score.

A symbol is a byte (A-Z lower-cased) or the end of a text, and is coded as the binary decisions of a prefix code, short for
frequent symbols. Predictors for the last 0 to 6 symbols count how a decision went after their context, and each hands on
to the next one what the shorter context says. Their log odds are added up with weights that a gate picks by the longest
context met before, and an adaptive map refines the sum. Weights and map are learned online: the training texts come in
waves, each as long as all before it, and the decisions of a wave are first predicted from what was counted in the waves
before, then learned from, then counted.

Counts are summed over the corpus by buckets of contexts, so no task holds the whole model, and a symbol's cost in its
context becomes a row of a table. A text costs the sum over its symbols; what is beyond the most frequent runs of
symbols is joined. Longer repetition is seen by a copy model: a text falls into segments, cut where a word's hash says so,
and a segment that occurs elsewhere in the training texts can be coded as a whole. An adaptive predictor tells which.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.textops import LOWER, Chunk, Words, chunks, span_hashes
from tallgrass.llm.workspace import stage

#: Symbols of the longest context. A run of ORDERS + 1 symbols of 9 bits is one number.
ORDERS = 6
END = 256
SYMBOLS = 257
WIDTH = 9
#: Weight, in decisions, of what the shorter context says.
INHERIT = 2.0
#: Gates: longest context met before x how often.
SEEN_STEPS = (1, 3, 12, 60)
GATES = (ORDERS + 1) * (len(SEEN_STEPS) + 1)
MAP_STEPS = 33
RATE = 0.05
#: Waves of the training texts: of 16 equal parts by hash, the wave that each belongs to. Each wave is as long as all before it.
WAVE_OF = (0, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 4, 4, 4, 4)
WAVES = 5
#: Symbols whose distinct runs a task holds before it sends them on.
HELD_SYMBOLS = 1 << 25
#: Distinct runs that are looked at together, and steps of a gate's weights in these.
SLICE, STEPS = 1 << 17, 48
#: Most runs, and most words, whose costs and counts every task holds; those of all others are joined.
COMMON_RUNS, COMMON_WORDS = 1 << 22, 1 << 19
#: Fixed-point unit of weights when they are summed over tasks: sums of whole numbers do not depend on their order.
FIXED = 1 << 16
#: Tables of repeated segments up to this number of rows are broadcast; larger ones are joined.
BROADCAST_SEGMENTS = 500_000
#: A word ends a segment if its hash is 0 modulo this.
SEGMENT_WORDS = 24
_U = np.uint64


class Code:
    """A prefix code of the symbols; a symbol's rank is its place among the code words, so each node covers a range of ranks."""

    def __init__(self, number: np.ndarray):
        heap = [(int(n) + 1, s, (s,)) for s, n in enumerate(number)]
        heapq.heapify(heap)
        depth, tick = np.zeros(SYMBOLS, np.int64), SYMBOLS
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            depth[list(a[2] + b[2])] += 1
            heapq.heappush(heap, (a[0] + b[0], tick, a[2] + b[2]))
            tick += 1
        order = np.lexsort((np.arange(SYMBOLS), depth))
        self.rank = np.zeros(SYMBOLS, np.uint64)
        self.rank[order] = np.arange(SYMBOLS, dtype=np.uint64)
        self.length = depth[order]
        # Code words as whole numbers of the deepest level, ascending with the rank.
        deepest = int(self.length.max())
        word, words = 0, []
        for n in self.length.tolist():
            words.append(word)
            word += 1 << (deepest - n)
        self.at = np.cumsum(self.length) - self.length
        low, high, bit = [], [], []
        for r, n in enumerate(self.length.tolist()):
            for j in range(1, n + 1):
                span = 1 << (deepest - j)
                first = words[r] // span * span
                low.append(int(np.searchsorted(words, first)))
                high.append(int(np.searchsorted(words, first + span)))
                bit.append(words[r] >> (deepest - j) & 1)
        #: For each decision of each rank, the ranks below the node that it leads to, and the decision.
        self.low, self.high, self.bit = np.array(low, np.int16), np.array(high, np.int16), np.array(bit, bool)

    def decisions(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of symbols one after another: the first decision of each, the symbol of each decision, and its place in ``low``, ``high``, ``bit``."""
        n = self.length[ranks]
        first = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(ranks)), n)
        return first, owner, np.arange(len(owner)) + (self.at[ranks] - first)[owner]


def runs(chunk: Chunk, rank: np.ndarray, context: int = ORDERS) -> np.ndarray:
    """For each symbol of each text, its end included: its rank before those of ``context`` symbols, nearest first, as one number.

    In front of a text stand ends. The symbol has the highest bits, so that ascending runs have all contexts side by side.
    """
    ends = chunk.offsets[1:] + np.arange(chunk.rows)
    line = np.empty(len(chunk.data) + chunk.rows, np.uint64)
    text = np.ones(len(line), bool)
    text[ends] = False
    line[text] = rank[LOWER[chunk.data]]
    line[ends] = rank[END]
    run = line.copy()
    for k in range(1, context + 1):
        run <<= _U(WIDTH)
        run[k:] |= line[:-k]
    # The first symbols of a row have seen the row before.
    starts = np.concatenate([[0], ends[:-1] + 1])
    for i in range(context):
        at = (starts + i)[starts + i <= ends]
        run[at] = line[at]
        for k in range(1, context + 1):
            run[at] = (run[at] << _U(WIDTH)) | (line[at - k] if k <= i else rank[END])
    return run


def rows_of(chunk: Chunk) -> np.ndarray:
    """The row of each symbol."""
    return np.repeat(np.arange(chunk.rows), np.diff(chunk.offsets) + 1)


def table_keys(part: np.ndarray, k: int) -> np.ndarray:
    """Of symbols with ``k`` symbols of context: the context in the high bits and the symbol's rank in the low ones."""
    return ((part & _U((1 << WIDTH * k) - 1)) << _U(WIDTH)) | (part >> _U(WIDTH * k))


def summed(keys: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, number = keys[order], number[order]
    if not len(keys):
        return keys, number
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(number, first)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


class Counts:
    """How often each symbol followed each context, for contexts of some lengths: ascending keys and running sums."""

    def __init__(self, tables: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.tables = {}
        for k, (keys, n) in tables.items():
            context = keys >> _U(WIDTH)
            edges = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
            self.tables[k] = keys, np.concatenate([[0], np.cumsum(n)]), context[edges], np.append(edges, len(keys)).astype(np.int32)

    @staticmethod
    def tables_of(run: np.ndarray, number: np.ndarray, least: int, most: int = ORDERS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """From ascending runs of ``most`` symbols of context."""
        out = {}
        for k in range(most, least - 1, -1):
            order = np.argsort(keys := table_keys(run, k), kind="stable")
            out[k] = keys[order], number[order]
            if k > least and len(run):
                run = run >> _U(WIDTH)
                first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
                run, number = run[first], np.add.reduceat(number, first)
        return out

    def visits(self, keys: np.ndarray, k: int, code: Code, first: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the decisions of ``keys`` (ascending for each symbol): how often the context came to the node, and how often it then went as here."""
        held, running, contexts, edges = self.tables[k]
        went = np.zeros(len(owner), np.float32)
        if not len(held):
            return went, went.copy()
        context = keys >> _U(WIDTH)
        place = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        a = edges[place]
        b = np.where(contexts[place] == context, edges[place + 1], a)
        total = (running[b] - running[a]).astype(np.float32)
        one = np.flatnonzero((b == a + 1)[owner])  # after most long contexts came one symbol only
        if len(one):
            own, node = owner[one], at[one]
            then = (held[np.minimum(a, len(held) - 1)] & _U((1 << WIDTH) - 1)).astype(np.int16)[own]
            went[one] = np.where((code.low[node] <= then) & (then < code.high[node]), total[own], 0)
        more = np.flatnonzero((b > a + 1)[owner])
        if len(more):
            base, node = (context << _U(WIDTH))[owner[more]], at[more]
            went[more] = running[np.searchsorted(held, base + code.high[node].astype(np.uint64))] - running[np.searchsorted(held, base + code.low[node].astype(np.uint64))]
        came = np.empty_like(went)
        came[1:] = went[:-1]
        came[first] = total
        return came, went


def _pieces(run: np.ndarray) -> Iterator[np.ndarray]:
    """Places of ascending runs, about SLICE at a time: a mixed lot of symbols, but together those with equal near contexts."""
    number = -(-len(run) // SLICE)
    at = ((run >> _U(WIDTH * 3)) * _U(0x9E3779B97F4A7C15) >> _U(40)) % _U(max(number, 1))
    for piece in range(number):
        if len(found := np.flatnonzero(at == _U(piece))):
            yield found


class Mixer:
    """Weights by gate, and the map that refines the mixed log odds by gate."""

    def __init__(self) -> None:
        self.weights = np.zeros((GATES, ORDERS + 1))
        self.weights[np.arange(GATES), np.arange(GATES) // (len(SEEN_STEPS) + 1)] = 1  # the longest context that was met
        self.moved = np.full(self.weights.shape, 0.01)
        self.map = np.zeros((2, GATES, MAP_STEPS))  # ones and all, by step of the log odds
        self.learned = 0

    @staticmethod
    def predict(run: np.ndarray, counts: Counts, code: Code, owns: tuple[int, ...] = (0,)) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """For the decisions of ascending distinct runs, log odds of going as here (a row for each predictor) and gate; then decision and run.

        For each of ``owns`` that much is taken off all visits: the occurrence that is to be predicted. What depends on a
        short context is computed once for all runs that share it.
        """
        whole, owner, at = code.decisions((run >> _U(WIDTH * ORDERS)).astype(np.int64))
        steps = np.arange(len(owner), dtype=np.int32)
        out = [(np.empty((ORDERS + 1, len(owner)), np.float32), np.zeros(len(owner), np.int8)) for _ in owns]
        state: list[tuple[np.ndarray, np.ndarray]] = []
        shorter = None
        for k in range(ORDERS + 1):
            part = run >> _U(WIDTH * (ORDERS - k))
            new = np.concatenate([[True], part[1:] != part[:-1]])
            part = part[new]
            first, of, node = (whole, owner, at) if k == ORDERS else code.decisions((part >> _U(WIDTH * k)).astype(np.int64))
            came, went = counts.visits(table_keys(part, k), k, code, first, of, node)
            place = np.cumsum(new) - 1
            up = None
            if shorter is not None:  # the same decision after the context without its last symbol
                up = (shorter[0][shorter[1][new]] - first).astype(np.int32)[of] + steps[: len(of)]
            before, state = state, []
            for i, own in enumerate(owns):
                c, w = (np.maximum(came - own, 0), np.maximum(went - own, 0)) if own else (came, went)
                chance = (w + np.float32(0.4)) / (c + np.float32(0.8)) if up is None else (w + np.float32(INHERIT) * before[i][0][up]) / (c + np.float32(INHERIT))
                np.clip(chance, 1e-5, 1 - 1e-5, out=chance)
                odds = np.log(chance / (1 - chance))
                gate = np.full(len(c), k * (len(SEEN_STEPS) + 1), np.int8)
                for least in SEEN_STEPS:
                    gate += c > least
                if up is not None:
                    gate = np.where(c > 0, gate, before[i][1][up])
                elif k == 0:
                    gate[c == 0] = 0
                state.append((chance, gate))
                if k == ORDERS:
                    out[i][0][k], out[i][1][:] = odds, gate
                else:
                    out[i][0][k] = odds[(first[place] - whole).astype(np.int32)[owner] + steps]
            shorter = first, place
        return out, code.bit[at], owner

    def mixed(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total, weights = np.zeros(odds.shape[1], np.float32), self.weights.astype(np.float32)
        for k in range(ORDERS + 1):
            total += weights[:, k][gate] * odds[k]
        return np.clip(total, -16, 16, out=total)

    @staticmethod
    def step(mixed: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """The map's step, by the log odds of a one."""
        return np.clip(np.rint((np.where(bit, mixed, -mixed) + 8) * 2), 0, MAP_STEPS - 1).astype(np.int64)

    def learn(self, run: np.ndarray, number: np.ndarray, counts: Counts, code: Code) -> None:
        """Predict the decisions of distinct runs, and move the weights and the map by how they went. A gate's weights move in up to STEPS steps a slice."""
        for piece in _pieces(run):
            [(odds, gate)], bit, owner = self.predict(run[piece], counts, code)
            weight = number[piece].astype(np.float32)[owner]
            order = np.argsort(gate, kind="stable")
            edges = np.searchsorted(gate[order], np.arange(GATES + 1))
            for g in np.flatnonzero(edges[1:] > edges[:-1]):
                mine = order[edges[g] : edges[g + 1]]
                steps = min(STEPS, -(-len(mine) // 256))
                parts = [mine[i::steps] for i in range(steps)]  # a mixed lot of symbols in each
                mine = np.concatenate(parts)
                x, w, ones, mixed = odds[:, mine], weight[mine], bit[mine], np.empty(len(mine), np.float32)
                to = 0
                for i in range(steps):
                    some, to = slice(to, to + len(parts[i])), to + len(parts[i])
                    mixed[some] = np.clip(self.weights[g].astype(np.float32) @ x[:, some], -16, 16)
                    push = (x[:, some] @ (w[some] / (1 + np.exp(mixed[some])))) / w[some].sum()  # the decision went as here
                    self.moved[g] += push * push
                    self.weights[g] += RATE * push / np.sqrt(self.moved[g])
                key = self.step(mixed, ones)
                self.map[0, g] += np.bincount(key, w * ones, MAP_STEPS)
                self.map[1, g] += np.bincount(key, w, MAP_STEPS)
        self.learned += int(number.sum())

    def cost(self, run: np.ndarray, counts: Counts, code: Code) -> np.ndarray:
        """Bits of the symbol of each of ascending distinct runs after its context; in the second row, with one occurrence less counted."""
        total = np.zeros((2, len(run)))
        centre = 1 / (1 + np.exp(8 - np.arange(MAP_STEPS) / 2))
        refined = (self.map[0] + 8 * centre) / (self.map[1] + 8)
        for piece in _pieces(run):
            both, bit, owner = self.predict(run[piece], counts, code, (0, 1))
            for own, (odds, gate) in enumerate(both):
                mixed = self.mixed(odds, gate)
                again = refined[gate, self.step(mixed, bit)]
                chance = 0.5 / (1 + np.exp(-mixed.astype(float))) + 0.5 * np.where(bit, again, 1 - again)
                total[own, piece] = np.bincount(owner, -np.log2(chance), len(piece))
        return total

    def parameters(self) -> np.ndarray:
        """Weights times what was learned from, that amount, and the map, as whole numbers that can be added up over tasks."""
        return np.rint(np.concatenate([FIXED * self.learned * self.weights.ravel(), [self.learned], self.map.ravel()])).astype(np.int64)

    @staticmethod
    def from_sums(sums: np.ndarray) -> Mixer:
        out, n = Mixer(), GATES * (ORDERS + 1)
        if sums[n]:
            out.weights = (sums[:n] / (FIXED * float(sums[n]))).reshape(out.weights.shape)
            out.map = sums[n + 1 :].astype(float).reshape(out.map.shape)
        return out


class Distinct:
    """The distinct runs of a stream of symbols with their numbers, merged as they come."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, run: np.ndarray) -> None:
        if not len(run):
            return
        run = np.sort(run)
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        self.held.append((run[first], np.diff(first, append=len(run))))
        while len(self.held) > 3 and 4 * len(self.held[-1][0]) > len(self.held[-4][0]):
            last = self.held[-4:]
            self.held[-4:] = [summed(np.concatenate([h[0] for h in last]), np.concatenate([h[1] for h in last]))]

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All so far, ascending; none is kept."""
        held, self.held = self.held, []
        if not held:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))


def bucket_of(run: np.ndarray, buckets: int) -> np.ndarray:
    """A number below ``buckets`` for the three nearest symbols of the context."""
    near = (run >> _U(WIDTH * (ORDERS - 3))) & _U((1 << 3 * WIDTH) - 1)
    return (((near * _U(0x9E3779B97F4A7C15)) >> _U(32)) % _U(buckets)).astype(np.int64)


#: Contexts up to this length are counted before, and every task has their counts: at most SYMBOLS ** (NEAR + 1) numbers.
NEAR = 2



def packed(run: np.ndarray, *numbers: np.ndarray) -> bytes:
    """Ascending runs and columns of numbers: differences, byte planes apart, compressed."""
    columns = [np.diff(run, prepend=_U(0)).astype("<u8"), *[n.astype("<u4") for n in numbers]]
    planes = [c.view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in columns]
    return len(run).to_bytes(8, "little") + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(block: bytes, columns: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The runs, and their numbers as (columns, n)."""
    n = int.from_bytes(block[:8], "little")
    planes = np.frombuffer(pa.decompress(block[8:], (8 + 4 * columns) * n, codec="zstd", asbytes=True), np.uint8).reshape(-1, n)
    column = lambda a, b, kind: np.ascontiguousarray(planes[a:b].T).view(kind).ravel()
    return np.cumsum(column(0, 8, "<u8"), dtype=np.uint64), np.stack([column(8 + 4 * i, 12 + 4 * i, "<u4").astype(np.int64) for i in range(columns)])


def _count(batches: Iterator[pa.RecordBatch], code: Code, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a partition's distinct runs by bucket and wave; those of held-out texts (wave -1) with the number 0."""
    found, symbols = {wave: Distinct() for wave in range(-1, WAVES)}, 0

    def blocks() -> Iterator[pa.RecordBatch]:
        for wave, distinct in found.items():
            run, number = distinct.take()
            if wave < 0:
                number = np.zeros_like(number)
            bucket = bucket_of(run, buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            run, number = run[order], number[order]
            used = [b for b in range(buckets) if edges[b] < edges[b + 1]]
            for at in range(0, len(used), 64):
                some = used[at : at + 64]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([max(wave, 0)] * len(some), pa.int32()), pa.array([packed(run[edges[b] : edges[b + 1]], number[edges[b] : edges[b + 1]]) for b in some], pa.binary())], ["bucket", "wave", "block"])

    for batch in batches:
        waves = batch.column(1).to_numpy()
        for chunk in chunks(batch.column(0)):
            run = runs(chunk, code.rank)
            own = waves[chunk.first : chunk.first + chunk.rows]
            each = own[rows_of(chunk)] if (own != own[0]).any() else None
            for wave in np.unique(own):
                found[int(wave)].add(run if each is None else run[each == wave])
            symbols += len(run)
            if symbols >= HELD_SYMBOLS:
                yield from blocks()
                symbols = 0
    yield from blocks()


def _merged(part: pa.Table) -> pa.Table:
    """One block of a bucket's runs, with a column of numbers for each wave."""
    waves = np.array(part.column("wave").to_pylist())
    pairs = [unpacked(b) for b in part.column("block").to_pylist()]
    run = _distinct(np.concatenate([p[0] for p in pairs]))
    numbers = np.zeros((WAVES, len(run)), np.int64)
    for wave, (own, number) in zip(waves, pairs, strict=True):
        numbers[wave, np.searchsorted(run, own)] += number[0]
    return pa.table({"bucket": part.column("bucket")[:1], "block": pa.array([packed(run, *numbers)], pa.binary())})


def _learn(blocks: list[bytes], code: Code, near: list[dict]) -> Mixer:
    """A mixer that has gone through the waves of some buckets: ``near`` has the counts of near contexts before each wave."""
    mixer = Mixer()
    for wave in range(1, WAVES):
        for block in blocks:
            run, numbers = unpacked(block, WAVES)
            before = numbers[:wave].sum(axis=0)
            known, new = before > 0, numbers[wave] > 0
            if known.any() and new.any():
                mixer.learn(run[new], numbers[wave][new], Counts(near[wave] | Counts.tables_of(run[known], before[known], NEAR + 1)), code)
    return mixer


class Model:
    """A learned model: the code, the mixer, and a table with the costs of all runs."""

    def __init__(self, code: Code, mixer: Mixer, costs: DataFrame):
        self.code, self.mixer, self.costs = code, mixer, costs


def near_counts(keys: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From runs of symbol values to ascending runs of ranks."""
    run = np.zeros(len(keys), np.uint64)
    for k in range(NEAR + 1):
        run = (run << _U(WIDTH)) | rank[((keys >> _U(WIDTH * (NEAR - k))) & _U((1 << WIDTH) - 1)).astype(np.int64)]
    return summed(run, n)


def learn_model(rows: DataFrame, near: pa.Table) -> Model:
    """Fit on ``text`` of ``rows`` by ``wave``, -1 for what is not learned from. ``near`` has ``key`` (wave, then a run of NEAR symbols of context by their values) and ``n``.

    The model's ``costs`` have a row for every run that any of the texts has: ``run``, ``n`` (in training texts), ``cost``,
    ``own_cost`` (with one occurrence less), in COST_UNIT.
    """
    spark = rows.sparkSession
    keys, n = near.column("key").to_numpy().astype(np.uint64), near.column("n").to_numpy()
    waves, keys = (keys >> _U(WIDTH * (NEAR + 1))).astype(np.int64), keys & _U((1 << WIDTH * (NEAR + 1)) - 1)
    code = Code(np.bincount((keys >> _U(WIDTH * NEAR)).astype(np.int64), n, SYMBOLS).astype(np.int64))
    low = [Counts.tables_of(*near_counts(keys[waves < w], n[waves < w], code.rank), 0, NEAR) for w in range(WAVES + 1)]
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = rows.select("text", "wave").mapInArrow(lambda batches: _count(batches, code, buckets), "bucket int, wave int, block binary")
    blocks = stage(blocks.groupBy("bucket").applyInArrow(_merged, "bucket int, block binary"), "lm-counts")
    shared = spark.sparkContext.broadcast((code, low))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, low = shared.value
        mixer = _learn([b for batch in batches for b in batch.column(0).to_pylist()], code, low)
        if mixer.learned:
            sums = mixer.parameters()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], ["i", "n"])

    spread = blocks.repartition(max(1, buckets // 4), "bucket").select("block")
    sums = spread.mapInArrow(learn, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()  # a row for each parameter
    mixer = Mixer.from_sums(sums.set_index("i")["n"].sort_index().to_numpy()) if len(sums) else Mixer()

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, low = shared.value
        for batch in batches:
            for block in batch.column(0).to_pylist():
                run, numbers = unpacked(block, WAVES)
                number = numbers.sum(axis=0)
                known = number > 0
                counts = Counts(low[WAVES] | Counts.tables_of(run[known], number[known], NEAR + 1))
                cost = np.rint(mixer.cost(run, counts, code) / COST_UNIT).astype(np.int32)
                for at in range(0, len(run), 1 << 16):
                    some = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(run[some].view(np.int64)), pa.array(number[some]), pa.array(cost[0, some]), pa.array(cost[1, some])], ["run", "n", "cost", "own_cost"])

    return Model(code, mixer, stage(spread.mapInArrow(price, "run long, n long, cost int, own_cost int"), "lm-costs"))


def most_frequent(table: DataFrame, number: str, most: int) -> int:
    """The least value of ``number`` from which the rows are not more than ``most``."""
    least, rows = 1, 0
    for r in table.filter(F.col(number) > 0).groupBy(number).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc(number)).limit(most).collect():
        rows += r["rows"]
        if rows > most:
            return r[number] + 1
    return least


#: Costs are kept in this share of a bit.
COST_UNIT = 1 / 1024
#: In a table of costs, that there is none. Larger costs don't go into the table.
NO_COST = 0xFFFF


class CostTable:
    """Costs of frequent runs: a small table of the most frequent ones, which stays in a processor's cache, a large one, and a list.

    Runs go by a hash: its upper bits are the slot, its lower 32 the check, so of lookups of runs that are not held one in
    four thousand million finds another's cost. What loses its slot goes to the next table, and at last to the list.
    """

    HOT = 1 << 18

    def __init__(self, run: np.ndarray, costs: np.ndarray):
        """``run`` with ascending frequency; ``costs`` in COST_UNIT, below NO_COST, in two rows."""
        self.tables: list[tuple[int, np.ndarray]] = []
        hot = max(0, len(run) - self.HOT)
        waiting, left = np.arange(hot, len(run)), np.arange(hot)
        for _ in range(2):
            bits = max(4, int(2 * len(waiting)).bit_length())
            mixed = self.mixed(run[waiting])
            slot = (mixed >> _U(64 - bits)).astype(np.int32)
            # Check, and the two costs, as one number.
            entry = (mixed << _U(32)) | (costs[1, waiting].astype(np.uint64) << _U(16)) | costs[0, waiting].astype(np.uint64)
            table = np.full(1 << bits, NO_COST, np.uint64)
            table[slot] = entry
            self.tables.append((bits, table))
            waiting, left = np.sort(np.concatenate([left, waiting[table[slot] != entry]])), left[:0]
        waiting = waiting[np.argsort(run[waiting])]
        self.rest, self.rest_costs = run[waiting], costs[:, waiting]

    @staticmethod
    def mixed(run: np.ndarray) -> np.ndarray:
        out = run * _U(0x9E3779B97F4A7C15)
        out ^= out >> _U(32)
        out *= _U(0xD6E8FEB86659FD93)
        return out

    def find(self, run: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cost of each run, by whether its own occurrence is counted; and which runs are not held, with cost 0."""
        cost, some, mixed, mine = None, None, self.mixed(run), own
        for bits, table in self.tables:
            entry = table[(mixed >> _U(64 - bits)).astype(np.int32)]
            found = (entry >> (mine * _U(16))).astype(np.uint16)
            lost = np.flatnonzero(((entry >> _U(32)) != (mixed & _U(0xFFFFFFFF))) | (found == NO_COST))
            if cost is None:
                cost, some = found, lost
            else:
                cost[some] = found
                some = some[lost]
            mixed, mine = mixed[lost], mine[lost]
        cost[some] = 0
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, run[some]), len(self.rest) - 1)
            good = self.rest[at] == run[some]
            cost[some[good]] = self.rest_costs[own[some[good]].astype(np.int64), at[good]]
            some = some[~good]
        return cost, some


def segments(chunk: Chunk, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the segments, and the hash of each: a word whose hash is 0 modulo SEGMENT_WORDS ends one. A row's rest is none."""
    last = np.flatnonzero(words.hashes % _U(SEGMENT_WORDS) == 0)
    ends, rows = words.ends[last], words.rows[last]
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.concatenate([[True], rows[1:] != rows[:-1]]) if len(ends) else np.zeros(0, bool)
    starts = np.where(first, chunk.offsets[rows], starts)
    return starts, ends, rows, span_hashes(words.data, starts, ends)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of a partition's words by their 64-bit hashes (kind 0), in parts when there are many, and of the runs of NEAR symbols of context by wave (kind 1)."""
    held, numbers, size = [], [], 0
    plain, near = np.arange(SYMBOLS, dtype=np.uint64), Distinct()

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), 1 << 16):
            some = keys[at : at + (1 << 16)].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind, np.int32)), pa.array(some), pa.array(n[at : at + (1 << 16)])], ["kind", "key", "n"])

    for batch in batches:
        waves = batch.column(1).to_numpy()
        for chunk in chunks(batch.column(0)):
            wave = waves[chunk.first : chunk.first + chunk.rows].astype(np.uint64)[rows_of(chunk)]
            near.add((wave << _U(WIDTH * (NEAR + 1))) | runs(chunk, plain, NEAR))
            keys, n = np.unique(chunk.words(lower=True).hashes, return_counts=True)
            held.append(keys)
            numbers.append(n)
            size += len(keys)
            if size > 3_000_000:
                keys, n = summed(np.concatenate(held), np.concatenate(numbers))
                held, numbers, size = [keys], [n], len(keys)
                if size > 1_500_000:
                    yield from rows(0, keys, n)
                    held, numbers, size = [], [], 0
    if size:
        yield from rows(0, *summed(np.concatenate(held), np.concatenate(numbers)))
    yield from rows(1, *near.take())


def _small(table: DataFrame) -> DataFrame:
    """``table`` (staged), marked for broadcast where its number of rows allows it."""
    return F.broadcast(table) if table.limit(BROADCAST_SEGMENTS + 1).count() <= BROADCAST_SEGMENTS else table


#: The table of the last model that a worker has scored with.
_TABLES: dict[str, CostTable] = {}


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: identifier, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte``, ``copied``.

    ``score`` is the log10 probability of the lower-cased (A-Z) text with its end; ``copied`` the number of its segments that
    are coded as copies. Rows where ``held_out`` holds are not learned from. Of a training text each occurrence of a
    run or segment is predicted without itself, from all others. Null texts count as empty: one token, the end. Without
    training texts every count is 0 and the predictors know nothing. Repeated rows are scored alike, and count as
    often as they come where they are learned from; null identifiers are learned from unless ``held_out`` says otherwise.
    An empty table gives none.
    """
    spark = docs.sparkSession
    out = F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), out.alias("held_out"))
    wave = F.get(F.lit(list(WAVE_OF)), F.pmod(F.xxhash64("id", "text"), F.lit(len(WAVE_OF))).cast("int"))
    rows = rows.withColumn("wave", F.when(F.col("held_out"), -1).otherwise(wave))
    train = rows.filter(~F.col("held_out"))
    gathered = stage(train.select("text", "wave").mapInArrow(_gather, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-words")
    vocabulary = gathered.filter("kind = 0").select(F.col("key").alias("w"), F.col("n").alias("c"))
    model = learn_model(rows, gathered.filter("kind = 1").select("key", "n").toArrow())  # WAVES * SYMBOLS ** 3 rows at most

    ends = train.count()
    totals = vocabulary.agg(F.sum("c"), F.count(F.lit(1))).first()
    tokens, distinct = (totals[0] or 0) + ends, totals[1] + (ends > 0)
    common = vocabulary.filter(F.col("c") >= most_frequent(vocabulary, "c", COMMON_WORDS)).toArrow()
    words = common.column("w").to_numpy().view(np.uint64)
    order = np.argsort(words)
    words, logs = words[order], np.log10(common.column("c").to_numpy()[order] + 0.5)
    short = lambda c: (F.col(c) - 32768).cast("short").alias(c)
    common = model.costs.filter(F.col("n") >= most_frequent(model.costs, "n", COMMON_RUNS)).filter(F.greatest("cost", "own_cost") < NO_COST)
    common = common.orderBy("n", "run").select("run", short("cost"), short("own_cost")).toArrow()
    frequent = common.column("run").to_numpy().view(np.uint64), np.stack([(common.column(c).to_numpy() ^ np.int16(-32768)).view(np.uint16) for c in ("cost", "own_cost")])
    del common
    shared = spark.sparkContext.broadcast((model.code.rank, frequent, words, logs))
    end_log, key = math.log10(ends + 0.5), uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, frequent, common, logs = shared.value
        if key not in _TABLES:
            _TABLES.clear()
            _TABLES[key] = CostTable(*frequent)
        table = _TABLES[key]
        for batch in batches:
            held = np.array(batch.column(2).to_pylist(), bool)
            for chunk in chunks(batch.column(1)):
                words = chunk.words(lower=True)
                hashes = words.hashes
                at = np.minimum(np.searchsorted(common, hashes), max(len(common) - 1, 0))
                known = common[at] == hashes if len(common) else np.zeros(len(hashes), bool)
                part = np.bincount(words.rows[known], logs[at[known]], chunk.rows) + end_log
                rare, rare_rows = hashes[~known].view(np.int64), words.rows[~known]

                run, row = runs(chunk, rank), rows_of(chunk)
                cost, lost = table.find(run, ~held[chunk.first : chunk.first + chunk.rows][row])
                upto = np.concatenate([[0], np.cumsum(cost, dtype=np.int64)])
                starts, ends_, seg_rows, seg_hashes = segments(chunk, words)
                bits = (upto[ends_ + seg_rows] - upto[starts + seg_rows]).astype(np.int32)
                edges = np.searchsorted(seg_rows, np.arange(chunk.rows + 1))
                whole = np.diff(upto[np.concatenate([[0], chunk.offsets[1:] + np.arange(1, chunk.rows + 1)])])
                lost_rows = row[lost]
                lost_segments = np.searchsorted(ends_ + seg_rows, lost, "right") - edges[lost_rows]

                lists = lambda of, values: pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(chunk.rows + 1)).astype(np.int32)), pa.array(values))  # noqa: E731, B023
                own = batch.slice(chunk.first, chunk.rows)
                columns = [
                    own.column(0), own.column(2), pa.array(words.per_row + 1), pa.array(np.bincount(words.rows[known], minlength=chunk.rows) + int(ends > 0)), pa.array(part), pa.array(np.diff(chunk.offsets)), lists(rare_rows, rare),
                    pa.array(whole), lists(seg_rows, seg_hashes.view(np.int64)), lists(seg_rows, bits), lists(lost_rows, run[lost].view(np.int64)), lists(lost_rows, lost_segments.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "part", "bytes", "rare", "cost", "seg_hashes", "seg_costs", "runs", "run_segments"])

    kind = docs.schema[id_col].dataType.simpleString()
    scanned = rows.drop("wave").mapInArrow(scan, f"id {kind}, held_out boolean, n_tokens long, n_known long, part double, bytes long, rare array<long>, cost long, seg_hashes array<long>, seg_costs array<int>, runs array<long>, run_segments array<int>")
    scanned = stage(scanned.withColumn("row", F.monotonically_increasing_id()), "lm-scan")

    rare = scanned.select("row", F.explode("rare").alias("w")).join(vocabulary, "w", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("rare_part"), F.count("c").alias("rare_known"))

    # Segments that occur in training texts, and elsewhere: most do not, and only these are looked at one by one.
    parts = scanned.select("row", "held_out", F.posexplode(F.arrays_zip("seg_hashes", "seg_costs")).alias("segment", "s")).select("row", "held_out", "segment", F.col("s.seg_hashes").alias("h"), F.col("s.seg_costs").alias("cost"))
    seen = stage(parts.groupBy("h").agg(F.count_if(~F.col("held_out")).alias("c"), F.count(F.lit(1)).alias("m")).filter("m > 1 and c > 0").drop("m"), "lm-segments")
    number = scanned.filter(~F.col("held_out")).agg(F.sum(F.size("seg_hashes"))).first()[0] or 1
    others = F.col("c") - F.when(F.col("held_out"), 0).otherwise(1)
    again = stage(parts.join(_small(seen), "h").select("row", "segment", "cost", others.alias("others")).filter("others > 0"), "lm-repeated")
    # Costs of the runs that are not in the table of common ones: by row, and apart for those segments.
    rest = scanned.select("row", "held_out", F.explode(F.arrays_zip("runs", "run_segments")).alias("s")).select("row", "held_out", F.col("s.runs").alias("run"), F.col("s.run_segments").alias("segment"))
    rest = rest.join(model.costs.select("run", F.col("cost").alias("c0"), F.col("own_cost").alias("c1")), "run").select("row", "segment", F.when(F.col("held_out"), F.col("c0")).otherwise(F.col("c1")).alias("more"))
    rest = rest.join(_small(again.select("row", "segment", F.lit(True).alias("apart"))), ["row", "segment"], "left").groupBy("row", F.when(F.col("apart"), F.col("segment")).alias("segment")).agg(F.sum("more").alias("more"))
    rest = stage(rest, "lm-rest")
    copy = F.log2(F.lit(float(number)) / F.col("others"))
    each = again.join(rest.filter("segment is not null"), ["row", "segment"], "left").withColumn("bits", (F.col("cost") + F.coalesce("more", F.lit(0))) * F.lit(COST_UNIT))
    each = each.filter(copy < F.col("bits")).groupBy("row").agg(F.sum(F.col("bits") - copy).alias("saved"), F.count(F.lit(1)).alias("copied"))
    more = rest.groupBy("row").agg(F.sum("more").alias("more"))

    all_rows = scanned.join(more, "row", "left").join(each, "row", "left").join(rare, "row", "left").withColumn("copied", F.coalesce("copied", F.lit(0).cast("long")))
    # The predictor of copies has counts of its own, one of each kind to begin with: a! b! / (a + b + 1)! for a copies among a + b segments, the rest one of these.
    logs_to = lambda n: F.aggregate(F.sequence(F.lit(1).cast("long"), n), F.lit(0.0), lambda s, i: s + F.log2(i))
    flags, fresh = F.size("seg_hashes").cast("long") + 1, F.size("seg_hashes").cast("long") + 1 - F.col("copied")
    told = F.when(F.col("copied") == 0, F.log2(flags + 1)).otherwise(logs_to(flags + 1) - logs_to(F.col("copied")) - logs_to(fresh))
    bits = (F.col("cost") + F.coalesce("more", F.lit(0))) * F.lit(COST_UNIT) - F.coalesce("saved", F.lit(0.0)) + told
    unit = math.log10(tokens + 0.5 * (distinct + 1))
    return all_rows.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("rare_part", F.lit(0.0)) - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (-bits * F.lit(math.log10(2))).alias("score"),
        (bits / F.greatest(F.col("bytes"), F.lit(1))).alias("bits_per_byte"),
        "copied",
    )
