"""The mixing model against a plain version of it, decision by decision."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tallgrass.llm import lm_scoring as lm
from tallgrass.llm.textops import chunks

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def symbols(text):
    return [*(text or "").encode().translate(LOW), lm.END]


def code_words(code):
    """The decisions of every symbol, as text."""
    return {s: "".join("01"[int(b)] for b in code.bit[code.at[r] : code.at[r] + code.length[r]]) for s, r in enumerate(code.rank.astype(int))}


class Plain:
    """Counts in dictionaries, and one decision after the other."""

    def __init__(self, code, mixer, texts):
        self.words, self.mixer, self.after = code_words(code), mixer, defaultdict(Counter)
        for text in texts:
            line = [lm.END] * lm.ORDERS + symbols(text)
            for i in range(lm.ORDERS, len(line)):
                for k in range(lm.ORDERS + 1):
                    self.after[tuple(line[i - k : i])][line[i]] += 1

    def bits(self, context, symbol, own):
        """Of ``symbol`` after all of ``context``, nearest last."""
        total, word = 0.0, self.words[symbol]
        steps = len(lm.SEEN_STEPS) + 1
        for i, bit in enumerate(word):
            chance, odds, gate = None, [], 0
            for k in range(lm.ORDERS + 1):
                seen = self.after[tuple(context[len(context) - k :])]
                came = max(0, sum(n for s, n in seen.items() if self.words[s].startswith(word[:i])) - own)
                went = max(0, sum(n for s, n in seen.items() if self.words[s].startswith(word[: i + 1])) - own)
                chance = (went + 0.4) / (came + 0.8) if chance is None else (went + lm.INHERIT * chance) / (came + lm.INHERIT)
                chance = min(max(chance, 1e-5), 1 - 1e-5)
                odds.append(math.log(chance / (1 - chance)))
                if came:
                    gate = k * steps + sum(came > x for x in lm.SEEN_STEPS)
            mixed = min(max(float(self.mixer.weights[gate] @ odds), -16), 16)
            step = min(max(round(((mixed if bit == "1" else -mixed) + 8) * 2), 0), lm.MAP_STEPS - 1)
            again = (self.mixer.map[0, gate, step] + 8 / (1 + math.exp(8 - step / 2))) / (self.mixer.map[1, gate, step] + 8)
            total -= math.log2(0.5 / (1 + math.exp(-mixed)) + 0.5 * (again if bit == "1" else 1 - again))
        return total


def split(text):
    """Segments of a text and its rest, as bytes."""
    column = pa.array([text])
    for chunk in chunks(column):
        words = chunk.words(lower=True)
        starts, ends, _, _ = lm.segments(chunk, words)
        last = int(ends[-1]) if len(ends) else 0
        return [words.data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], words.data[last:].tobytes()


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeåé", k=rng.randint(1, 9))) for _ in range(120)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 120))) for _ in range(110)]
    return [*texts, texts[5], texts[6], texts[7].upper(), "", None, "\0\0", texts[8] + "\n" + texts[9], "zzz qqq"]


def test_score_is_the_plain_models(spark, corpus, monkeypatch):
    held = lambda i: i % 5 == 1
    model = []
    learn = lm.learn_model
    monkeypatch.setattr(lm, "learn_model", lambda *a: model.append(learn(*a)) or model[0])
    monkeypatch.setattr(lm, "COMMON_RUNS", 300)  # the others are joined
    monkeypatch.setattr(lm, "COMMON_WORDS", 20)
    docs = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in lm.score(docs, F.col("doc_id") % 5 == 1).collect()}
    assert model[0].mixer.map[1].sum() > 0  # something was learned
    plain = Plain(model[0].code, model[0].mixer, [t for i, t in enumerate(corpus) if not held(i)])
    parts = {i: split(t or "") for i, t in enumerate(corpus)}
    number = Counter(s for i, (found, _) in parts.items() if not held(i) for s in found)
    copies = 0
    for i, text in enumerate(corpus):
        line, own, bits, copied = [lm.END] * lm.ORDERS + symbols(text), int(not held(i)), 0.0, 0
        costs = [plain.bits(line[: k + lm.ORDERS], line[k + lm.ORDERS], own) for k in range(len(line) - lm.ORDERS)]
        at = 0
        for s in parts[i][0]:
            whole, others = sum(costs[at : at + len(s)]), number[s] - own
            at += len(s)
            if others > 0 and math.log2(number.total() / others) < whole:
                copied, whole = copied + 1, math.log2(number.total() / others)
            bits += whole
        bits += sum(costs[at:])
        flags = len(parts[i][0]) + 1
        bits += (math.lgamma(flags + 2) - math.lgamma(copied + 1) - math.lgamma(flags - copied + 1)) / math.log(2)
        assert got[i].score == pytest.approx(-bits * math.log10(2), rel=1e-4, abs=1e-3)
        assert got[i].copied == copied
        copies += copied
    assert copies


def test_probabilities_of_the_next_symbol_add_up():
    rng = np.random.default_rng(3)
    code = lm.Code(rng.integers(0, 1000, lm.SYMBOLS) ** 2)
    assert sum(2.0 ** -code.length) == 1
    run = np.unique(rng.integers(0, 4, (400, lm.ORDERS + 1)) @ (1 << lm.WIDTH * np.arange(lm.ORDERS, -1, -1))).astype(np.uint64)
    counts = lm.Counts(lm.Counts.tables_of(run, rng.integers(0, 300, len(run)), 0))
    mixer = lm.Mixer()
    mixer.weights = rng.normal(0.2, 0.1, mixer.weights.shape)
    mixer.map = rng.integers(0, 50, mixer.map.shape) + np.array([0, 50])[:, None, None]
    for context in ([0] * lm.ORDERS, [1, 2, 3, 0, 1, 2], [200] * lm.ORDERS):
        tail = int(np.array(context) @ (1 << lm.WIDTH * np.arange(lm.ORDERS - 1, -1, -1)))
        every = (np.arange(lm.SYMBOLS, dtype=np.uint64) << np.uint64(lm.WIDTH * lm.ORDERS)) | np.uint64(tail)
        assert (2.0 ** -mixer.cost(every, counts, code)[0]).sum() == pytest.approx(1, abs=1e-5)


def near_of(texts, waves):
    batch = pa.record_batch([pa.array(texts), pa.array(waves, pa.int32())], ["text", "wave"])
    return pa.Table.from_batches([b for b in lm._gather(iter([batch])) if b.column(0)[0].as_py() == 1])


def test_waves_are_learned_online_and_all_is_counted():
    """Whatever comes together, all runs are counted by wave; a mixer that has gone through the waves codes the last one in fewer bits."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeåé", k=rng.randint(1, 9))) for _ in range(400)]
    rows = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 120))) for _ in range(600)] + ["", "\0"]
    waves = [i % (lm.WAVES + 1) - 1 for i in range(len(rows))]
    code = lm.Code(np.bincount([s for t in rows for s in symbols(t)], minlength=lm.SYMBOLS))
    batches = [pa.record_batch([pa.array(rows[i : i + 50]), pa.array(waves[i : i + 50], pa.int32())], ["text", "wave"]) for i in range(0, len(rows), 50)]
    sent = pa.Table.from_batches(list(lm._count(iter(batches), code, 3)))
    want = defaultdict(Counter)
    for text, wave in zip(rows, waves, strict=True):
        for chunk in chunks(pa.array([text])):
            for run in lm.runs(chunk, code.rank).tolist():
                want[run][wave] += 1
    blocks = [lm._merged(sent.filter(pc.equal(sent["bucket"], b))).column("block")[0].as_py() for b in range(3)]
    got = {}
    for block in blocks:
        run, numbers = lm.unpacked(block, lm.WAVES)
        got |= {r: {w: int(n) for w, n in enumerate(column) if n} for r, column in zip(run.tolist(), numbers.T, strict=True)}
    assert got == {r: {w: n for w, n in by.items() if w >= 0} for r, by in want.items()}

    table = near_of([t for t, w in zip(rows, waves, strict=True) if w >= 0], [w for w in waves if w >= 0])
    keys, n = table["key"].to_numpy().astype(np.uint64), table["n"].to_numpy()
    wave_of, keys = (keys >> np.uint64(27)).astype(int), keys & np.uint64((1 << 27) - 1)
    near = [lm.Counts.tables_of(*lm.near_counts(keys[wave_of < w], n[wave_of < w], code.rank), 0, lm.NEAR) for w in range(lm.WAVES + 1)]
    mixer = lm._learn(blocks, code, near)
    bits = lambda m: sum((m.cost(run[new], lm.Counts(near[-2] | lm.Counts.tables_of(run[old], numbers[:-1].sum(axis=0)[old], lm.NEAR + 1)), code)[0] * numbers[-1][new]).sum() for run, numbers in (lm.unpacked(b, lm.WAVES) for b in blocks) for new, old in [(numbers[-1] > 0, numbers[:-1].sum(axis=0) > 0)])
    assert mixer.learned > 0 and bits(mixer) < 0.99 * bits(lm.Mixer())
    again = lm.Mixer.from_sums(mixer.parameters() * 2)
    assert np.allclose(again.weights, mixer.weights, atol=1e-4) and np.allclose(again.map, 2 * mixer.map, atol=2)


def test_what_is_gathered_grows_with_the_corpus(spark):
    rng = random.Random(7)
    text = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz     .,", k=3000))
    size = []
    for n in (5, 20):
        texts = [text() for _ in range(n)]
        want = {tuple(line[i - lm.ORDERS : i + 1]) for t in texts for line in [[lm.END] * lm.ORDERS + symbols(t)] for i in range(lm.ORDERS, len(line))}
        rows = spark.createDataFrame([(t, i % 5) for i, t in enumerate(texts)], "text string, wave int")
        costs = lm.learn_model(rows, near_of(texts, [i % 5 for i in range(n)])).costs
        assert costs.count() == len(want) and costs.agg(F.sum("n")).first()[0] == sum(len(t) + 1 for t in texts)
        size.append(len(want))
    assert size[1] > 3 * size[0]
