"""Ranked search, canonical digests and whitening against plain versions, on rows with every awkward case."""

import hashlib
import math
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest

from tallgrass.llm import canonical_digest, embedding_whitening, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute_search(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, words = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b, size in bags:
            m = 25 + (75 * size * n) // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms(text) if t in b)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return out


@pytest.fixture(scope="module")
def corpus(texts):
    rng = random.Random(4)
    copies = ["samma text hela vägen", "samma text hela VÄGEN"] * 40  # ties at the edge of the result
    common = [" ".join(rng.choices(["en", "två", "tre", "fyra", "fem"], k=rng.randint(1, 30))) for _ in range(150)]
    rows = list(enumerate([*texts, *copies, *common]))
    rng.shuffle(rows)
    return [*rows, rows[3], (None, "samma text utan nummer"), (None, None)]


ITEMS = [(1, "samma text hela vägen"), (2, "en två tre fyra fem en en"), (3, None), (4, ""), (5, "finns-inte"), (None, "sol1 hav2 vind3 berg4"), (1, "ett TVÅ åäö é 𝔘nicode"), (7, "t " * 50 + "lång" * 20_000)]


@pytest.mark.parametrize("limits", [(1 << 19, 1 << 16, 1 << 18, 1 << 18), (300, 1 << 16, 4, 16), (1 << 19, 7, 1 << 18, 64)])
def test_ranked_search(spark, monkeypatch, corpus, limits):
    """One segment or many, one block of items or many, wide and narrow steps: the same result."""
    for name, value in zip(("SEGMENT_POSTINGS", "SEGMENT_DOCS", "BLOCK_TERMS", "STEP_ROOTS"), limits, strict=True):
        monkeypatch.setattr(ranked_search, name, value)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus], "doc_id long, text string, rank int, item string").repartition(3)
    items = spark.createDataFrame([(i, t, 5) for i, t in ITEMS], "item_id long, text string, score int")
    got = [tuple(r) for r in ranked_search.search(docs, items).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_search(corpus, ITEMS)))


def test_search_of_names_and_of_nothing(spark):
    docs = spark.createDataFrame([("b", "ett två"), ("a", "ett två"), ("c", "tre"), ("d", "fyra")], "name string, body string")
    items = spark.createDataFrame([("q", "två")], "ask string, body string")
    found = ranked_search.search(docs, items, 1, "name", "ask", "body").collect()
    assert [tuple(r)[:3] for r in found] == [("q", 1, "a")]
    for some, asked in ((docs.limit(0), items), (docs, items.limit(0))):
        assert ranked_search.search(some, asked, 1, "name", "ask", "body").collect() == []


def test_treaps_prune():
    """Children have at most their parent's impact and stay on their side; a rare term's documents make most others unreachable."""
    rng = np.random.default_rng(2)
    sizes = np.array([5000, 40, 1])
    docs = np.concatenate([np.sort(rng.choice(8000, s, replace=False)) for s in sizes]).astype(np.int32)
    impacts = np.concatenate([np.arange(5000) // 3, rng.integers(0, 9, 41)])  # ascending, with ties: the worst order for a tree
    trees = ranked_search.treaps(docs, impacts, sizes)
    firsts = np.cumsum([0, *sizes])
    for i, root in enumerate(trees.roots):
        seen, todo = [], [(root, -1, 10**9)]
        while todo:
            node, low, high = todo.pop()
            assert low < docs[node] < high
            seen.append(node)
            for child, a, b in ((trees.left[node], low, docs[node]), (trees.right[node], docs[node], high)):
                if child >= 0:
                    assert impacts[child] <= impacts[node]
                    todo.append((child, a, b))
        assert sorted(seen) == list(range(firsts[i], firsts[i + 1]))
    best = ranked_search.Best(3, np.zeros((1, 3), np.int64))
    scored = ranked_search.search_segment(trees, np.zeros(2, np.int64), np.array([0, 1]), np.array([1, 10_000]), 8000, best)
    want = Counter()
    for t, w in ((0, 1), (1, 10_000)):
        for p in range(firsts[t], firsts[t + 1]):
            want[int(docs[p])] += w * int(impacts[p])
    assert list(zip(best.scores[0], best.docs[0], strict=True)) == [(s, d) for d, s in sorted(want.items(), key=lambda x: (-x[1], x[0]))[:3]]
    assert scored < 100


def canon(text):
    normal = lambda t: unicodedata.normalize("NFKC", t)
    return re.sub(r"\s+", " ", normal(normal(text or "").casefold())).strip()


FORMS = ["é", "é", "É  ", " ﬁ x", "FI X", "ﬁ\n\nx", "Straße", "STRASSE", "Å̧", "Å̧", "가", "가", "ｈａｌｆ", "half", "ϓ́", " ", None, "", "x\x85y", "x y", "x y", "ΑΣ ας", "ασ ασ"]


@pytest.mark.parametrize(("bits", "most"), [(64, 200_000), (3, 200_000), (0, 3)])
def test_canonical_digest(spark, monkeypatch, texts, bits, most):
    """Real hashes, ones that collide and one for all, with and without the broadcast; ties of identifiers are in the order of texts."""
    monkeypatch.setattr(canonical_digest, "BROADCAST_MEMBERS", most)
    own = [*texts, *FORMS, *FORMS] if bits == 64 else [*FORMS, *texts[:20]]
    rows = [*((i * 3, t) for i, t in enumerate(own)), (30, "samma nummer"), (30, "zz samma nummer"), (30, None), (None, "utan"), (None, "utan nummer")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, place string, head int, `range` int").repartition(3)
    got = [tuple(r) for r in canonical_digest.compare_edits(df, bits=bits).collect()]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    follow = [*order[1:], order[0]]
    want = []
    for (i, text), (_, other) in zip(order, follow, strict=True):
        text, other = text or "", other or ""
        m = len(text) // 3
        edit = text[: len(text) - m] + other[:m]
        want.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), canon(text), canon(edit), float(canon(text) == canon(edit)), float(canon(text) == canon(other))))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:3] + r[5:] for r in got] == [r[:3] + r[5:] for r in want]
    pairs = {(w[j], g[j]) for g, w in zip(got, want, strict=True) for j in (3, 4)}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})
    plain = [tuple(r) for r in canonical_digest.digest(df).collect()] if bits == 64 else None
    assert plain is None or sorted(plain, key=repr) == sorted(((g[0], g[1], g[3]) for g in got), key=repr)


def test_digest_of_one_and_of_nothing(spark):
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    assert [tuple(r)[1:3] for r in canonical_digest.compare_edits(one).collect()] == [(6, hashlib.sha256(b"abcdab").hexdigest())]
    assert canonical_digest.compare_edits(one.limit(0)).collect() == canonical_digest.digest(one.limit(0)).collect() == []


def brute_white(rows, k):
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) and abs(256 * c) < 2**63 for c in v)]
    d = max((len(v) for _, v in fine), default=0)
    xs = [[math.floor(256 * c) for c in v] + [0] * (d - len(v)) for _, v in fine]
    distinct = [list(x) for x in {tuple(x) for x in xs}]
    n, sums = len(distinct), [sum(x[j] for x in distinct) for j in range(d)]
    deviation = [sum((n * x[j] - sums[j]) ** 2 for j in range(d)) for x in xs]
    mean = np.array([s / n for s in sums])
    centred = np.array(distinct, float) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return [i for i, _ in fine], n, deviation, values / np.trace(centred.T @ centred / n), (np.array(xs, float) - mean) @ vectors / np.sqrt(values)


def test_whitening(spark):
    rng = np.random.default_rng(3)
    spread = np.linspace(3, 0.5, 20)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate((rng.normal(size=(300, 20)) * spread).round(3))]
    rows += [rows[7]] * 100 + [(900, rows[3][1]), (None, rows[4][1])]  # hot copies, a null identifier
    rows += [(901, None), (902, [*rows[0][1][:-1], None]), (903, [float("nan")] * 20), (904, [float("inf")] * 20), (905, [1e300] * 20), (906, [0.5, 0.25]), (907, []), (908, [-0.0] * 20)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, component string, n int").repartition(3)
    got = sorted((tuple(r) for r in embedding_whitening.whiten(df).collect()), key=repr)
    ids, n, deviation, explained, white = brute_white(rows, 4)
    for c in range(4):
        own = sorted((r for r in got if r[1] == c + 1), key=lambda r: (r[0] is None, r[0] or 0, r[4]))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        assert [r[0] for r in own] == [ids[i] for i in order] and {r[2] for r in own} == {n}
        assert [int(r[3]) for r in own] == [deviation[i] for i in order]
        values = np.array([r[4] for r in own])
        sign = np.sign(values[0] * white[order[0], c])
        assert np.allclose(values, sign * white[order, c], atol=1e-9) and all(abs(r[5] - explained[c]) < 1e-12 and r[6] < 1e-9 for r in own)
    assert len(got) == 4 * len(ids)


def test_whitening_of_little(spark):
    """No rows, one distinct vector, fewer components than asked for."""
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert embedding_whitening.whiten(make(rows)).collect() == []
    found = embedding_whitening.whiten(make([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [2.0, 4.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 9), round(r.explained, 9)) for r in found) == [(1, 1, 2, 1, 1), (2, 1, 2, 1, 1), (3, 1, 2, 1, 1)]


@pytest.mark.parametrize(("d", "rank", "basis"), [(60, 60, 256), (60, 7, 256), (300, 300, 40), (5, 5, 256), (40, 40, 12)])
def test_block_lanczos(d, rank, basis):
    """Folded bases, low rank and equal eigenvalues."""
    rng = np.random.default_rng(d + rank)
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = np.concatenate([[9, 9, 9, 5, 5, 2, 1.5][: min(7, rank)], np.linspace(1, 0.1, max(0, rank - 7)), np.zeros(d - rank)])[:d]
    matrix = (q * values) @ q.T
    found, vectors, passes = embedding_whitening.leading_pairs(lambda b: matrix @ b, d, 4, max_basis=basis)
    want = np.sort(values)[::-1][:4]
    assert np.allclose(found, want, atol=1e-11) and np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-11)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 and passes < 200


def test_exact_deviations_of_large_numbers():
    x = np.array([[1 << 40, -(1 << 40)], [3, 4]])
    fit = embedding_whitening.Fit(2, 2, [int(x[:, 0].sum()), int(x[:, 1].sum())])
    want = [sum((2 * int(v) - s) ** 2 for v, s in zip(row, fit.sums, strict=True)) for row in x]
    assert fit.deviations(x) == want and list(embedding_whitening._whole(np.full((5, 1), (1 << 62) - 1))) == [5 * ((1 << 62) - 1)]
