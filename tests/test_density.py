"""Density clusters against a brute-force hierarchy over all pairs of rows."""

import math

import numpy as np
import pandas as pd
import pytest

from tallgrass.operators import density


def brute_distances(vectors, min_samples):
    v = np.array(vectors, float)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    s = np.round(v @ v.T, 12)
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors):
            if list(a) == list(b):
                s[i, j] = 1.0
    n = len(v)
    others = np.sort(np.where(np.eye(n, dtype=bool), -np.inf, s), axis=1)[:, ::-1]
    core = others[:, min(min_samples, n - 1) - 1] if n > 1 else np.ones(n)
    reach = np.minimum(np.minimum(s, core[:, None]), core[None, :])
    return np.maximum(np.sqrt(np.maximum(2 - 2 * reach, 0)), density.LEAST_DISTANCE)


def brute_tree(d):
    """Prim's lengths."""
    n = len(d)
    best, out, seen = d[0].copy(), [], {0}
    while len(seen) < n:
        i = min((i for i in range(n) if i not in seen), key=lambda i: best[i])
        out.append(best[i])
        seen.add(i)
        best = np.minimum(best, d[i])
    return sorted(out)


def brute_clusters(d, min_cluster):
    """From the top: components of the rows at every length, the parts with enough rows, and the choice of the most stable ones."""

    def parts(rows, length):
        left, out = set(rows), []
        while left:
            todo, seen = [left.pop()], set()
            while todo:
                i = todo.pop()
                seen.add(i)
                near = {j for j in left if d[i, j] < length}
                left -= near
                todo += near
            out.append(sorted(seen))
        return out

    def walk(rows, birth):
        """Stability of the cluster, the best of it, and the chosen clusters."""
        left, stable = rows, 0.0
        while True:
            lengths = [d[i, j] for i in left for j in left if i < j]
            length = max(brute_tree(d[np.ix_(left, left)])) if len(left) > 1 else math.inf
            assert lengths
            found = [p for p in parts(left, length)]
            large = [p for p in found if len(p) >= min_cluster]
            stable += (1 / length - birth) * (len(left) - (len(large[0]) if len(large) == 1 else 0))
            if len(large) == 1:
                left = large[0]
                continue
            below = [walk(p, 1 / length) for p in large]
            inner = sum(b[0] for b in below)
            if stable >= inner:
                return stable, [rows]
            return inner, [c for b in below for c in b[1]]

    rows = list(range(len(d)))
    if len(rows) < min_cluster:
        return []
    # The root is no cluster: what counts are its parts.
    left = rows
    while True:
        length = max(brute_tree(d[np.ix_(left, left)])) if len(left) > 1 else math.inf
        large = [p for p in parts(left, length) if len(p) >= min_cluster]
        if len(large) != 1:
            return [c for p in large for c in walk(p, 1 / length)[1]]
        left = large[0]


def clouds(rng, copies):
    centres = rng.normal(size=(4, 6))
    spread = [0.05, 0.1, 0.2, 0.1]
    rows = [c + s * rng.normal(size=6) for c, s, n in zip(centres, spread, (25, 18, 22, 9), strict=True) for _ in range(n)]
    rows += [rng.normal(size=6) for _ in range(15)]
    rows = [[float(x) for x in r.round(3)] for r in rows]
    return rows + [rows[3]] * copies + [rows[40]] * 2 + [[2 * x for x in rows[3]]]


@pytest.mark.parametrize(("seed", "copies", "min_cluster", "min_samples", "band", "local", "block"), [(1, 0, 5, 3, 10**6, 10**5, 8192), (2, 12, 6, 6, 40, 0, 40), (3, 30, 10, 2, 10**6, 10**5, 64)])
def test_against_brute_force(spark, monkeypatch, seed, copies, min_cluster, min_samples, band, local, block):
    """One band and many, links followed on the driver and by joins, one block and many; copies enough for a cluster of their own."""
    monkeypatch.setattr(density, "LOCAL_PARTS", local)
    vectors = clouds(np.random.default_rng(seed), copies)
    rows = [(i * 2, v, 1, "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, topic_id int, core string").repartition(3)
    d = brute_distances(vectors, min_samples)
    points, tree, own = density.reachability(df, "vec_id", "embedding", min_samples, spare=0, block_rows=block)
    lengths = [r[0] for r in tree.select(density._distance(tree["s"])).collect()]
    copies_of = {}
    for i, v in enumerate(vectors):
        copies_of.setdefault(tuple(v), []).append(i)
    firsts = [g[0] for g in copies_of.values()]
    assert np.allclose(sorted(lengths), brute_tree(d[np.ix_(firsts, firsts)]), atol=1e-9)
    assert own.count() == len(rows) and points.count() == len(firsts)
    found = density.density_clusters(df, "vec_id", "embedding", min_cluster, min_samples, band, block).collect()
    assert len(found) == len(rows)
    want = sorted(brute_clusters(d, min_cluster), key=lambda c: (-len(c), c))
    assert len(want) >= 2
    expected = {i * 2: k for k, c in enumerate(want) for i in c}
    assert {r.vec_id: r.topic_id for r in found} == {i: expected.get(i, -1) for i, *_ in rows}


def test_ways_out_of_a_pair_of_blocks():
    """A pair of blocks is a group of its own; a block without open points has no way out."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(6, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    parts = np.array([0, 0, 2, 0, 4, 4])
    row = lambda side, some: {"side": side, "ids": np.arange(6)[some].tobytes(), "parts": parts[some].tobytes(), "cores": np.ones(6)[some].tobytes(), "vs": v[some].tobytes()}
    assert density._ways_out(pd.DataFrame([row(1, slice(0, 6))])).empty
    got = density._ways_out(pd.DataFrame([row(1, slice(0, 6)), row(0, slice(0, 3))]))
    s = np.where(parts[:3, None] == parts[None], -np.inf, np.round(v[:3] @ v.T, 12))
    assert got["a"].tolist() == [0, 1, 2] and got["b"].tolist() == s.argmax(axis=1).tolist() and np.allclose(got["s"], s.max(axis=1))


def test_little(spark):
    """No rows, one, equal ones only, rows without vector or identifier."""
    make = lambda rows: spark.createDataFrame(rows, "id long, v array<double>")
    assert density.density_clusters(make([]), "id", "v", 2).collect() == []
    assert [tuple(r) for r in density.density_clusters(make([(1, [1.0, 0.0])]), "id", "v", 2).collect()] == [(1, -1)]
    same = make([(i, [1.0, 0.0]) for i in range(5)] + [(None, [0.0, 1.0]), (9, None)])
    assert {tuple(r) for r in density.density_clusters(same, "id", "v", 2).collect()} == {*((i, -1) for i in range(5)), (None, -1), (9, -1)}
    two = make([(i, [1.0, 0.0]) for i in range(5)] + [(i, [0.0, 1.0]) for i in range(10, 14)] + [(2, [1.0, 0.0])])
    found = [tuple(r) for r in density.density_clusters(two, "id", "v", 3).collect()]
    assert sorted(found) == sorted([(i, 0) for i in range(5)] + [(2, 0)] + [(i, 1) for i in range(10, 14)])
    with pytest.raises(ValueError, match="two rows"):
        density.density_clusters(two, "id", "v", 1)
