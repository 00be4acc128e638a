"""The map that keeps neighbourhoods: weights against a plain version, reruns, and how many neighbours are kept."""

import math

import numpy as np
import pytest

from tallgrass.operators import layout, topics
from tallgrass.operators.neighbours import neighbours


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(8, 12))
    rows = [(i, [float(x) for x in centres[i % 8] + 0.4 * rng.normal(size=12)], "p", 1.0) for i in range(320)]
    return spark.createDataFrame([*rows, *((900 + i, rows[0][1], "p", 1.0) for i in range(5)), (None, rows[1][1], "p", 1.0), (999, None, "p", 1.0)], "id long, v array<double>, p string, w double").repartition(3)


def test_weights(spark, vectors):
    near = neighbours(vectors.filter("id IS NOT NULL AND v IS NOT NULL"), "id", "v", 6, centred=False)
    own = {}
    for r in near.collect():
        own.setdefault(r.id, []).append((max(1 - r.similarity, 0), r.related_id))
    plain = {}
    for i, found in own.items():
        first = min((d for d, _ in found if d > 0), default=0)
        low, high = 0.0, 1e6
        for _ in range(200):
            rate = (low + high) / 2
            low, high = (low, rate) if sum(math.exp(-max(d - first, 0) / rate) for d, _ in found) > math.log2(len(found)) else (rate, high)
        rate = max(rate, 1e-3 * sum(d for d, _ in found) / len(found), 1e-12)
        for d, j in found:
            plain[i, j] = math.exp(-max(d - first, 0) / rate)
    want = {}
    for (i, j), w in plain.items():
        back = plain.get((j, i), 0)
        want[min(i, j), max(i, j)] = w + back - w * back
    got = {(r.a, r.b): r.weight for r in layout.fuzzy_links(near).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def kept(rows, places, k=10):
    """The share of the nearest neighbours that are nearest on the map too."""
    v = np.array([r.v for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    p = np.array(places)
    near = np.argsort(-(v @ v.T) + 9 * np.eye(len(v)), axis=1)[:, :k]
    there = np.argsort(((p[:, None] - p[None]) ** 2).sum(axis=2) + 1e9 * np.eye(len(p)), axis=1)[:, :k]
    return np.mean([len(set(a) & set(b)) / k for a, b in zip(near, there, strict=True)])


@pytest.mark.parametrize("block", [20_000, 120])
def test_neighbours_are_kept(spark, vectors, block):
    found = topics.neighbourhood_map(vectors, "id", "v", 10, block_rows=block).select("id", "v", "x", "y")
    rows = sorted((r for r in found.collect() if r.x is not None), key=lambda r: r.id)
    assert len(rows) == 325 and found.count() == 327
    pca = {r.id: (r.x, r.y) for r in topics.map_2d(vectors.filter("id IS NOT NULL AND v IS NOT NULL"), "v").collect()}
    ours, plain = kept(rows, [(r.x, r.y) for r in rows]), kept(rows, [pca[r.id] for r in rows])
    assert ours > plain + 0.1
    if block > 1000:
        again = topics.neighbourhood_map(vectors.repartition(2), "id", "v", 10, block_rows=block).collect()
        assert np.allclose(sorted((r.id, r.x, r.y) for r in again if r.x is not None), [(r.id, r.x, r.y) for r in rows], atol=1e-6)


def test_little(spark):
    make = lambda rows: spark.createDataFrame(rows, "id long, v array<double>")
    assert topics.neighbourhood_map(make([]), "id", "v").collect() == []
    two = topics.neighbourhood_map(make([(4, [1.0, 0.0]), (3, [0.0, 1.0])]), "id", "v").orderBy("id").collect()
    assert [(r.x, r.y) for r in two] == [(0, 0), (1, 0)]
    a, b = layout.curve(0.1)
    assert abs(a - 1.577) < 0.05 and abs(b - 0.895) < 0.02
