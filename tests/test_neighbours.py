"""Blocks against blocks: the screen in single precision loses nothing."""

import numpy as np
import pandas as pd
import pytest

from tallgrass.operators import neighbours


@pytest.mark.parametrize("some", [False, True])
def test_best_of_is_exact(monkeypatch, some):
    """Scores closer than single precision can tell, a third of all vectors equal, a repeated identifier, and pairs that do not count."""
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 50)
    monkeypatch.setattr(neighbours, "PART_ROWS", 64)
    monkeypatch.setattr(neighbours, "CANDIDATES", 100)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 9))
    v[100:200] = v[7]
    v[200:240] = v[8] + 1e-9 * rng.normal(size=(40, 9))
    v[299] = 0
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    ids = np.arange(300) if not some else np.minimum(np.arange(300), 298)
    allowed = rng.random((300, 300)) < 0.5
    found = pd.concat(list(neighbours.best_of((ids, v, v), (ids, v, v), 4, (lambda a, b: allowed[a, b]) if some else None)))
    want = []
    for i in range(300):
        s = np.round((v[i] * v).sum(axis=1), 12)
        want += [(ids[i], ids[j]) for j in sorted((j for j in range(300) if ids[j] != ids[i] and (allowed[i, j] or not some)), key=lambda j: (-s[j], j))[:4]]
    assert list(zip(found["id"], found["related"], strict=True)) == want


def test_of_copies_the_first_go_on():
    v = np.repeat(np.eye(3), 50, axis=0)
    assert neighbours._without_more(v, 4).tolist() == [*range(5), *range(50, 55), *range(100, 105)]
