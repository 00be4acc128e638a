"""The tree of average linkage: rounds by joins against the plain tree on the driver."""

import numpy as np
import pytest

from tallgrass.operators import linkage


def rows_of(df):
    return [(r.step, r.part_a, r.part_b, r.node, r.leaves, r.distance) for r in df.orderBy("step").collect()]


def same(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], abs=1e-9)


def test_rounds_give_the_plain_tree(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(90, 6)) + 3 * rng.normal(size=(6, 6))[rng.integers(0, 6, 90)]
    df = spark.createDataFrame([(7 * i - 20, v.tolist()) for i, v in enumerate(vectors)] + [(None, [1.0] * 6), (1000, None)], "id int, v array<double>")
    want = rows_of(linkage.merge_tree(df, "id", "v"))
    assert len(want) == 89 and want[-1][4] == 90
    same(rows_of(linkage.merge_tree(df, "id", "v", local_groups=30, block_rows=20)), want)  # some rounds, the rest on the driver
    same(rows_of(linkage.merge_tree(df, "id", "v", local_groups=1, block_rows=17)), want)


def test_equal_vectors_and_few_rows(spark):
    rows = [(i, [1.0, 0.0]) for i in range(6)] + [(i, [0.0, 1.0]) for i in range(6, 9)] + [(9, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for local in (1, 4, 100):
        got = rows_of(linkage.merge_tree(df, "id", "v", local_groups=local, block_rows=3))
        assert [g[5] for g in got] == pytest.approx([0.0] * 7 + [1.0] * 2) and got[-1][4] == 10
        # Every node is made before it is a part, and a part once.
        parts = [p for g in got for p in g[1:3]]
        assert len(set(parts)) == len(parts) and all(p < g[3] for g in got for p in g[1:3])
        assert [g[3] for g in got] == list(range(10, 19))
    for few in (0, 1):
        for local in (0, 1, 5):
            assert rows_of(linkage.merge_tree(df.limit(few), "id", "v", local_groups=local)) == []
