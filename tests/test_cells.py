"""The inverted file against exact neighbours."""

import numpy as np
import pytest

from tallgrass.operators import cells
from tallgrass.operators.neighbours import neighbours


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16))
    rows = [(int(i), [float(x) for x in centres[i % 30] + 0.5 * rng.normal(size=16)]) for i in range(1500)]
    rows += [(5000 + i, rows[7][1]) for i in range(700)]  # a third of all rows are one vector
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows] + [(None, rows[0][1], 1, "x"), (9000, None, 1, "x")], "id long, v array<double>, cell int, raw string").repartition(4)


def test_recall_below_the_square(spark, vectors, monkeypatch):
    monkeypatch.setattr(cells, "LIST_ROWS", 100)
    monkeypatch.setattr(cells, "QUERY_ROWS", 150)
    exact = neighbours(vectors.filter("id IS NOT NULL AND v IS NOT NULL AND id < 5000"), "id", "v", 5).withColumnRenamed("id", "i").withColumnRenamed("i", "id").cache()
    index = cells.build(vectors.filter("id < 5000"), "id", "v", cells=60, k=5)
    assert 1 <= index.probes <= 15
    found = cells.search(index, k=5).cache()
    assert cells.recall_of(found, exact) >= 0.9
    both = found.alias("f").join(exact.alias("e"), ["id", "related_id"]).selectExpr("max(abs(f.similarity - e.similarity)) AS a", "max(abs(f.raw_similarity - e.raw_similarity)) AS b", "count(*) AS n").first()
    assert both.a < 1e-9 and both.b < 1e-9
    again = cells.search(cells.build(vectors.filter("id < 5000").repartition(2), "id", "v", cells=60, k=5, probes=index.probes), k=5)
    assert cells.recall_of(again, exact) >= 0.9


def test_all_cells_are_exact(spark, vectors, monkeypatch):
    """With every cell looked into the result is the exact one, in blocks of a hot cell too."""
    monkeypatch.setattr(cells, "LIST_ROWS", 64)
    few = vectors.filter("(id < 200 OR id >= 5600) AND v IS NOT NULL")
    exact = {tuple(r) for r in neighbours(few, "id", "v", 4).select("id", "related_id", "rank").collect()}
    index = cells.build(few, "id", "v", cells=9, probes=9)
    asked = spark.createDataFrame([(3,), (5601,), (77777,), (3,)], "id long")
    assert {tuple(r) for r in cells.search(index, asked, 4).select("id", "related_id", "rank").collect()} == {r for r in exact if r[0] in (3, 5601)}
    assert {tuple(r) for r in cells.search(index, k=4).filter("id < 5000").select("id", "related_id", "rank").collect()} == {r for r in exact if r[0] < 5000}


def test_little(spark):
    make = lambda rows: spark.createDataFrame(rows, "id long, v array<float>")
    assert cells.search(cells.build(make([]), "id", "v")).collect() == []
    assert cells.search(cells.build(make([(1, [1.0, 2.0])]), "id", "v")).collect() == []
    assert [r.related_id for r in cells.search(cells.build(make([(1, [1.0, 2.0]), (2, [1.0, 2.5])]), "id", "v")).orderBy("id").collect()] == [2, 1]


def test_vectors_are_shipped_by_block(spark, vectors, monkeypatch):
    """A vector goes to the blocks that it meets, not to every cell that is looked into."""
    index = cells.build(vectors.filter("id < 5000"), "id", "v", cells=60, probes=40)
    asked = spark.range(1000).select("id")
    seen = {}
    monkeypatch.setattr(cells, "stage", lambda df, name: seen.setdefault(name, df.cache()))
    cells.search(index, asked, 5).count()
    assert seen["pairs"].count() <= 4 and sum(len(r.raw) for r in seen["blocks"].collect()) <= 1500 * 16 * 8
