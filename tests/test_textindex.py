"""The text index against a search of all texts."""

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import search, textindex


def test_runs(spark):
    df = spark.createDataFrame([(1, "abab"), (2, ""), (3, None), (4, "å😀"), (5, "x")], "id int, t string")
    got = {r.id: sorted(r.g) for r in df.select("id", textindex.runs_of(F.col("t")).alias("g")).collect()}
    assert got == {1: sorted(["aba", "bab", "ab\0", "b\0\0"]), 2: [], 3: [], 4: sorted(["å😀\0", "😀\0\0"]), 5: ["x\0\0"]}
    assert textindex.runs_wanted("abab") == ["aba", "bab"] and textindex.runs_wanted("x") == ["x"] and textindex.runs_wanted("") == []


@pytest.mark.parametrize("text", ["HAVET", " igen ", "a", "gå", "å😀", "aba", "havet igen", "finns inte", "", "rad 34999", "%"])
def test_the_same_rows_as_a_search_of_all(spark, index, text):
    path, df = index
    got = sorted(tuple(r) for r in textindex.containing(spark, path, text).select("id", "description", "bits").collect())
    want = sorted(tuple(r) for r in df.filter("id IS NOT NULL").filter(F.lower("description").contains(text.strip().lower())).collect())
    assert got == want
    f = search.Filters(text=text)
    assert sorted(r.id for r in search.matching(textindex.containing(spark, path, text), f).collect()) == [r[0] for r in want]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    """More rows than one block has, with repeated and null identifiers, null texts, and a column whose name the index uses inside."""
    texts = ["om havet", "Havet igen", "GÅR vi", "abab", "ababab", "å😀", "", None, "100 %"]
    rows = [(i, texts[i % 9], i % 3) for i in range(90)] + [(5, "igen och igen", 1), (None, "havet", 2)]
    df = spark.createDataFrame(rows, "id long, description string, bits int").union(spark.range(1000, 35_000).selectExpr("id", "concat('rad ', id) AS description", "0 AS bits"))
    path = str(tmp_path_factory.mktemp("index"))
    textindex.build(df.limit(3), "id", "description", path)
    textindex.build(df, "id", "description", path)  # takes the place of the one before
    return path, df


def test_only_blocks_with_candidates_are_read(spark, index):
    path, df = index
    rows = textindex.containing(spark, path, "havet")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert textindex.build(df.limit(0), "id", "description", path + "-none") is None
    assert textindex.containing(spark, path + "-none", "a").count() == 0


def test_bitmaps_hold_the_runs(spark, tmp_path, monkeypatch):
    """The index is what runs and Spark's own bitmaps give, where a run's bits come in several lists and batches too; no row is made for a run of a text."""
    monkeypatch.setattr(textindex, "MAPS", 3)
    texts = ["om havet", "Havet igen", "abab", "å😀", "", None, "a\0b", "7"]
    df = spark.range(40_000).selectExpr("id", "id % 8 AS k").join(spark.createDataFrame(list(enumerate(texts)), "k long, description string"), "k").drop("k").withColumn("description", F.when(F.col("id") % 1000 < 40, F.col("description")))
    seen = {}
    monkeypatch.setattr(textindex, "stage", lambda rows, name: seen.setdefault(name, rows.cache()))
    textindex.build(df, "id", "description", str(tmp_path))
    folder = textindex.versioned.current(spark, str(tmp_path))
    found = {(r.run, r["__block"]): bytes(r.bits) for r in spark.read.parquet(f"{folder}/runs").collect()}
    place = F.col("id") + 1
    plain = df.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p"), F.explode(textindex.runs_of(F.lower("description"))).alias("run"))
    want = {(r.run, r.b): bytes(r.m) for r in plain.groupBy("run", "b").agg(F.bitmap_construct_agg("p").alias("m")).collect()}
    assert found == want and seen["runs"].count() < plain.count() / 4
