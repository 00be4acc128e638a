from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallgrass.llm import mixing


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_a_long_document_does_not_end_the_selection(spark, seed):
    """No document that is left fits into what its source lacks."""
    rows = [(i, ["a"], 500) for i in range(240)] + [(1000, ["a"], 60_000)] + [(2000 + i, ["b"], 100 + i) for i in range(150)] + [(3000, ["b"], 4000)] * 2
    table = spark.createDataFrame(rows, "doc_id long, s array<string>, n long")
    got = mixing.mix(table, F.col("s"), F.col("n"), weights=(1, 1.7), seed=seed).collect()
    size, taken = Counter(), Counter()
    for r in got:
        size[r.sources[0]] += r.size
        taken[r.sources[0]] += r.taken
    target = mixing.quotas(dict(size), (1, 1.7))
    scale = min(1, sum(size.values()) / sum(target.values()))
    for s, goal in target.items():
        lacks = goal * scale - taken[s]
        least = min((r.repeats for r in got if r.sources == [s]), default=0)
        assert lacks > -1e-6
        assert least == 3 or all(r.size > lacks for r in got if r.sources == [s] and r.repeats == least)


def test_repeated_rows_are_taken_as_often_as_the_mix_says(spark):
    rows = [(i // 2, "wort " * (3 + i // 2 % 5), "abc"[i // 2 % 3]) for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = sum(r.taken for r in mixing.mix_documents(docs).collect())
    assert sum(len(r.text.split()) for r in mixing.take_mix(docs).collect()) == taken


def test_texts_stay_where_they_are(spark):
    """Documents are taken by the bounds of their source, however large the table: none is shuffled."""
    docs = spark.createDataFrame([(i, "wort " * (3 + i % 5), "abc"[i % 3]) for i in range(180)], "doc_id long, text string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = mixing.take_mix(docs)
        assert sum(len(r.text.split()) for r in found.collect()) == sum(r.taken for r in mixing.mix_documents(docs).collect())
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
