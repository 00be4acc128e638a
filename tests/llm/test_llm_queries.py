"""The registered queries and the pipeline on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tallgrass.llm import catalog, exact_dedup, jaccard_join

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="no tables")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    rows = catalog.queries()[name](spark, str(TABLES))
    names = sorted(rows.columns)
    want = con.execute(catalog.oracle_sql()[name])
    order = [[d[0] for d in want.description].index(n) for n in names]
    assert sorted(map(repr, (tuple(r) for r in rows.select(names).collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_pipeline(spark):
    """Each stage against what plain operators say of its own input."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    at = {"docs": docs}
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, str(TABLES)).cache()
        at[name] = docs
        if name != "packing":
            assert docs.columns == at["docs"].columns
    assert at["language_id"].count() == at["docs"].count()  # clean documents stay
    stay = {r.doc_id for r in exact_dedup.exact_dedup(at["language_id"], keep="max").filter("kept").collect()}
    assert {r.doc_id for r in at["exact_dedup"].collect()} == stay
    first = {r.doc_id for r in jaccard_join.join_documents(at["exact_dedup"]).collect() if r.doc_id == r.component_id}
    assert {r.doc_id for r in at["jaccard_join"].collect()} == first
    assert {r.doc_id for r in at["mixing"].collect()} <= first
    pieces = at["packing"].collect()
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
    assert corpus_pipeline.run(spark, str(TABLES)).count() == len(pieces)
