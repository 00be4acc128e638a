"""Every registered query of the archive against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from tallgrass import catalog

TABLES = Path("/root/testdata/sf0.001")
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if hasattr(value, "tolist"):
        return plain(value.tolist())
    return tuple(map(plain, value)) if isinstance(value, list) else value


@pytest.mark.skipif(not TABLES.is_dir(), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    rows = catalog.queries()[name](spark, str(TABLES))
    names = sorted(rows.columns)
    got = sorted(repr(tuple(plain(v) for v in r)) for r in rows.select(names).collect())
    if name not in catalog.oracle_sql():
        assert got
        return
    want = duck.execute(catalog.oracle_sql()[name])
    order = [[d[0] for d in want.description].index(n) for n in names]
    assert got == sorted(repr(tuple(plain(r[i]) for i in order)) for r in want.fetchall())
