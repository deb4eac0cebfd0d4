"""The entry module and the catalogue against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from corpusloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{value:.6g}" if isinstance(value, float) or abs(value) < 10**6 else str(value)
    return str(value)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    found = catalog.queries()[name](spark, SF)
    rows = sorted(tuple(plain(r[c]) for c in sorted(found.columns)) for r in found.collect())
    if name not in catalog.oracle_sql():
        assert rows
        return
    answer = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    want = sorted(tuple(plain(v) for _, v in sorted(zip(columns, r, strict=True))) for r in answer.fetchall())
    assert sorted(columns) == sorted(found.columns) and rows == want


def test_entry(spark):
    assert entry_module.entry(spark).count() == 3
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
