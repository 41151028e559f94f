"""Every query against its SQL, row for row."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import oracle
from waybill.plans import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float) and math.isfinite(v) and v == int(v):
        return str(int(v))
    return "" if v is None else repr(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(tuple(_cell(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted(tuple(_cell(row[i]) for i in at) for row in result.fetchall())
    assert got == want


def test_every_query_but_one_has_sql():
    assert set(catalog.queries()) - set(oracle.oracle_sql()) == {"file_manifest"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_adapter_breaks_every_rule(spark):
    row = entry.queries()["dq_audit"](spark, str(DATA)).first().asDict()
    expected = (1454, 98, 204, 51, 69, 100, 390, 105, 4, 896)
    assert tuple(row.values())[5:] == expected
    assert (row["total_records"], row["clean_records"]) == (6000, 3332)
