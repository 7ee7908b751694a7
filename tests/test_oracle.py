"""Every catalog query against its DuckDB oracle.

sf0.001 by default for speed; set CARDWATCH_ORACLE_SF to check another scale
(the driver checks sf0.01)."""

import os

import pytest

import __spark_entry__ as entry
from cardwatch import catalog
from tools.oracle_check import duck, rows_of

SF = os.environ.get("CARDWATCH_ORACLE_SF", "/root/testdata/sf0.001")
KEYS = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(catalog.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[key])
    cols = [c[0] for c in cur.description]
    want = rows_of(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() >= 0
