"""FIXTURES sections 2 and 3: four runs of a keyed dimension, three of terminals."""

import datetime as dt

from cardwatch.operators import scd2
from cardwatch.schemas import CARDS, STG_CARDS, STG_TERMINALS, TERMINALS
from tests.helpers import d, rows, ts

INF = ts("9999-12-31 00:00:00")
CREATE = ts("2021-01-01 00:00:00")
DAYS = [
    [("a", "1", None), ("b", "1", None), ("c", "1", None)],
    [("a", "2", "2021-03-02"), ("b", "1", None)],
    [("a", "2", "2021-03-02"), ("b", "1", None), ("c", "1", None)],
    [("a", "3", "2021-03-04"), ("b", "1", None), ("c", "1", None)],
]
INTENDED_AFTER_DAY_4 = [
    ("a", "1", ts("2021-01-01 00:00:00"), ts("2021-03-01 23:59:59"), "N"),
    ("a", "2", ts("2021-03-02 00:00:00"), ts("2021-03-03 23:59:59"), "N"),
    ("a", "3", ts("2021-03-04 00:00:00"), INF, "N"),
    ("b", "1", ts("2021-01-01 00:00:00"), INF, "N"),
    ("c", "1", ts("2021-01-01 00:00:00"), ts("2021-03-02 05:59:59"), "N"),
    ("c", "1", ts("2021-03-02 06:00:00"), ts("2021-03-03 05:59:59"), "Y"),
    ("c", "1", ts("2021-03-03 06:00:00"), INF, "N"),
]


def _snapshot(spark, day):
    data = [(k, v, CREATE, ts(u + " 00:00:00") if u else None) for k, v, u in DAYS[day]]
    return spark.createDataFrame(data, STG_CARDS)


def _run_days(spark, days):
    hist = spark.createDataFrame([], CARDS.dim_schema())
    for i in range(days):
        clock = scd2.Clock(dt.datetime(2021, 3, 1 + i, 6, 0, 0))
        hist = scd2.next_state(hist, _snapshot(spark, i), CARDS, clock)
        hist = spark.createDataFrame(hist.collect(), CARDS.dim_schema())  # tiny: cut lineage
    return hist


def test_four_day_history_intended(spark):
    hist = _run_days(spark, 4)
    assert rows(hist, *CARDS.dim_columns) == sorted(INTENDED_AFTER_DAY_4)
    assert [f.dataType.simpleString() for f in hist.schema.fields][2:4] == ["timestamp_ntz"] * 2


def test_rerun_same_snapshot_changes_nothing(spark):
    hist = _run_days(spark, 4)
    again = scd2.next_state(hist, _snapshot(spark, 3), CARDS, scd2.Clock(ts("2021-03-05 06:00:00")))
    assert rows(again, *CARDS.dim_columns) == rows(hist, *CARDS.dim_columns)
    merged = scd2.merge(scd2.open_rows(hist), _snapshot(spark, 3), CARDS,
                        scd2.Clock(ts("2021-03-05 06:00:00")))
    assert {r.step for r in merged.select("step").distinct().collect()} == {"keep"}


def test_terminals_three_feeds_intended(spark):
    feeds = [
        [("T1", "P", "X", "a1"), ("T2", "A", "Y", "a2"), ("T3", "P", "Z", "a3")],
        [("T1", "P", "X", "a1b"), ("T2", "A", "Y2", "a2")],
        [("T1", "P", "X", "a1b"), ("T2", "A", "Y2", "a2"), ("T3", "P", "Z", "a3")],
    ]
    hist = spark.createDataFrame([], TERMINALS.dim_schema())
    for i, f in enumerate(feeds):
        fd = dt.date(2021, 3, 1 + i)
        staged = spark.createDataFrame([(*r, fd) for r in f], STG_TERMINALS)
        clock = scd2.Clock(dt.datetime(2021, 3, 1 + i, 6, 0, 0), fd)
        hist = scd2.next_state(hist, staged, TERMINALS, clock)
        hist = spark.createDataFrame(hist.collect(), TERMINALS.dim_schema())
    got = rows(hist, "terminal_id", "terminal_city", "terminal_address", "start_dt", "end_dt",
               "deleted_flg")
    assert got == sorted([
        ("T1", "X", "a1", ts("2021-03-01 00:00:00"), ts("2021-03-01 23:59:59"), "N"),
        ("T1", "X", "a1b", ts("2021-03-02 00:00:00"), INF, "N"),
        ("T2", "Y", "a2", ts("2021-03-01 00:00:00"), ts("2021-03-01 23:59:59"), "N"),
        ("T2", "Y2", "a2", ts("2021-03-02 00:00:00"), INF, "N"),
        ("T3", "Z", "a3", ts("2021-03-01 00:00:00"), ts("2021-03-01 23:59:59"), "N"),
        ("T3", "Z", "a3", ts("2021-03-02 00:00:00"), ts("2021-03-02 23:59:59"), "Y"),
        ("T3", "Z", "a3", ts("2021-03-03 00:00:00"), INF, "N"),
    ], key=lambda t: tuple(str(x) for x in t))
    # every version touched by a run carries that run's timestamp
    proc = {r.processed_dt for r in hist.where("start_dt >= '2021-03-02'").collect()}
    assert proc <= {ts("2021-03-02 06:00:00"), ts("2021-03-03 06:00:00")}


def test_duplicate_staged_key_fails(spark):
    import pytest
    data = [("a", "1", CREATE, None), ("a", "2", CREATE, None)]
    staged = spark.createDataFrame(data, STG_CARDS)
    hist = spark.createDataFrame([], CARDS.dim_schema())
    with pytest.raises(Exception, match="not unique"):
        scd2.merge(hist, staged, CARDS, scd2.Clock(ts("2021-03-01 06:00:00"))).collect()


def test_clock_before_open_version_fails(spark):
    import pytest
    hist = _run_days(spark, 1)
    with pytest.raises(Exception, match="run clock"):
        scd2.merge(scd2.open_rows(hist), _snapshot(spark, 1).where("card_num = 'b'"), CARDS,
                   scd2.Clock(ts("2020-12-31 06:00:00"))).collect()


def test_null_key_rows_are_ignored(spark):
    staged = spark.createDataFrame([(None, "1", CREATE, None), ("a", "1", CREATE, None)], STG_CARDS)
    hist = spark.createDataFrame([], CARDS.dim_schema())
    m = scd2.merge(hist, staged, CARDS, scd2.Clock(ts("2021-03-01 06:00:00")))
    assert rows(m, "card_num", "step") == [("a", "insert")]
    assert d("2021-03-01")  # helper import used
