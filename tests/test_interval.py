"""Rows joined to the version valid at their time (operators/interval.py)."""

import datetime as dt
import random

from cardwatch.operators.interval import as_of
from tests.helpers import plan_text


def _t(day, second=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, seconds=second)


def test_against_a_search_of_every_version(spark):
    rng = random.Random(6)
    versions = []
    for k in range(30):
        at = 0
        for v in range(rng.randint(0, 6)):
            start = at + rng.choice([0, 0, 1, 3 * 86400])       # some with gaps
            end = start + rng.choice([0, 5, 3600, 86400 * 40])
            versions.append((f"k{k}", f"k{k}v{v}", _t(0, start), _t(0, end)))
            at = end + 1
    versions += [("open", "forever", _t(0), dt.datetime(9999, 12, 31)), (None, "never", _t(0), dt.datetime(9999, 12, 31))]
    rows = [(i, rng.choice([f"k{rng.randrange(30)}", "none", None, "open"]),
             None if rng.random() < .05 else _t(rng.randrange(60), rng.randrange(86400)) + dt.timedelta(microseconds=rng.choice([0, 999_999])))
            for i in range(400)]
    rows += [(1000 + i, k, t) for i, (k, _, s, e) in enumerate(versions) if k for t in (s, e)]
    hist = spark.createDataFrame(versions, "key string, label string, start_dt timestamp_ntz, end_dt timestamp_ntz")
    df = spark.createDataFrame(rows, "id long, card string, ts timestamp_ntz")
    got = as_of(df, hist, "card", "ts", "key", {"label": "version"})
    want = [(i, k, t, next((v for key, v, s, e in versions if key is not None and key == k and t is not None and s <= t < e + dt.timedelta(seconds=1)), None))
            for i, k, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.columns == ["id", "card", "ts", "version"]


def test_rows_join_on_key_and_day(spark):
    df = spark.createDataFrame([(1, "a", _t(0))], "id long, card string, ts timestamp_ntz")
    hist = spark.createDataFrame([("a", "x", _t(0), _t(1))], "key string, label string, start_dt timestamp_ntz, end_dt timestamp_ntz")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_text(as_of(df, hist, "card", "ts", "key", {"label": "version"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "hashpartitioning(card" in plan and "_day" in plan
