"""Rows told by a bitmap before a shuffle (operators/bloom.py); ranges of equal depth (sources/snapshots.py)."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cardwatch import catalog
from cardwatch.operators.bloom import may_meet
from cardwatch.sources import snapshots
from tests.conftest import SF0001
from tests.helpers import plan_text, rows


def test_no_key_is_lost_and_few_others_stay(spark):
    big = spark.range(200_000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("card"), F.lit(1).alias("x"))
    big = big.unionByName(spark.createDataFrame([(None, 1), ("", 2)], "card string, x int"))
    small = spark.range(0, 200_000, 401).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("k"))
    small = small.unionByName(spark.createDataFrame([(None,), ("",), ("elsewhere",), ("",)], "k string"))
    got = may_meet(big, "card", small, "k")
    assert got.columns == ["card", "x"]
    kept = [r.card for r in got.collect()]
    want = {r.k for r in small.collect() if r.k is not None} - {"elsewhere"}
    assert want <= set(kept) and len(kept) == len(set(kept)) <= len(want) + 60
    assert may_meet(big, "card", small.where("false"), "k").count() == 0


def test_fewer_transactions_go_into_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans = {}
        for key in ("report_passport", "report_passport_prefilter"):
            df = catalog.queries()[key](spark, SF0001)
            df.collect()
            plans[key] = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plans["report_passport_prefilter"] and "BroadcastHashJoin" not in plans["report_passport"]
        tt = catalog._all(spark, SF0001)
        t = tt.transactions().where(F.col("feed_dt") == F.lit(catalog.REPORT_DT)).select(F.trim("card_num").alias("card_key"))
        listed = tt.blacklist().select(F.regexp_replace("passport_num", "PP", "C").alias("card_key"))
        assert may_meet(t, "card_key", listed, "card_key").count() < t.count() / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    a, b = (rows(catalog.queries()[k](spark, SF0001)) for k in ("report_passport", "report_passport_prefilter"))
    assert a == b and a
    # the bitmap's join stands below the exchange of the transactions
    assert "_mask" in plan_text(catalog.q_report_passport_prefilter(spark, SF0001))


def test_ranges_hold_about_as_many_rows_each(spark):
    n = [r.n for r in catalog.snapshot_ranges(spark, SF0001).collect()]
    assert len(n) == catalog.RANGES and max(n) * catalog.RANGES <= 2 * sum(n)
    skewed = spark.range(5000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS v")  # a value that half of the rows have
    bounds = snapshots.depth_bounds(skewed, "v", 8)
    assert bounds == sorted(set(bounds)) and 7 in bounds
    assert snapshots.depth_bounds(skewed.where("false"), "v", 8) == [] == snapshots.depth_bounds(skewed, "v", 1)


def test_predicates_cover_every_value_once(spark):
    days = [dt.datetime(2024, 1, d, 12) for d in range(1, 29)] + [None]
    df = spark.createDataFrame([(x,) for x in days], "at timestamp_ntz")
    for bounds in ([], [dt.datetime(2024, 1, 5, 12)], [dt.datetime(2024, 1, 5, 12), dt.datetime(2024, 1, 9), dt.datetime(2025, 1, 1)]):
        parts = [df.where(p.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")) for p in snapshots.range_predicates("at", bounds)]
        assert sum(p.count() for p in parts) == len(days) and len(parts) == len(bounds) + 1
        by = {r.n: r["count"] for r in df.groupBy(snapshots.range_of("at", bounds).alias("n")).count().collect()}
        assert by == {i: p.count() for i, p in enumerate(parts) if p.count()}
    assert snapshots.range_predicates("d", [dt.date(2024, 1, 1)]) == ["(d <= DATE '2024-01-01' OR d IS NULL)", "d > DATE '2024-01-01'"]
    assert re.fullmatch(r"\(k <= 3 OR k IS NULL\)", snapshots.range_predicates("k", [3, 9])[0])
