"""Successor per group under skew (operators/sequence.py)."""

import datetime as dt

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from cardwatch.operators.sequence import with_next, with_previous_within_hour


def _rows(spark):
    base = dt.datetime(2024, 1, 15)
    hot = [("HOT", base + dt.timedelta(seconds=7 * i), f"h{i:05d}", f"T{i % 3}") for i in range(3000)]
    cold = [(f"C{j}", base + dt.timedelta(minutes=j + i), f"c{j}-{i}", f"T{i}") for j in range(40)
            for i in range(3)]
    ties = [("TIE", base, "t2", "T1"), ("TIE", base, "t1", "T2")]   # same time: id breaks the tie
    return spark.createDataFrame(hot + cold + ties, "card string, ts timestamp_ntz, id string, term string")


def _jobs(spark, build):
    """What ``build`` returns, and how many Spark jobs it started."""
    group = f"build-{id(build)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        return build(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_matches_plain_window_and_splits_the_hot_group(spark):
    nulls = [(None, dt.datetime(2024, 1, 15, 9, 59), "n1", "T1"), (None, dt.datetime(2024, 3, 15, 10, 5), "n2", "T2"), ("", None, "e0", "T1"),
             ("", dt.datetime(2023, 1, 1), "e1", "T1"), ("", dt.datetime(2024, 1, 1), "e2", None)]
    df = _rows(spark).unionByName(spark.createDataFrame(nulls, "card string, ts timestamp_ntz, id string, term string"))
    got, jobs = _jobs(spark, lambda: with_next(df, "card", ["ts", "id"], ["id", "term"]))
    assert jobs == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan.replace("Scan ExistingRDD[card", "")  # no checkpoint beside the input
    assert "hashpartitioning(_g" in plan and ", _s" in plan               # a hot card is split by hour
    w = Window.partitionBy("card").orderBy("ts", "id")
    ref = df.select("id", F.lead("id").over(w).alias("r_id"), F.lead("term").over(w).alias("r_term"))
    j = got.join(ref, "id")
    assert j.count() == df.count()
    assert j.where(~F.col("lead_id").eqNullSafe(F.col("r_id"))
                   | ~F.col("lead_term").eqNullSafe(F.col("r_term"))).count() == 0
    by = {r.id: r.lead_id for r in got.collect()}
    assert (by["t1"], by["t2"]) == ("t2", None) and (by["n1"], by["n2"]) == ("n2", None)
    assert (by["e0"], by["e1"], by["e2"]) == ("e1", "e2", None)


def test_numbers_and_days_order_too(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("a", 900_000, "w"), ("a", -7000, "v"), ("a", None, "u")],
                               "g string, o int, v string")
    assert {r.v: r.lead_v for r in with_next(df, "g", ["o"], ["v"]).collect()} == {
        "u": "v", "v": "x", "x": "y", "y": "w", "w": None, "z": None}
    days = df.withColumn("o", F.date_add(F.lit("2024-01-01").cast("date"), F.coalesce("o", F.lit(-9000)) % 3000))
    w = Window.partitionBy("g").orderBy("o", "v")
    got = with_next(days, "g", ["o", "v"], ["v"]).withColumn("want", F.lead("v").over(w))
    assert got.where(~F.col("lead_v").eqNullSafe(F.col("want"))).count() == 0
    with pytest.raises(TypeError):
        with_next(df, "g", ["v"], ["v"])


def test_queries_with_a_successor_start_no_job_while_they_are_built(spark):
    from cardwatch import catalog
    for key in ("window_lead", "report_hop_pairs_literal", "report_city_hop_literal", "report_hop_base"):
        query, sf = catalog.queries()[key], "/root/testdata/sf0.001"
        df, jobs = _jobs(spark, lambda: query(spark, sf))
        plan = df._jdf.queryExecution().toString()
        assert "ExistingRDD" not in plan and "LogicalRDD" not in plan, key
        # opening a Parquet file reads its footer in a job of its own
        files = {"window_lead": 2, "report_hop_pairs_literal": 3}.get(key, 4)
        assert jobs <= files, key


def test_previous_within_the_hour_matches_a_plain_window(spark):
    """(group, hour) windows with the stitch, against one window per card; NULL is a card."""
    extra = [(None, dt.datetime(2024, 1, 15, 9, 59), "n1", "T1"), (None, dt.datetime(2024, 1, 15, 10, 5), "n2", "T2"),
             ("FAR", dt.datetime(2024, 1, 15, 8, 59), "f1", "T1"), ("FAR", dt.datetime(2024, 1, 15, 10, 0), "f2", "T1")]
    df = _rows(spark).unionByName(spark.createDataFrame(extra, "card string, ts timestamp_ntz, id string, term string"))
    got = with_previous_within_hour(df, "card", "ts", "id", ["id", "ts"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(card" in plan and "_hour" in plan      # a hot card is split by hour
    w = Window.partitionBy("card").orderBy("ts", "id")
    ref = df.select("id", F.lag(F.struct("id", "ts")).over(w).alias("r"))
    near = F.col("r.ts") >= F.date_trunc("hour", "ts") - F.expr("INTERVAL 1 HOUR")
    j = got.join(ref, "id")
    assert j.count() == df.count()
    assert j.where(~F.col("prev_id").eqNullSafe(F.when(near, F.col("r.id")))).count() == 0
    by = {r.id: r.prev_id for r in got.collect()}
    assert by["n2"] == "n1" and by["f2"] is None and by["t2"] == "t1" and by["t1"] is None
