"""Plan shapes: the physical operators the design relies on."""

import re

from pyspark.sql import functions as F

from cardwatch import catalog
from cardwatch.plans import reports
from cardwatch.sources.adapters import REPORT_DT
from tests.conftest import SF0001
from tests.helpers import plan_text


def _plan(df):
    return plan_text(df)


def test_anti_join_is_left_anti(spark):
    p = _plan(catalog.queries()["join_anti"](spark, SF0001))
    assert "LeftAnti" in p


def test_in_subquery_inside_or_is_an_existence_join(spark):
    p = _plan(catalog.queries()["join_existence"](spark, SF0001))
    assert "ExistenceJoin" in p


def test_blacklist_is_checked_per_owner_not_per_transaction(spark):
    p = _plan(catalog.q_report_passport(spark, SF0001))
    assert "ExistenceJoin" not in p and "listed" in p


def test_reports_read_each_dimension_once_and_start_from_no_checkpoint(spark):
    plans = {k: catalog.queries()[k](spark, SF0001) for k in ("report_passport", "report_contract", "report_city_hop", "report_fraud_all")}
    assert not any("Scan ExistingRDD" in _plan(p) for p in plans.values())
    for key in ("report_passport", "report_contract"):
        p = _plan(plans[key])
        scans = re.findall(r"^Location: .*/(\w+)\.parquet", p, re.M)
        # cards, accounts and clients all come from customer (and the blacklist does in R1)
        assert scans.count("customer") == (4 if key == "report_passport" else 3) and scans.count("events") == 1


def test_scd2_merge_shuffles_each_side_once(spark):
    tt = catalog._tt(spark, SF0001)
    p = _plan(catalog.merged(tt, "clients"))
    assert "FullOuter" in p
    # one exchange per side: the duplicate-key window reuses the join's shuffle
    assert p.count("Arguments: hashpartitioning(client_id") == 2
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 2


def test_delivery_bound_prunes_the_scan(spark, tmp_path):
    from cardwatch.sinks import warehouse
    tt = catalog._tt(spark, SF0001)
    root = str(tmp_path)
    warehouse.append_transactions(tt.transactions(), root, "r1", feed_dt_col=F.col("feed_dt"))
    warehouse.append_transactions(tt.transactions(), root, "r2", feed_dt_col=F.col("feed_dt"))
    fact = warehouse.read_transactions(spark, root, ["r1"])
    p = _plan(reports.scoped_transactions(fact, REPORT_DT, reports.INTENDED, "passport"))
    assert re.search(r"PartitionFilters: \[.*feed_dt.* = ", p)
    assert any("EqualTo(oper_result,SUCCESS)" in ln for ln in p.splitlines() if ln.startswith("PushedFilters"))
    assert "run=r2" not in p   # only the named runs' folders are opened


def test_column_pruning_at_scan(spark):
    tt = catalog._tt(spark, SF0001)
    p = _plan(catalog.q_agg_latest_event(spark, SF0001))
    schemas = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")]
    assert schemas and all("props" not in ln and "value" not in ln for ln in schemas)
    assert tt


def _fact_scans(plan):
    """The formatted entries of the scans of a stored fact."""
    return [e for e in re.split(r"\n\n", plan) if "fact" in e and re.search(r"Scan parquet", e)]


def test_every_scan_of_the_hop_report_is_pruned_by_day(spark):
    p = _plan(catalog.q_report_city_hop_stored(spark, SF0001))
    scans = _fact_scans(p)
    assert len(scans) >= 3
    for s in scans:
        filters = re.search(r"PartitionFilters: \[(.*)\]", s)
        assert filters and ("feed_dt" in filters[1] and " = " in filters[1] or "dynamicpruning" in filters[1]), s
    assert any("trans_day" in re.search(r"PartitionFilters: \[(.*)\]", s)[1] for s in scans)


def test_a_late_row_pairs_with_its_old_day_and_other_days_stay_closed(spark, tmp_path):
    import datetime as dt

    from cardwatch.sinks import warehouse
    rows = [(f"old{i}", dt.datetime(2024, 1, 1) + dt.timedelta(days=i, hours=23, minutes=45), 1, "C1", "buy", "SUCCESS", "T1") for i in range(60)]
    late = [("late", dt.datetime(2024, 1, 9, 0, 15), 1, "C1", "buy", "SUCCESS", "T2"), ("now", dt.datetime(2024, 3, 5, 12), 1, "C2", "buy", "SUCCESS", "T2")]
    schema = "trans_id string, trans_date timestamp_ntz, amt int, card_num string, oper_type string, oper_result string, terminal string"
    root = str(tmp_path)
    warehouse.append_transactions(spark.createDataFrame(rows, schema), root, "r1", feed_dt_col=F.to_date("trans_date"))
    warehouse.append_transactions(spark.createDataFrame(late, schema), root, "r2", feed_dt=dt.date(2024, 3, 5))
    terminals = spark.createDataFrame([("T1", "Oslo"), ("T2", "Rome")], "terminal_id string, terminal_city string")
    pairs = reports.hop_pairs(warehouse.read_transactions(spark, root, ["r1", "r2"], days=True), terminals, dt.date(2024, 3, 5))
    assert [(r.trans_id, r.lead_tran, r.terminal_city, r.lead_city) for r in pairs.collect()] == [("old7", "late", "Oslo", "Rome")]
    days = reports._on_days_near(reports._sided(warehouse.read_transactions(spark, root, ["r1", "r2"], days=True)),
                                 F.col("feed_dt") == F.lit("2024-03-05").cast("date"))
    assert {r.trans_id for r in days.collect()} == {"old7", "old8", "late", "now"}  # old8: the late row's own day


def test_commit_log_names_the_runs_with_facts(spark, tmp_path, monkeypatch):
    import datetime as dt

    from cardwatch.sinks import warehouse
    from cardwatch.sources.adapters import RUN_TS
    root = str(tmp_path)
    rows = catalog._tt(spark, SF0001).transactions()
    warehouse.append_transactions(rows, root, "r1", feed_dt_col=F.col("feed_dt"))
    warehouse.commit(spark, root, "r1", RUN_TS, expect_previous=None)
    warehouse.commit(spark, root, "r2", RUN_TS, expect_previous="r1")                     # neither facts nor reports
    warehouse.write_reports(catalog.q_report_contract(spark, SF0001), root, "r3")
    warehouse.commit(spark, root, "r3", RUN_TS, transactions_dt=dt.date(2024, 1, 15), expect_previous="r2")
    looked = []
    monkeypatch.setattr(warehouse, "_exists", lambda spark, path, real=warehouse._exists: looked.append(path) or real(spark, path))
    assert warehouse.current_transactions(spark, root).count() == rows.count()
    assert warehouse.current_reports(spark, root).count() > 0
    assert {p.rsplit("/", 1)[-1] for p in looked} <= {"runs"}
