"""Every SURVEY section-2 operator as a query over the driver tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame``.  Inputs come from
``sources.adapters`` (whole tables, no sampling); feed scans first let Spark
write the derived feed as delimited text under the shared scratch folder and
then read it back through the real feed reader.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.functions.expr import date_lit, null_safe_differs
from cardwatch.operators import literal, scd2, staging
from cardwatch.operators.sequence import with_next
from cardwatch.plans import reports, watermark
from cardwatch.schemas import (DIMS, FEED_PREFIX_BLACKLIST, FEED_PREFIX_TERMINALS,
                               FEED_PREFIX_TRANSACTIONS, META_SCHEMA)
from cardwatch.session import scratch_dir
from cardwatch.sinks import buckets, warehouse
from cardwatch.sources import adapters, feeds, snapshots
from cardwatch.sources.adapters import FEED_DT, REPORT_DT, RUN_TS

Query = Callable[[SparkSession, str], DataFrame]
FEED_PREFIXES = {"transactions": FEED_PREFIX_TRANSACTIONS, "blacklist": FEED_PREFIX_BLACKLIST,
                 "terminals": FEED_PREFIX_TERMINALS}
FEED_EXT = {"transactions": ".txt", "blacklist": ".xlsx", "terminals": ".xlsx"}


def _tt(spark, sf) -> adapters.TestTables:
    return adapters.load(spark, sf)


def _all(spark, sf) -> adapters.TestTables:
    """The tables for queries that need no deletions: snapshots of every key."""
    return adapters.load(spark, sf, whole=True)


def _clock() -> scd2.Clock:
    return scd2.Clock(RUN_TS, FEED_DT)


# ------------------------------------------------------------------ state
def meta_before(tt: adapters.TestTables) -> DataFrame:
    """Watermarks as they stood before the run, derived from the data: the
    day before the report for transactions, the latest blacklist entry, and
    the latest version start of each dimension."""
    def row(df: DataFrame, source: str, c) -> DataFrame:
        return df.agg(F.max(c).alias("max_update_dt")).select(
            F.lit(META_SCHEMA).alias("schema_name"), F.lit(source).alias("source_name"),
            "max_update_dt")

    out = row(tt.transactions().where(F.col("feed_dt") < date_lit(REPORT_DT)), "transactions", F.col("feed_dt"))
    out = out.unionByName(row(tt.blacklist(), "blacklist", F.col("enty_dt")))
    for n in ("terminals", "cards", "accounts", "clients"):
        out = out.unionByName(row(tt.dim_before(n), n, F.to_date("start_dt")))
    return out


def staged(tt, name: str) -> DataFrame:
    if name == "terminals":
        return tt.snapshot("terminals")
    return tt._memo(("staged", name), lambda: staging.stage_snapshot(
        name, tt.snapshot(name))[0])


def merged(tt, name: str) -> DataFrame:
    return tt._memo(("merged", name), lambda: scd2.merge(
        scd2.open_rows(tt.dim_before(name)), staged(tt, name), DIMS[name], _clock()))


def open_after(tt, name: str) -> DataFrame:
    return merged(tt, name).where(F.col("state") == "open")


# ------------------------------------------------------------------ feeds
def _feed_days(tt) -> DataFrame:
    return tt.transactions().select(F.col("feed_dt").alias("d")).distinct()


def _raw_transactions_text(tt, day=None, keep=()) -> DataFrame:
    t = tt.transactions()
    if day is not None:  # the rows of one day's file
        t = t.where(F.col("feed_dt") == date_lit(day))
    return t.select(F.col("trans_id").alias("transaction_id"),
                    F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("transaction_date"),
                    F.translate(F.col("amt").cast("string"), ".", ",").alias("amount"),
                    "card_num", "oper_type", "oper_result", "terminal", *keep)


def _write_feed(spark, df: DataFrame, prefix: str, ext: str) -> str:
    root = scratch_dir(spark, "feeds")
    path = f"{root}/{prefix}{FEED_DT.strftime('%d%m%Y')}{ext}"
    feeds.write_text_feed(df, path)
    return path


RANGES = 8


def snapshot_ranges(spark, sf) -> DataFrame:
    """The ranges in which a snapshot is read in parallel, with the rows of each: of equal depth over values
    that are far from even (equal widths would put half of the rows into the first of eight)."""
    rows = _tt(spark, sf).table("customer").selectExpr("c_custkey * c_custkey * c_custkey AS split")
    bounds = snapshots.depth_bounds(rows, "split", RANGES)
    return (rows.groupBy(snapshots.range_of("split", bounds).cast("int").alias("range_no"))
            .agg(F.min("split").alias("low"), F.max("split").alias("high"), F.count(F.lit(1)).alias("n")))


def q_snapshot_ranges(spark, sf):
    """S1-S3: each range, whether it holds at most twice the mean, and the rows of all (the bounds come
    from a sketch, so that numbers may differ by its error)."""
    every = F.sum("n").over(Window.partitionBy(F.lit(0)))  # RANGES rows
    return snapshot_ranges(spark, sf).select("range_no", (F.col("n") * RANGES <= 2 * every).alias("even"), every.alias("n_rows"))


def q_feed_transactions(spark, sf):
    path = _write_feed(spark, _raw_transactions_text(_tt(spark, sf)), FEED_PREFIX_TRANSACTIONS, ".txt")
    return feeds.read_transactions(spark, path)


def q_feed_blacklist(spark, sf):
    b = _tt(spark, sf).blacklist().select(F.col("enty_dt").cast("string").alias("date"),
                                          F.col("passport_num").alias("passport"))
    return feeds.read_blacklist(spark, _write_feed(spark, b, FEED_PREFIX_BLACKLIST, ".csv"))


def q_feed_terminals(spark, sf):
    t = _all(spark, sf).snapshot("terminals").drop("update_dt")
    return feeds.read_terminals(spark, _write_feed(spark, t, FEED_PREFIX_TERMINALS, ".csv"))


def _write_entries(spark, tt) -> str:
    """A feed folder as it is delivered: an entry per feed and day; the transactions of that day's
    file, and the headers alone of the other feeds (their listing reads no content)."""
    root = scratch_dir(spark, "feeds")
    t = _raw_transactions_text(tt, keep=["feed_dt"])
    name = lambda src: F.concat(F.lit(FEED_PREFIXES[src]), F.date_format("feed_dt", "ddMMyyyy"), F.lit(FEED_EXT[src]))
    fields = [c for c in t.columns if c != "feed_dt"]
    lines = t.select(name("transactions").alias("name"), F.concat_ws(";", *fields).alias("value"))
    days = _feed_days(tt).withColumnRenamed("d", "feed_dt")
    heads = {"transactions": ";".join(fields), "blacklist": "date;passport", "terminals": "terminal_id;terminal_type;terminal_city;terminal_address"}
    for src, head in heads.items():
        lines = lines.unionByName(days.select(name(src).alias("name"), F.lit(head).alias("value")))
    feeds.write_text_entries(lines, root)
    return root


def q_feed_select(spark, sf, mode=feeds.INTENDED):
    tt = _tt(spark, sf)
    names = feeds.list_entries(spark, _write_entries(spark, tt))
    return feeds.pick_feeds(names, meta_before(tt), FEED_PREFIXES, mode)


def q_feed_entries(spark, sf):
    """The listing itself: every entry's name and date, no content."""
    spark.dataSource.register(feeds.FeedEntries)
    listed = spark.read.format("feed_entries").load(_write_entries(spark, _tt(spark, sf)))
    return listed.select("name", "file_dt", "folder")


# ------------------------------------------------------------------ staging / sinks
def q_stage_transactions(spark, sf):
    return staging.stage_transactions(q_feed_transactions(spark, sf))[0]


def q_stage_terminals(spark, sf):
    return staging.stage_terminals(q_feed_terminals(spark, sf), FEED_DT)[0]


def q_stage_blacklist(spark, sf):
    return staging.stage_blacklist(q_feed_blacklist(spark, sf))[0]


def q_fact_transactions_append(spark, sf):
    root = scratch_dir(spark, "fact")
    rows = _tt(spark, sf).transactions()
    warehouse.append_transactions(rows, root, "r1", feed_dt_col=F.col("feed_dt"))
    return warehouse.read_transactions(spark, root, ["r1"])


def q_fact_append_existing(spark, sf):
    """K2 and K7 onto a filled fact: a bootstrap run, a run that fails before it commits, its rerun
    with the report day's file; what the failed one wrote for another day is not seen."""
    root = scratch_dir(spark, "fact")
    rows = _tt(spark, sf).transactions()
    earlier = rows.where(F.col("feed_dt") < date_lit(REPORT_DT))
    warehouse.append_transactions(earlier, root, "r1", feed_dt_col=F.col("feed_dt"))
    warehouse.commit(spark, root, "r1", RUN_TS, expect_previous=None)
    warehouse.append_transactions(rows, root, "r2", feed_dt_col=F.col("feed_dt"))  # and stops
    day = rows.where(F.col("feed_dt") == date_lit(REPORT_DT))
    warehouse.append_transactions(day, root, "r2", feed_dt=REPORT_DT)
    warehouse.commit(spark, root, "r2", RUN_TS, transactions_dt=REPORT_DT, expect_previous="r1")
    warehouse.append_transactions(rows, root, "r3", feed_dt_col=F.col("feed_dt"))  # never committed
    return warehouse.current_transactions(spark, root)


def q_report_append_mart(spark, sf):
    """K4 and K7: a run that writes more report rows than its rerun, and stops; the rerun commits."""
    root = scratch_dir(spark, "mart")
    mart = q_report_contract(spark, sf)
    warehouse.write_reports(q_report_contract(spark, sf, reports.LITERAL), root, "r1")  # and stops
    warehouse.write_reports(mart, root, "r1")
    warehouse.commit(spark, root, "r1", RUN_TS, transactions_dt=REPORT_DT, expect_previous=None)
    return warehouse.current_reports(spark, root)


def q_stage_wide_values(spark, sf):
    """S3 with names and phones beyond the original column widths: every row stays."""
    wide = _all(spark, sf).snapshot("clients").withColumns({
        "last_name": F.concat("last_name", F.repeat(F.lit("x"), 40)), "phone": F.concat("phone", F.lit(" extension 12345"))})
    return staging.stage_snapshot("clients", wide)[0]


def q_watermark_after_literal_run(spark, sf):
    """K6, then K5, as a literal run does: every row takes the last snapshot's date, then each loaded
    feed its own."""
    m = q_watermark_advance_snapshots(spark, sf, watermark.LITERAL)
    return watermark.advance_feeds(m, {"transactions": FEED_DT, "terminals": FEED_DT, "blacklist": None})


def q_fact_blacklist_refresh(spark, sf):
    root = scratch_dir(spark, "blacklist")
    warehouse.refresh_blacklist(_tt(spark, sf).blacklist(), root, run_id="r1")
    return warehouse.read_blacklist(spark, root, run_id="r1")


def q_stage_refresh_rewrite(spark, sf):
    """K1 onto filled staging: a committed run's copy, then a run whose snapshot lacks some cards.  Until
    that run commits, the older copy is the current one; afterwards nothing of it is left in the current."""
    root = scratch_dir(spark, "staging")
    columns = ["card_num", "account_num", "create_dt", "update_dt"]

    def stage(tt, run_id, previous):
        st = staging.stage_snapshot("cards", tt.snapshot("cards"))
        warehouse.write_staging(st.tagged, root, "cards", run_id)
        current = warehouse.current_staging(spark, root, "cards")  # as readers see it meanwhile
        warehouse.commit(spark, root, run_id, RUN_TS, dim_runs={"cards": run_id}, expect_previous=previous)
        return current

    stage(_all(spark, sf), "r1", None)
    before = stage(_tt(spark, sf), "r2", "r1")
    after = warehouse.current_staging(spark, root, "cards")
    return (before.select(F.lit("before").alias("seen"), *columns)
            .unionByName(after.select(F.lit("after").alias("seen"), *columns)))


def q_blacklist_refresh_rewrite(spark, sf):
    """K3 onto a filled blacklist: the later file names other passports; the earlier ones are gone
    once its run commits, and not before."""
    root = scratch_dir(spark, "blacklist")
    tt = _tt(spark, sf)
    earlier = tt.snapshot("clients").select(date_lit(REPORT_DT).alias("enty_dt"), "passport_num")
    warehouse.refresh_blacklist(earlier, root, "r1")
    warehouse.commit(spark, root, "r1", RUN_TS, blacklist_run="r1", expect_previous=None)
    warehouse.refresh_blacklist(tt.blacklist(), root, "r2")
    before = warehouse.current_blacklist(spark, root)
    warehouse.commit(spark, root, "r2", RUN_TS, blacklist_run="r2", expect_previous="r1")
    after = warehouse.current_blacklist(spark, root)
    return before.withColumn("seen", F.lit("before")).unionByName(after.withColumn("seen", F.lit("after")))


def q_watermark_advance_snapshots(spark, sf, mode=watermark.INTENDED):
    tt = _all(spark, sf)
    maxima = watermark.snapshot_maxima({n: staged(tt, n) for n in ("cards", "accounts", "clients")})
    return watermark.advance_snapshots(meta_before(tt), maxima, mode)


# ------------------------------------------------------------------ reports
def _report_inputs(tt):
    return dict(fact=tt.transactions(), cards=staged(tt, "cards"),
                accounts=staged(tt, "accounts"), clients=staged(tt, "clients"))


def q_report_client_info(spark, sf):
    tt = _all(spark, sf)
    return reports.client_info(staged(tt, "accounts"), staged(tt, "clients"))


def q_report_trans_info(spark, sf):
    tt = _all(spark, sf)
    return reports.trans_info(tt.transactions(), staged(tt, "cards"), REPORT_DT)


def q_report_passport(spark, sf, mode=reports.INTENDED):
    tt = _all(spark, sf)
    return reports.passport_report(**_report_inputs(tt), blacklist=tt.blacklist(),
                                   report_dt=REPORT_DT, mode=mode)


def q_report_passport_prefilter(spark, sf):
    """R1 with the transactions told by a bitmap of the cards that can matter."""
    tt = _all(spark, sf)
    return reports.passport_report(**_report_inputs(tt), blacklist=tt.blacklist(), report_dt=REPORT_DT, prefilter=True)


def q_report_contract(spark, sf, mode=reports.INTENDED):
    return reports.contract_report(**_report_inputs(_all(spark, sf)), report_dt=REPORT_DT, mode=mode)


def q_report_hop_pairs(spark, sf, mode=reports.INTENDED):
    tt = _all(spark, sf)
    return reports.hop_pairs(tt.transactions(), tt.snapshot("terminals"), REPORT_DT, mode)


def _stored_fact(spark, tt) -> DataFrame:
    """The fact as a warehouse holds it: one run with the report day's file, one with all others."""
    root = scratch_dir(spark, "fact")
    rows, day = tt.transactions(), F.col("feed_dt")
    for run_id, part in (("r1", rows.where(day != date_lit(REPORT_DT))), ("r2", rows.where(day == date_lit(REPORT_DT)))):
        warehouse.append_transactions(part, root, run_id, feed_dt_col=day)
    return warehouse.read_transactions(spark, root, ["r1", "r2"], days=True)


def q_report_hop_pairs_stored(spark, sf):
    """R3a from a stored fact of which only the delivered rows' days are opened."""
    tt = _all(spark, sf)
    return reports.hop_pairs(_stored_fact(spark, tt), tt.snapshot("terminals"), REPORT_DT)


def q_report_city_hop_stored(spark, sf):
    tt = _tt(spark, sf)
    return reports.city_hop_report(_stored_fact(spark, tt), tt.snapshot("terminals"), open_after(tt, "cards"),
                                   open_after(tt, "accounts"), open_after(tt, "clients"), REPORT_DT)


def q_report_city_hop(spark, sf, mode=reports.INTENDED):
    tt = _tt(spark, sf)
    return reports.city_hop_report(tt.transactions(), tt.snapshot("terminals"),
                                   open_after(tt, "cards"), open_after(tt, "accounts"),
                                   open_after(tt, "clients"), REPORT_DT, mode)


def q_report_fraud_all(spark, sf, mode=reports.INTENDED):
    tt = _tt(spark, sf)
    return reports.fraud_mart(**_report_inputs(tt), blacklist=tt.blacklist(),
                              terminals=tt.snapshot("terminals"),
                              cards_open=open_after(tt, "cards"),
                              accounts_open=open_after(tt, "accounts"),
                              clients_open=open_after(tt, "clients"),
                              report_dt=REPORT_DT, mode=mode)


# ------------------------------------------------------------------ relational primitives
def q_join_inner(spark, sf):
    tt = _all(spark, sf)
    a, c = staged(tt, "accounts"), staged(tt, "clients")
    return a.join(c, a.client == c.client_id, "inner").select("account_num", "client_id", "passport_num")


def q_join_trimmed_key(spark, sf):
    tt = _all(spark, sf)
    return reports.trans_info(tt.transactions(), staged(tt, "cards"), REPORT_DT,
                              reports.LITERAL, "contract")


def q_join_left(spark, sf):
    tt = _all(spark, sf)
    t = tt.transactions().select("trans_id", "terminal")
    term = tt.snapshot("terminals").select("terminal_id", "terminal_city")
    return t.join(term, t.terminal == term.terminal_id, "left").select("trans_id", "terminal",
                                                                       "terminal_city")


def q_join_anti(spark, sf):
    """Staged cards without a live open version (the H1 candidates)."""
    tt = _tt(spark, sf)
    live = scd2.open_rows(tt.dim_before("cards")).where(F.col("deleted_flg") == "N")
    return staged(tt, "cards").join(live.select("card_num"), "card_num", "left_anti")


def q_join_semi(spark, sf):
    """Live open versions whose key is missing from the snapshot (D1/E1 rows)."""
    tt = _tt(spark, sf)
    live = scd2.open_rows(tt.dim_before("cards")).where(F.col("deleted_flg") == "N")
    gone = live.select("card_num").join(staged(tt, "cards").select("card_num"), "card_num",
                                        "left_anti")
    return live.join(gone, "card_num", "left_semi")


def q_join_existence(spark, sf):
    tt = _all(spark, sf)
    c = staged(tt, "clients")
    bad = (F.col("passport_num").isin(tt.blacklist().select("passport_num"))
           | (F.col("passport_valid_to") < date_lit(REPORT_DT)))
    return c.where(bad).select("client_id", "passport_num", "passport_valid_to")


def q_join_multi_key(spark, sf):
    """Staged terminals matched to live open versions on (type, city, address)."""
    tt = _all(spark, sf)
    s = tt.snapshot("terminals")
    o = scd2.open_rows(tt.dim_before("terminals")).where(F.col("deleted_flg") == "N")
    keys = ["terminal_type", "terminal_city", "terminal_address"]
    return (s.select(F.col("terminal_id").alias("stg_id"), *keys)
            .join(o.select(F.col("terminal_id").alias("dim_id"), *keys), keys, "inner")
            .select("stg_id", "dim_id", *keys))


def q_filter_success(spark, sf):
    t = _tt(spark, sf).transactions()
    return t.where(F.col("oper_result") == "SUCCESS").select("trans_id", "trans_date", "oper_type")


def q_filter_null_safe_diff(spark, sf):
    tt = _all(spark, sf)
    spec = DIMS["clients"]
    o = scd2.open_rows(tt.dim_before("clients")).where(F.col("deleted_flg") == "N")
    s = staged(tt, "clients")
    j = s.alias("s").join(o.alias("o"), F.col("s.client_id") == F.col("o.client_id"), "inner")
    diff = null_safe_differs([(F.col("s." + a), F.col("o." + a)) for a in spec.attrs])
    return j.where(diff).select(F.col("s.client_id").alias("client_id"),
                                F.col("s.update_dt").alias("update_dt"))


def q_distinct_rows(spark, sf):
    t = _tt(spark, sf).transactions()
    return t.select(F.trim("card_num").alias("card_num"), "terminal").distinct()


def q_agg_latest_event(spark, sf):
    t = _tt(spark, sf).transactions().where(F.col("oper_result") == "SUCCESS")
    return (t.groupBy(F.trim("card_num").alias("card_num"))
            .agg(F.max("trans_date").alias("last_trans_date")))


def q_agg_max_update(spark, sf):
    tt = _all(spark, sf)
    return watermark.snapshot_maxima({n: staged(tt, n) for n in ("cards", "accounts", "clients")})


def q_coalesce_scalar_subquery(spark, sf):
    """Per snapshot source: coalesce((max update_dt of staging), (its watermark)),
    each operand a scalar subquery."""
    tt = _tt(spark, sf)
    meta = meta_before(tt)
    parts = []
    for n in ("cards", "accounts", "clients"):
        mx = staged(tt, n).select(F.max("update_dt").cast("date")).scalar()
        old = meta.where(F.col("source_name") == n).select("max_update_dt").scalar()
        parts.append(meta.where(F.col("source_name") == n)
                     .select("source_name", F.coalesce(mx, old).alias("max_update_dt")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_window_lead(spark, sf):
    """Each transaction with the next one's id on its card; a card's last row shows NULL."""
    t = _tt(spark, sf).transactions().select("trans_id", "trans_date", F.trim("card_num").alias("card_num"))
    return with_next(t, "card_num", ["trans_date", "trans_id"], ["trans_id"]).withColumnRenamed("lead_trans_id", "lead_tran")


def history_after(tt, name: str) -> DataFrame:
    return scd2.next_state(tt.dim_before(name), staged(tt, name), DIMS[name], _clock())


def q_report_hop_base(spark, sf):
    tt = _all(spark, sf)
    return reports.hop_base(tt.transactions(), tt.snapshot("terminals"),
                            *[history_after(tt, n) for n in ("cards", "accounts", "clients")])


def q_sort_report(spark, sf):
    return q_report_passport(spark, sf).orderBy("fio")


def _scd2_query(name: str, step: str | None) -> Query:
    def q(spark, sf):
        tt = _tt(spark, sf)
        if step is None:
            return scd2.next_state(tt.dim_before(name), staged(tt, name), DIMS[name], _clock())
        return scd2.step_rows(merged(tt, name), DIMS[name], step)
    q.__name__ = f"scd2_{step or 'merge'}_{name}"
    return q


def _bucketed(spark, sf, name) -> tuple[str, adapters.TestTables]:
    root, tt = scratch_dir(spark, "buckets"), _tt(spark, sf)
    buckets.bootstrap(tt.dim_before(name), root, name, "r1")
    return root, tt


def _scd2_buckets_query(name: str) -> Query:
    """The dimension stored by key bucket, refreshed (changed buckets alone) and read back."""
    def q(spark, sf):
        root, tt = _bucketed(spark, sf, name)
        buckets.refresh(staged(tt, name), root, name, "r2", "r1", _clock())
        return buckets.history(spark, root, name, "r2")
    q.__name__ = f"scd2_merge_{name}_buckets"
    return q


def q_scd2_classes_digest(spark, sf):
    """What happens to each client, told by the stored digests."""
    root, tt = _bucketed(spark, sf, "clients")
    return buckets.classes(buckets.open_versions(spark, root, "clients", "r1"), staged(tt, "clients"), DIMS["clients"])


def _scd2_literal_query(name: str) -> Query:
    def q(spark, sf):
        tt = _tt(spark, sf)
        return literal.step(tt.dim_before(name), staged(tt, name), DIMS[name], _clock())
    q.__name__ = f"scd2_merge_{name}_literal"
    return q


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "snapshot_cards": lambda s, sf: staged(_all(s, sf), "cards"),
        "snapshot_accounts": lambda s, sf: staged(_all(s, sf), "accounts"),
        "snapshot_clients": lambda s, sf: staged(_all(s, sf), "clients"),
        "snapshot_ranges": q_snapshot_ranges,
        "feed_transactions": q_feed_transactions,
        "feed_blacklist": q_feed_blacklist,
        "feed_terminals": q_feed_terminals,
        "watermark_read": lambda s, sf: watermark.read(meta_before(_tt(s, sf)), "transactions"),
        "feed_select": q_feed_select,
        "feed_select_literal": lambda s, sf: q_feed_select(s, sf, feeds.LITERAL),
        "stage_transactions": q_stage_transactions,
        "stage_terminals": q_stage_terminals,
        "stage_blacklist": q_stage_blacklist,
        "keys_cards": lambda s, sf: staging.key_snapshot(staged(_all(s, sf), "cards"), "cards"),
        "keys_accounts": lambda s, sf: staging.key_snapshot(staged(_all(s, sf), "accounts"), "accounts"),
        "keys_clients": lambda s, sf: staging.key_snapshot(staged(_all(s, sf), "clients"), "clients"),
        "keys_terminals": lambda s, sf: staging.key_snapshot(staged(_all(s, sf), "terminals"), "terminals"),
        "stage_wide_values": q_stage_wide_values,
        "fact_transactions_append": q_fact_transactions_append,
        "fact_append_existing": q_fact_append_existing,
        "watermark_after_literal_run": q_watermark_after_literal_run,
        "fact_blacklist_refresh": q_fact_blacklist_refresh,
        "feed_entries": q_feed_entries,
        "stage_refresh_rewrite": q_stage_refresh_rewrite,
        "blacklist_refresh_rewrite": q_blacklist_refresh_rewrite,
        "watermark_advance_feeds": lambda s, sf: watermark.advance_feeds(
            meta_before(_tt(s, sf)), {"transactions": FEED_DT, "blacklist": FEED_DT,
                                      "terminals": FEED_DT}),
        "watermark_advance_snapshots": q_watermark_advance_snapshots,
        "watermark_advance_snapshots_literal": lambda s, sf: q_watermark_advance_snapshots(
            s, sf, watermark.LITERAL),
    }
    for name in ("cards", "accounts", "clients", "terminals"):
        for step in scd2.STEPS:
            q[f"scd2_{step}_{name}"] = _scd2_query(name, step)
        q[f"scd2_merge_{name}"] = _scd2_query(name, None)
        q[f"scd2_merge_{name}_literal"] = _scd2_literal_query(name)
    for name in ("clients", "terminals"):
        q[f"scd2_merge_{name}_buckets"] = _scd2_buckets_query(name)
    q["scd2_classes_digest"] = q_scd2_classes_digest
    q.update({
        "report_client_info": q_report_client_info,
        "report_trans_info": q_report_trans_info,
        "report_passport": q_report_passport,
        "report_contract": q_report_contract,
        "report_hop_pairs": q_report_hop_pairs,
        "report_hop_base": q_report_hop_base,
        "report_hop_pairs_stored": q_report_hop_pairs_stored,
        "report_city_hop_stored": q_report_city_hop_stored,
        "report_append_mart": q_report_append_mart,
        "report_city_hop": q_report_city_hop,
        "report_fraud_all": q_report_fraud_all,
        "report_passport_prefilter": q_report_passport_prefilter,
        "report_passport_literal": lambda s, sf: q_report_passport(s, sf, reports.LITERAL),
        "report_contract_literal": lambda s, sf: q_report_contract(s, sf, reports.LITERAL),
        "report_hop_pairs_literal": lambda s, sf: q_report_hop_pairs(s, sf, reports.LITERAL),
        "report_city_hop_literal": lambda s, sf: q_report_city_hop(s, sf, reports.LITERAL),
        "report_fraud_all_literal": lambda s, sf: q_report_fraud_all(s, sf, reports.LITERAL),
        "join_inner": q_join_inner,
        "join_trimmed_key": q_join_trimmed_key,
        "join_left": q_join_left,
        "join_anti": q_join_anti,
        "join_semi": q_join_semi,
        "join_existence": q_join_existence,
        "join_multi_key": q_join_multi_key,
        "filter_success": q_filter_success,
        "filter_null_safe_diff": q_filter_null_safe_diff,
        "distinct_rows": q_distinct_rows,
        "agg_latest_event": q_agg_latest_event,
        "agg_max_update": q_agg_max_update,
        "coalesce_scalar_subquery": q_coalesce_scalar_subquery,
        "window_lead": q_window_lead,
        "sort_report": q_sort_report,
    })
    return q
