"""The daily run: stage, load history and facts, advance watermarks, report,
then publish.

Orchestration lives on the driver (which feed file to take, whether a step
runs at all); every data step is a Spark job.  Staged inputs are written once
under the run's folder and read back, so each source is scanned once and
lineage is cut at the staging boundary.  Nothing is visible to readers until
``warehouse.commit`` writes the run's row last.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.operators import literal, scd2, staging
from cardwatch.plans import reports, watermark
from cardwatch.schemas import (DIMS, FEED_PREFIX_BLACKLIST, FEED_PREFIX_TERMINALS,
                               FEED_PREFIX_TRANSACTIONS, STG_BLACKLIST)
from cardwatch.sinks import warehouse
from cardwatch.sources import feeds

SNAPSHOT_DIMS = ("cards", "accounts", "clients")
PREFIXES = {"transactions": FEED_PREFIX_TRANSACTIONS, "blacklist": FEED_PREFIX_BLACKLIST,
            "terminals": FEED_PREFIX_TERMINALS}


@dataclass
class Sources:
    """Inputs of one run.  ``snapshots`` are full extracts of cards, accounts
    and clients (e.g. ``spark.read.jdbc(...)`` with caller-supplied options);
    ``feed_dir`` holds the dated feed entries."""

    snapshots: dict[str, DataFrame]
    feed_dir: str
    blacklist_format: str | None = None
    terminals_format: str | None = None


@dataclass
class RunResult:
    run_id: str
    run_ts: dt.datetime
    picked: dict[str, tuple[str, dt.date]] = field(default_factory=dict)
    rejects: dict[str, int] = field(default_factory=dict)
    reported: bool = False


class EmptySnapshot(RuntimeError):
    pass


class RejectedRows(ValueError):
    """A source holds rows that can't be used; nothing of the run is published."""


def _seconds(ts: dt.datetime) -> dt.datetime:
    """One run timestamp for the whole run, rounded half-up to whole seconds."""
    return (ts + dt.timedelta(microseconds=500_000)).replace(microsecond=0)


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def _stage_to(spark, root, run_id, name, st: staging.Staged) -> tuple[DataFrame, DataFrame]:
    """K1: write the staged rows with their reject reason in one pass over the
    source; read good rows and rejects back from that copy."""
    warehouse.write_staging(st.tagged, root, name, run_id)
    return _staged_by(spark, root, run_id, name, st.columns)


def _staged_by(spark, root, run_id, name, columns) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects of a source as that run staged them."""
    back = warehouse.read_staging(spark, root, name, run_id)
    return (back.where(F.col("reason").isNull()).select(*columns),
            back.where(F.col("reason").isNotNull()))


def _described(spark: SparkSession, run_id: str, what: str, fn):
    """Run ``fn`` with the Spark job description ``cardwatch <run> <what>``
    (a thread-local property), so event logs name the step of every job."""
    def wrapped(*args):
        spark.sparkContext.setJobDescription(f"cardwatch {run_id} {what}")
        try:
            return fn(*args)
        finally:
            spark.sparkContext.setJobDescription(None)
    return wrapped


def _side_by_side(fn, names: list[str]) -> list[tuple[str, object]]:
    """Run ``fn`` for each name from a few driver threads, so that independent
    Spark jobs are scheduled together; results in input order, and the first
    failure is raised."""
    if len(names) <= 1:
        return [(n, fn(n)) for n in names]
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        futures = [(n, pool.submit(fn, n)) for n in names]
        return [(n, f.result()) for n, f in futures]


def _one_per_key(open_rows: DataFrame, name: str) -> DataFrame:
    """The single open version per key that reports join.
    Intended history has exactly one; literal history may repeat a key, and
    then its latest version is taken, which also keeps the owner lookup's
    broadcast bound (one row per counted key)."""
    spec = DIMS[name]
    latest = F.max_by(F.struct(*spec.dim_columns), F.struct("start_dt", *spec.attrs))
    return (open_rows.groupBy(spec.key).agg(latest.alias("v")).select("v.*"))


def run(spark: SparkSession, sources: Sources, root: str, run_ts: dt.datetime,
        mode: str = "intended", allow_empty_snapshots: bool = False,
        open_buckets: int = 0, allow_rejects: bool = False,
        snapshots_of: RunResult | None = None) -> RunResult:
    """One daily run, published as a whole (see the module docstring).

    A row with a missing key or an unparsable value fails the run.  With
    ``allow_rejects`` it is left out and counted, and a dimension whose source
    had such rows deletes no key in this run (the key may be the unreadable
    one).  An empty snapshot or terminals file fails the run unless
    ``allow_empty_snapshots``.

    ``snapshots_of`` names the committed run whose staged snapshots are taken
    again, so that no source is extracted twice.  Merging the same snapshot once
    more changes nothing, so an intended run leaves those dimensions as that run
    wrote them (a literal one replays its statements over them).

    ``open_buckets`` > 0 writes the dimensions bucketed by key; set it to
    ``spark.sql.shuffle.partitions`` so the next run's merges read the open
    sets without shuffling them."""
    try:
        return _run(spark, sources, root, run_ts, mode, allow_empty_snapshots, open_buckets,
                    allow_rejects, snapshots_of)
    finally:
        spark.sparkContext.setJobDescription(None)


def _run(spark: SparkSession, sources: Sources, root: str, run_ts: dt.datetime,
         mode: str, allow_empty_snapshots: bool, open_buckets: int,
         allow_rejects: bool, snapshots_of: RunResult | None) -> RunResult:
    run_ts = _seconds(run_ts)
    run_id = warehouse.run_id_for(run_ts)
    res = RunResult(run_id, run_ts)
    runs = warehouse.committed_runs(spark, root)
    prev = runs.orderBy(F.col("run_id").desc()).limit(1).collect()  # one metadata row
    prev = prev[0].asDict() if prev else None
    if prev and prev["run_id"] >= run_id:
        raise ValueError(f"run {run_id} is not after the last committed run {prev['run_id']}")
    if snapshots_of and mode != "literal" and any(
            (prev or {}).get(f"{n}_run") != snapshots_of.run_id for n in SNAPSHOT_DIMS):
        raise ValueError(f"the dimensions are no longer as run {snapshots_of.run_id} wrote them")
    meta = warehouse.read_meta(spark, root, prev["run_id"]) if prev else watermark.seed(spark)

    # ---- which feed entries to load (one per feed, metadata only)
    names = feeds.list_entries(spark, sources.feed_dir)
    for row in feeds.pick_feeds(names, meta, PREFIXES, mode).collect():
        res.picked[row.feed] = (row.name, row.file_dt)
    path_of = {f: f"{sources.feed_dir.rstrip('/')}/{n}" for f, (n, _) in res.picked.items()}

    # ---- staging: every source is scanned once, then read back from Parquet;
    # the sources are independent, so their jobs are submitted side by side
    def stage(name: str):
        if name in SNAPSHOT_DIMS:
            st = staging.stage_snapshot(name, sources.snapshots[name])
            if snapshots_of:  # nothing is extracted: the plan alone tells the columns
                return (_staged_by(spark, root, snapshots_of.run_id, name, st.columns)[0],
                        snapshots_of.rejects[name])
        elif name == "transactions":
            st = staging.stage_transactions(feeds.read_transactions(spark, path_of[name]))
        elif name == "blacklist":
            st = staging.stage_blacklist(
                feeds.read_blacklist(spark, path_of[name], sources.blacklist_format))
        else:
            st = staging.stage_terminals(
                feeds.read_terminals(spark, path_of[name], sources.terminals_format),
                res.picked[name][1])
        good, bad = _stage_to(spark, root, run_id, name, st)
        n_bad = bad.count()
        if n_bad and not allow_rejects:
            reason = bad.select("reason").limit(1).collect()[0][0]
            raise RejectedRows(f"{name}: {n_bad} rows can't be used, for one: {reason}")
        if name in DIMS and not allow_empty_snapshots and good.isEmpty():
            raise EmptySnapshot(f"{name}: empty snapshot; refusing to tombstone every key")
        return good, n_bad

    staged = {}
    def stage_described(name: str):
        return _described(spark, run_id, f"stage {name}", stage)(name)

    for name, (good, n_bad) in _side_by_side(stage_described, [*SNAPSHOT_DIMS, *res.picked]):
        staged[name] = good
        res.rejects[name] = n_bad

    # ---- type-2 history: O(open + staged) per dimension (literal: O(history));
    # the dimensions are independent, so their merges run side by side
    dim_run = {n: (prev or {}).get(f"{n}_run") for n in DIMS}
    dim_mode = {}

    def merge_one(name: str) -> str:
        spec = DIMS[name]
        staging.assert_unique_keys(staged[name], name)
        writers = warehouse.holders(spark, root, name) if dim_run[name] else []
        clock = scd2.Clock(run_ts, res.picked.get("terminals", (None, None))[1])
        if mode == "literal":
            if res.rejects[name]:
                raise RejectedRows(f"{name}: the literal replay can't leave deletions out")
            hist = (warehouse.history_of(spark, root, name, writers) if writers
                    else _empty(spark, spec.dim_schema()))
            warehouse.write_full_history(literal.step(hist, staged[name], spec, clock), root,
                                         name, run_id)
        else:
            if writers:
                last_run, last_mode = writers[-1]
                open_now = warehouse.open_of(spark, root, name, last_run, last_mode,
                                             warehouse.buckets_of(spark, root, last_run))
            else:
                open_now = _empty(spark, spec.dim_schema())
            warehouse.write_dimension(
                scd2.merge(open_now, staged[name], spec, clock, deletions=not res.rejects[name]),
                root, name, run_id, buckets=open_buckets)
        return mode

    # ---- facts and watermarks
    blacklist_run = (prev or {}).get("blacklist_run")
    if "blacklist" in staged:
        blacklist_run = run_id
    dates = {f: d for f, (_, d) in res.picked.items()}

    def load_facts_and_meta() -> None:
        if "transactions" in staged:
            warehouse.append_transactions(staged["transactions"], root, run_id,
                                          feed_dt=res.picked["transactions"][1])
        if "blacklist" in staged:
            warehouse.refresh_blacklist(staged["blacklist"], root, run_id)
        maxima = watermark.snapshot_maxima({n: staged[n] for n in SNAPSHOT_DIMS})
        m = watermark.advance_snapshots(meta, maxima, mode)
        # the feeds last: the literal snapshot updates overwrite every row
        warehouse.write_meta(watermark.advance_feeds(m, dates, meta if mode == "literal" else None), root, run_id)

    # a missing feed is not an empty snapshot: that dimension stays as it is;
    # the merges, the fact loads and the watermarks write disjoint paths
    unchanged = SNAPSHOT_DIMS if snapshots_of and mode != "literal" else ()
    steps = [n for n in DIMS if n in staged and n not in unchanged] + ["facts"]
    def step(n: str):
        if n == "facts":
            return _described(spark, run_id, "facts and watermarks", load_facts_and_meta)()
        return _described(spark, run_id, f"merge {n}", merge_one)(n)

    done = _side_by_side(step, steps)
    for name, written_mode in done:
        if name != "facts":
            dim_run[name] = run_id
            dim_mode[name] = written_mode

    # ---- reports, only for a newly loaded transactions file
    if "transactions" in res.picked:
        spark.sparkContext.setJobDescription(f"cardwatch {run_id} reports")
        report_dt = res.picked["transactions"][1]
        # the delivered rows come from this run's folder alone; the earlier side of a
        # hop may have come with any file (its rows are found by day, card and hour)
        fact = warehouse.read_transactions(
            spark, root, [*warehouse.fact_runs(spark, root).values(), run_id], days=True)
        blacklist = (warehouse.read_blacklist(spark, root, blacklist_run) if blacklist_run
                     else _empty(spark, STG_BLACKLIST))
        opened = {}
        for n in DIMS:
            if not dim_run[n]:
                opened[n] = _empty(spark, DIMS[n].dim_schema())
                continue
            run_mode = dim_mode.get(n) or warehouse.holders(spark, root, n)[-1][1]
            opened[n] = warehouse.open_of(spark, root, n, dim_run[n], run_mode)
            if run_mode == "literal":  # an intended merge has just proved its keys unique
                opened[n] = _one_per_key(opened[n], n)
        # without a terminals file today, the live versions are the last file's rows
        terminals = staged.get("terminals", opened["terminals"].where(F.col("deleted_flg") == "N"))
        mart = reports.fraud_mart(fact, staged["cards"],
                                  staged["accounts"], staged["clients"], blacklist, terminals,
                                  opened["cards"], opened["accounts"], opened["clients"],
                                  report_dt, mode)
        warehouse.write_reports(mart, root, run_id)
        res.reported = True

    spark.sparkContext.setJobDescription(f"cardwatch {run_id} commit")
    warehouse.commit(spark, root, run_id, run_ts,
                     transactions_dt=dates.get("transactions"), blacklist_dt=dates.get("blacklist"),
                     terminals_dt=dates.get("terminals"), dim_runs=dim_run,
                     blacklist_run=blacklist_run, mode=mode,
                     expect_previous=prev["run_id"] if prev else None,
                     buckets=open_buckets if mode != "literal" else 0)
    return res
