"""Plain-Parquet warehouse layout with publish-last commits (K1-K7).

    <root>/stg_<source>/run=<id>/                   staged rows + reject reason (K1)
    <root>/dim_<name>/run=<id>/state=open|closed/   open set rewritten per run,
                                                    closed rows of that run only
    <root>/dim_<name>/run=<id>/state=history/       literal runs: whole history
    <root>/fact_transactions/run=<id>/feed_dt=<date>/trans_day=<date>/   rows that the run loaded
    <root>/fact_blacklist/run=<id>/                 full refresh per loaded file
    <root>/rep_fraud/run=<id>/report_dt=<d>/event_type=<t>/   its report rows
    <root>/meta/run=<id>/                           watermarks after the run
    <root>/runs/commit=<id>/                        one row per committed run

A run writes only under its own ``run=<id>`` folders, so it never overwrites a
path it reads, and a reader opens only the folders that the commit log names.
The ``runs`` row is written last; readers resolve the newest committed run and
ignore everything else, which makes a run all-or-nothing and a rerun (same
id) a clean overwrite.  Each write is a Spark job with task-level commit, so
a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions.expr import date_lit
from cardwatch.schemas import DIMS, META, REP_FRAUD, STG_BLACKLIST, STG_TRANSACTIONS
from cardwatch.session import delete_folder

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("run_ts", T.TimestampNTZType()),
    T.StructField("transactions_dt", T.DateType()), T.StructField("blacklist_dt", T.DateType()),
    T.StructField("terminals_dt", T.DateType()),
    T.StructField("cards_run", T.StringType()), T.StructField("accounts_run", T.StringType()),
    T.StructField("clients_run", T.StringType()), T.StructField("terminals_run", T.StringType()),
    T.StructField("blacklist_run", T.StringType()), T.StructField("mode", T.StringType()),
    T.StructField("buckets", T.IntegerType()),
    # whether the run wrote facts and report rows: readers needn't look
    T.StructField("facts", T.BooleanType()), T.StructField("reports", T.BooleanType()),
])
FACT_SCHEMA = T.StructType([*STG_TRANSACTIONS.fields, T.StructField("feed_dt", T.DateType()),
                            T.StructField("trans_day", T.DateType())])


def run_id_for(run_ts: dt.datetime) -> str:
    """Sortable run id from the run timestamp."""
    return run_ts.strftime("%Y%m%dT%H%M%S")


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


# ------------------------------------------------------------------ staging
def write_staging(tagged: DataFrame, root: str, name: str, run_id: str) -> None:
    """K1: this run's staged rows with their reject reason, in a folder of its own: what an
    earlier run staged stays readable until this run's commit makes the new copy current."""
    tagged.write.mode("overwrite").parquet(_p(root, f"stg_{name}", f"run={run_id}"))


def read_staging(spark: SparkSession, root: str, name: str, run_id: str) -> DataFrame:
    return spark.read.parquet(_p(root, f"stg_{name}", f"run={run_id}"))


def staging_run(spark: SparkSession, root: str, name: str) -> str | None:
    """The committed run whose staged copy of ``name`` is current (one row of the log)."""
    log = committed_runs(spark, root)
    if name == "transactions":
        log = log.where(F.col("transactions_dt").isNotNull()).select("run_id", F.col("run_id").alias("at"))
    else:
        log = log.select("run_id", F.col(f"{name}_run").alias("at"))
    return log.agg(F.max_by("at", "run_id").alias("m")).collect()[0].m


def current_staging(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The staged copy of the newest run that was committed with one; None before any."""
    run_id = staging_run(spark, root, name)
    return None if run_id is None else read_staging(spark, root, name, run_id)


# ------------------------------------------------------------------ facts
def append_transactions(rows: DataFrame, root: str, run_id: str, feed_dt: dt.date | None = None,
                        feed_dt_col: Column | None = None) -> None:
    """K2: add the staged transactions under this run's folder, by ``feed_dt`` and by the day
    of the transaction, so that a report opens the days that it can need.  A rerun with the
    same id replaces the whole folder; it is read once the run is committed.  Rows are sorted
    by time inside each task so that row-group statistics prune the report scans.  Rows of
    many files at once are first brought together by day (AQE splits large days)."""
    out = rows.select(*[f.name for f in STG_TRANSACTIONS.fields],
                      (feed_dt_col if feed_dt_col is not None else date_lit(feed_dt)).alias("feed_dt"),
                      F.to_date("trans_date").alias("trans_day"))
    if feed_dt_col is not None:
        out = out.hint("rebalance", "feed_dt", "trans_day")
    (out.sortWithinPartitions("feed_dt", "trans_day", "trans_date")
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("feed_dt", "trans_day").parquet(_p(root, "fact_transactions", f"run={run_id}")))


def read_transactions(spark: SparkSession, root: str, runs: list[str], days: bool = False) -> DataFrame:
    """The fact rows that ``runs`` (which wrote some) have written.  Only their folders are
    listed.  ``days`` adds the partition column ``trans_day``."""
    names = [f.name for f in FACT_SCHEMA.fields if days or f.name != "trans_day"]
    paths = [_p(root, "fact_transactions", f"run={r}") for r in dict.fromkeys(runs)]
    if not paths:
        return spark.createDataFrame([], FACT_SCHEMA).select(*names)
    read = spark.read.schema(FACT_SCHEMA).option("basePath", _p(root, "fact_transactions"))
    return read.parquet(*paths).select(*names)


def refresh_blacklist(rows: DataFrame, root: str, run_id: str) -> None:
    """K3: the blacklist fact is replaced by the staged file."""
    (rows.select(*[f.name for f in STG_BLACKLIST.fields]).write.mode("overwrite")
     .parquet(_p(root, "fact_blacklist", f"run={run_id}")))


def read_blacklist(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    return spark.read.schema(STG_BLACKLIST).parquet(_p(root, "fact_blacklist", f"run={run_id}"))


def current_blacklist(spark: SparkSession, root: str) -> DataFrame:
    """The blacklist as the newest committed run has it."""
    run_id = staging_run(spark, root, "blacklist")
    return spark.createDataFrame([], STG_BLACKLIST) if run_id is None else read_blacklist(spark, root, run_id)


# ------------------------------------------------------------------ dimensions
def write_dimension(merged: DataFrame, root: str, name: str, run_id: str,
                    buckets: int = 0) -> None:
    """Open set and this run's closed rows in one job, split by ``state``.

    With ``buckets`` the files are also bucketed and sorted by key (through a
    catalog table whose definition is dropped right away; the files stay).
    The next run reads the open set as a bucketed table, so its merge needs
    no shuffle of that side when ``buckets`` equals the shuffle partitions."""
    spec = DIMS[name]
    out = merged.select(*spec.dim_columns, "state").write.mode("overwrite").partitionBy("state")
    path = _p(root, f"dim_{name}", f"run={run_id}")
    if not buckets:
        out.parquet(path)
        return
    spark = merged.sparkSession
    table = f"cardwatch_w_{name}_{run_id.lower()}_{uuid.uuid4().hex[:8]}"
    out.bucketBy(buckets, spec.key).sortBy(spec.key).option("path", path).saveAsTable(table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # external table: only the definition goes


def write_history(history: DataFrame, root: str, name: str, run_id: str) -> None:
    """Bootstrap a dimension from existing history (open and closed rows)."""
    spec = DIMS[name]
    state = F.when(F.col("end_dt") == F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"),
                   F.lit("open")).otherwise(F.lit("closed"))
    write_dimension(history.select(*spec.dim_columns).withColumn("state", state), root, name,
                    run_id)


def _dim_frame(spark: SparkSession, root: str, name: str, runs: list[str]) -> DataFrame:
    """What ``runs`` have written of a dimension.  Only their folders are listed."""
    spec = DIMS[name]
    schema = T.StructType([*spec.dim_schema().fields, T.StructField("run", T.StringType()),
                           T.StructField("state", T.StringType())])
    return (spark.read.schema(schema).option("basePath", _p(root, f"dim_{name}"))
            .parquet(*[_p(root, f"dim_{name}", f"run={r}") for r in runs]))


def write_full_history(history: DataFrame, root: str, name: str, run_id: str) -> None:
    """Literal runs rewrite closed versions too, so they store the dimension's
    whole history (``state=history``)."""
    (history.select(*DIMS[name].dim_columns).withColumn("state", F.lit("history"))
     .write.mode("overwrite").partitionBy("state")
     .parquet(_p(root, f"dim_{name}", f"run={run_id}")))


def holders(spark: SparkSession, root: str, name: str) -> list[tuple[str, str]]:
    """(run_id, mode) of the committed runs that wrote ``name``, ascending
    (one row per daily run: metadata)."""
    log = committed_runs(spark, root).orderBy("run_id").collect()
    return [(r.run_id, r.mode or "intended") for r in log if r[f"{name}_run"] == r.run_id]


def buckets_of(spark: SparkSession, root: str, run_id: str) -> int:
    """Bucket count a committed run wrote its open sets with (0: none)."""
    row = (committed_runs(spark, root).where(F.col("run_id") == run_id)
           .select("buckets").collect())
    return (row[0][0] or 0) if row else 0


def history_of(spark: SparkSession, root: str, name: str,
               writers: list[tuple[str, str]]) -> DataFrame:
    """History after the last of ``writers``: the newest literal run's whole
    history, plus the closed rows of intended runs after it, plus the open set
    of the last run when that one is intended."""
    lit = [i for i, (_, m) in enumerate(writers) if m == "literal"]
    conds = []
    later = writers
    if lit:
        conds.append((F.col("run") == writers[lit[-1]][0]) & (F.col("state") == "history"))
        later = writers[lit[-1] + 1:]
    if later:
        conds.append(F.col("run").isin([r for r, _ in later]) & (F.col("state") == "closed"))
        conds.append((F.col("run") == later[-1][0]) & (F.col("state") == "open"))
    keep = conds[0]
    for c in conds[1:]:
        keep = keep | c
    runs = ([writers[lit[-1]][0]] if lit else []) + [r for r, _ in later]
    return _dim_frame(spark, root, name, runs).where(keep).select(*DIMS[name].dim_columns)


def open_of(spark: SparkSession, root: str, name: str, run_id: str, mode: str,
            buckets: int = 0) -> DataFrame:
    """The open versions (``end_dt = INF``) written by one run.  A bucketed
    open set is read through a bucketed table over the same folder."""
    if buckets and mode != "literal":
        spec = DIMS[name]
        location = _p(root, f"dim_{name}", f"run={run_id}", "state=open")
        # one table per folder and bucket count: the name is derived from both
        table = f"cardwatch_open_{name}_{uuid.uuid5(uuid.NAMESPACE_URL, f'{location}#{buckets}').hex}"
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.dim_schema().fields)
        location = location.replace("'", "\\'")
        # definitions only, and of one run at a time: those of earlier runs go
        for old in spark.catalog.listTables(pattern=f"cardwatch_open_{name}_*"):
            if old.name != table:
                spark.sql(f"DROP TABLE IF EXISTS {old.name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
                  f"CLUSTERED BY ({spec.key}) SORTED BY ({spec.key}) INTO {buckets} BUCKETS "
                  f"LOCATION '{location}'")
        return spark.table(table).select(*spec.dim_columns)
    df = _dim_frame(spark, root, name, [run_id])
    if mode == "literal":
        df = df.where((F.col("state") == "history")
                      & (F.col("end_dt") == F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")))
    else:
        df = df.where(F.col("state") == "open")
    return df.select(*DIMS[name].dim_columns)


def _current(spark: SparkSession, root: str, table: str, column: str) -> dict[dt.date | str, str]:
    """The committed run whose rows of ``table`` are current, by file date: the newest of each
    date, and those that loaded several dates at once.  One entry per run: metadata.  The log
    tells which runs wrote any; only rows of a log without that column are looked up."""
    log = committed_runs(spark, root).orderBy("run_id").select("run_id", "transactions_dt", column).collect()  # a row per run
    return {r.transactions_dt or r.run_id: r.run_id for r in log
            if r[column] or (r[column] is None and _exists(spark, _p(root, table, f"run={r.run_id}")))}


def fact_runs(spark: SparkSession, root: str) -> dict[dt.date | str, str]:
    return _current(spark, root, "fact_transactions", "facts")


def current_transactions(spark: SparkSession, root: str, days: bool = False) -> DataFrame:
    """The fact as committed: what a failed run left behind is ignored."""
    return read_transactions(spark, root, list(fact_runs(spark, root).values()), days)


def current_reports(spark: SparkSession, root: str) -> DataFrame:
    """The mart as committed: what a failed run left behind is ignored."""
    return read_reports(spark, root, list(_current(spark, root, "rep_fraud", "reports").values()))


def current_history(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A dimension's whole history as of the newest committed run."""
    return history_of(spark, root, name, holders(spark, root, name))


def current_open(spark: SparkSession, root: str, name: str) -> DataFrame:
    run_id, mode = holders(spark, root, name)[-1]
    return open_of(spark, root, name, run_id, mode)


# ------------------------------------------------------------------ reports, meta, rejects
def write_reports(rows: DataFrame, root: str, run_id: str) -> None:
    """K4: this run's report rows, in a folder of its own; a rerun replaces it whole."""
    (rows.select(*[f.name for f in REP_FRAUD.fields]).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("report_dt", "event_type")
     .parquet(_p(root, "rep_fraud", f"run={run_id}")))


def read_reports(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    """The report rows that ``runs`` (which wrote some) have written.  Only their folders are listed."""
    paths = [_p(root, "rep_fraud", f"run={r}") for r in dict.fromkeys(runs)]
    if not paths:
        return spark.createDataFrame([], REP_FRAUD)
    read = spark.read.schema(REP_FRAUD).option("basePath", _p(root, "rep_fraud"))
    return read.parquet(*paths).select(*[f.name for f in REP_FRAUD.fields])


def write_meta(meta: DataFrame, root: str, run_id: str) -> None:
    meta.select(*[f.name for f in META.fields]).write.mode("overwrite").parquet(
        _p(root, "meta", f"run={run_id}"))


def read_meta(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    return spark.read.schema(META).parquet(_p(root, "meta", f"run={run_id}"))




# ------------------------------------------------------------------ commit log
class ConcurrentRun(RuntimeError):
    pass


def last_run_id(spark: SparkSession, root: str) -> str | None:
    row = committed_runs(spark, root).agg(F.max("run_id").alias("m")).collect()[0]
    return row.m


def commit(spark: SparkSession, root: str, run_id: str, run_ts: dt.datetime,
           transactions_dt=None, blacklist_dt=None, terminals_dt=None,
           dim_runs: dict | None = None, blacklist_run: str | None = None,
           mode: str = "intended", expect_previous: str | None = "",
           buckets: int = 0) -> None:
    """K7: publish the run.  Written last; one tiny file per run.  The row
    also names, per dimension and for the blacklist, the run whose output is
    current (a run without a terminals file leaves that dimension as it was)."""
    if expect_previous != "":
        # optimistic check: another run must not have committed since this one
        # read the state it built on
        now = last_run_id(spark, root)
        if now != expect_previous:
            raise ConcurrentRun(f"run {run_id} built on {expect_previous}, but {now} "
                                f"committed meanwhile; rerun")
    d = dim_runs or {}
    row = [(run_id, run_ts, transactions_dt, blacklist_dt, terminals_dt, d.get("cards"),
            d.get("accounts"), d.get("clients"), d.get("terminals"), blacklist_run, mode,
            buckets, _exists(spark, _p(root, "fact_transactions", f"run={run_id}")),
            _exists(spark, _p(root, "rep_fraud", f"run={run_id}")))]
    (spark.createDataFrame(row, RUNS_SCHEMA).coalesce(1).write.mode("overwrite")
     .parquet(_p(root, "runs", f"commit={run_id}")))


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    path = _p(root, "runs")
    if not _exists(spark, path):
        return spark.createDataFrame([], RUNS_SCHEMA)
    return spark.read.schema(RUNS_SCHEMA).parquet(path)


def committed_run_ids(spark: SparkSession, root: str) -> list[str]:
    """Ids of committed runs, ascending (one row per daily run: metadata)."""
    rows = committed_runs(spark, root).select("run_id").orderBy("run_id").collect()
    return [r.run_id for r in rows]


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete copies no reader needs: open sets (and superseded literal
    histories) of a dimension older than the ``keep`` newest committed runs
    that wrote it, and staging copies of runs older than the ``keep`` newest
    committed runs.  Closed rows, facts,
    reports, watermarks and the commit log are never touched.  Metadata-only
    work on the driver (one folder delete per obsolete run)."""
    log = committed_runs(spark, root).orderBy("run_id").collect()  # one row per run
    if not log:
        return []
    removed = []
    for name in DIMS:
        writers = [(r.run_id, r.mode or "intended") for r in log if r[f"{name}_run"] == r.run_id]
        old_ones = writers[:-keep] if keep > 0 else writers
        literal_runs = [r for r, m in writers if m == "literal"]
        for run_id, mode in old_ones:
            states = ["state=open"]
            if literal_runs and run_id != literal_runs[-1]:
                states.append("state=history")  # superseded by the newest literal history
            for state in states:
                path = _p(root, f"dim_{name}", f"run={run_id}", state)
                if delete_folder(spark, path):
                    removed.append(path)
    runs = [r.run_id for r in log]
    in_use = {log[-1][f"{n}_run"] for n in (*DIMS, "blacklist")}  # a catch-up's runs share their staged copies
    for old in runs[:-keep] if keep > 0 else runs:
        if old in in_use:
            continue
        for src in ("cards", "accounts", "clients", "transactions", "blacklist", "terminals"):
            path = _p(root, f"stg_{src}", f"run={old}")
            if delete_folder(spark, path):
                removed.append(path)
    return removed
