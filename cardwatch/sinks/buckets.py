"""Type-2 dimensions kept by key bucket: a run rewrites the buckets that changed, and no other.

    <root>/dimb_<name>/run=<id>/state=open/bucket=<b>/     open versions of the keys of a bucket
    <root>/dimb_<name>/run=<id>/state=closed/bucket=<b>/   versions that the run closed
    <root>/manifest_<name>/run=<id>/                       which run holds which bucket's open versions

The update-from-join of a day touches few keys, but a whole-table rewrite copies all of
them.  Here each open version carries a 128-bit digest of its tracked attributes.  A run
first compares the staged keys and digests with the stored ones, reading no attribute; the
buckets with a new, changed, deleted or returned key are merged and written under the
run's folder, and its manifest names, for every bucket, the run that holds it.  The files of
the other buckets are neither read nor copied.  As with the rest of the warehouse a run
writes only below its own id, so what it built on stays readable, and a rerun replaces what
it wrote.  The manifest is the run's last write: until then readers follow the one before.

The driver sees the buckets' numbers: the manifest's rows and the changed ones, at most the
bucket count, which is fixed when a dimension is first written.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.operators import scd2
from cardwatch.schemas import DIMS, FLAG_LIVE, DimSpec
from cardwatch.session import delete_folder

BUCKETS = 64
MANIFEST = T.StructType([T.StructField("state", T.StringType()), T.StructField("bucket", T.IntegerType()),
                         T.StructField("run", T.StringType()), T.StructField("buckets", T.IntegerType())])


def digest(spec: DimSpec) -> Column:
    """128 bits of the tracked attributes, by name and NULL-safe."""
    text = F.to_json(F.struct(*spec.attrs), {"ignoreNullFields": "false"})
    return F.unhex(F.md5(text.cast("binary")))


def bucket_of(spec: DimSpec, buckets: int) -> Column:
    return F.pmod(F.xxhash64(spec.key), F.lit(buckets)).cast("int")


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/dimb_{name}"


def _write(rows: DataFrame, root: str, name: str, run_id: str, buckets: int) -> None:
    """Rows with ``state``, one file a bucket and task at most, buckets brought together first."""
    spec = DIMS[name]
    delete_folder(rows.sparkSession, f"{_folder(root, name)}/run={run_id}")  # of a run that failed
    out = rows.select(*spec.dim_columns, digest(spec).alias("digest"), "state", bucket_of(spec, buckets).alias("bucket"))
    (out.hint("rebalance", "state", "bucket").write.mode("overwrite")
     .partitionBy("state", "bucket").parquet(f"{_folder(root, name)}/run={run_id}"))


def _write_manifest(spark: SparkSession, rows: list[tuple], root: str, name: str, run_id: str) -> None:
    (spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite")
     .parquet(f"{root.rstrip('/')}/manifest_{name}/run={run_id}"))


def _manifest(spark: SparkSession, root: str, name: str, run_id: str) -> list:
    """One row per bucket, and one per run that closed versions."""
    return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest_{name}/run={run_id}").collect()


def _read(spark: SparkSession, root: str, name: str, wanted: dict[str, list[int] | None], state: str) -> DataFrame:
    """Versions of the given runs' folders, and of the given buckets in them (None: all): partition filters."""
    spec = DIMS[name]
    schema = T.StructType([*spec.dim_schema().fields, T.StructField("digest", T.BinaryType()), T.StructField("run", T.StringType()),
                           T.StructField("state", T.StringType()), T.StructField("bucket", T.IntegerType())])
    if not wanted:
        return spark.createDataFrame([], schema)
    base = _folder(root, name)
    df = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/run={r}/state={state}" for r in wanted])
    keep = F.lit(False)
    for run, numbers in wanted.items():
        one = F.col("run") == run
        keep = keep | (one if numbers is None else one & F.col("bucket").isin(numbers))
    return df.where(keep)


def _holders(rows: list, only: set[int] | None = None) -> dict[str, list[int]]:
    out = defaultdict(list)
    for r in rows:
        if r.state == "open" and (only is None or r.bucket in only):
            out[r.run].append(r.bucket)
    return dict(out)


def bootstrap(history: DataFrame, root: str, name: str, run_id: str, buckets: int = BUCKETS) -> None:
    """Write a dimension's existing history (open and closed rows) by bucket."""
    spark = history.sparkSession
    state = F.when(F.col("end_dt") == scd2.inf_ts(), F.lit("open")).otherwise(F.lit("closed"))
    _write(history.withColumn("state", state), root, name, run_id, buckets)
    held = _read_written(spark, root, name, run_id)
    _write_manifest(spark, [(s, b, run_id, buckets) for s, b in held], root, name, run_id)


def _read_written(spark: SparkSession, root: str, name: str, run_id: str) -> list[tuple[str, int | None]]:
    """The open buckets that a run has written, and whether it has closed versions (``(closed, None)``); by
    the names of its folders."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    run = path(f"{_folder(root, name)}/run={run_id}")
    fs = run.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: list[tuple[str, int | None]] = []
    for state in fs.listStatus(run) if fs.exists(run) else ():
        if state.getPath().getName() == "state=closed":
            out.append(("closed", None))
        elif state.getPath().getName() == "state=open":
            out += [("open", int(b.getPath().getName().split("=")[1])) for b in fs.listStatus(state.getPath())
                    if b.getPath().getName().startswith("bucket=")]
    return out


def classes(open_versions: DataFrame, staged: DataFrame, spec: DimSpec, deletions: bool = True) -> DataFrame:
    """(key, class) of every key, told by key, digest and deletion flag alone: the scan of the open
    versions reads no attribute."""
    o = open_versions.where(F.col(spec.key).isNotNull()).select(spec.key, F.col("digest").alias("_o"), (F.col("deleted_flg") == FLAG_LIVE).alias("_live"))
    s = staged.where(F.col(spec.key).isNotNull()).select(spec.key, digest(spec).alias("_s"))
    gone = F.lit(scd2.DELETED if deletions else scd2.SAME)
    kind = (F.when(F.col("_o").isNull(), scd2.NEW)
            .when(F.col("_s").isNull(), F.when(F.col("_live"), gone).otherwise(scd2.STILL_DELETED))
            .when(~F.col("_live"), scd2.RETURNED)
            .when(F.col("_o") != F.col("_s"), scd2.CHANGED).otherwise(scd2.SAME))
    return o.join(s, spec.key, "full_outer").select(spec.key, kind.alias("class"))


def refresh(staged: DataFrame, root: str, name: str, run_id: str, previous: str, clock: scd2.Clock,
            deletions: bool = True) -> list[int]:
    """Merge a snapshot into the dimension as run ``previous`` left it; the numbers of the buckets
    that were rewritten.  Keys must be unique in ``staged``."""
    spark, spec = staged.sparkSession, DIMS[name]
    before = _manifest(spark, root, name, previous)
    n = before[0].buckets if before else BUCKETS
    found = classes(_read(spark, root, name, _holders(before), "open"), staged, spec, deletions)
    changed = found.where(~F.col("class").isin(scd2.SAME, scd2.STILL_DELETED)).select(bucket_of(spec, n).alias("b")).distinct()
    numbers = sorted(r.b for r in changed.collect())  # at most the bucket count
    if numbers:
        here = _read(spark, root, name, _holders(before, set(numbers)), "open").select(*spec.dim_columns)
        part = staged.where(bucket_of(spec, n).isin(numbers))
        _write(scd2.merge(here, part, spec, clock, deletions), root, name, run_id, n)
    wrote = _read_written(spark, root, name, run_id) if numbers else []
    mine = {b for s, b in wrote if s == "open"}
    rows = [tuple(r) for r in before if r.state == "closed" or r.bucket not in mine]
    _write_manifest(spark, rows + [(s, b, run_id, n) for s, b in wrote], root, name, run_id)
    return numbers


def open_versions(spark: SparkSession, root: str, name: str, run_id: str) -> DataFrame:
    """The open versions after a run, each bucket from the run that wrote it last."""
    rows = _manifest(spark, root, name, run_id)
    return _read(spark, root, name, _holders(rows), "open").select(*DIMS[name].dim_columns, "digest", "bucket", "run")


def history(spark: SparkSession, root: str, name: str, run_id: str) -> DataFrame:
    """A dimension's whole history after a run."""
    rows = _manifest(spark, root, name, run_id)
    closed = {r.run: None for r in rows if r.state == "closed"}
    return (_read(spark, root, name, _holders(rows), "open").select(*DIMS[name].dim_columns)
            .unionByName(_read(spark, root, name, closed, "closed").select(*DIMS[name].dim_columns)))
