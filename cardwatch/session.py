"""Session construction and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  AQE re-plans joins at
# runtime (broadcast only when the measured shuffle side is small, skew
# splitting for hot join keys, partition coalescing).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    # checkpoints (owner-lookup key sets, R3 slices) are removed from the shared
    # checkpoint folder once no DataFrame references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "cardwatch", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if shuffle_partitions:  # else the cluster's setting, or Spark's own default
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for derived files: the cluster's ``spark.checkpoint.dir``.

    Only when a local session names none (as in tests) do we create a local
    one and register it, so later ``checkpoint()`` calls work too; on a cluster,
    whose executors would not see it, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cardwatch-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Scratch folders of this process by application, in the order they were given out.
_SCRATCH: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder under the shared scratch root.  It stays until
    ``release_scratch`` or the ``scratch_scope`` around it deletes it."""
    path = f"{scratch_root(spark)}/cardwatch/{purpose}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever file system its path names; False if it isn't there."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath) and fs.delete(hpath, True))


def release_scratch(spark: SparkSession, since: int = 0) -> list[str]:
    """Delete the scratch folders given out so far (from number ``since`` on); DataFrames that read
    them must have been written or collected before."""
    held = _SCRATCH.get(spark.sparkContext.applicationId, [])
    gone = held[since:]
    del held[since:]
    for path in gone:
        delete_folder(spark, path)
    return gone


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes, at its end, the scratch folders given out inside."""
    since = len(_SCRATCH.setdefault(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release_scratch(spark, since)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = scratch_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root
