"""Per-source watermarks (S7, K5, K6).

``meta`` holds (schema_name, source_name, max_update_dt), one row per
source.  It is a handful of rows; updates are expressed as projections of
the whole table, never as driver-side loops over data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.expr import date_lit
from cardwatch.schemas import META, META_SCHEMA, META_SOURCES, WATERMARK_SEED

INTENDED, LITERAL = "intended", "literal"
FEED_SOURCES = ("transactions", "blacklist", "terminals")


def seed(spark: SparkSession, schema_name: str = META_SCHEMA) -> DataFrame:
    rows = [(schema_name, s, WATERMARK_SEED) for s in META_SOURCES]
    return spark.createDataFrame(rows, META)


def read(meta: DataFrame, source: str, schema_name: str = META_SCHEMA) -> DataFrame:
    """S7: the last processed date of one source (one row, or none)."""
    return (meta.where((F.col("schema_name") == schema_name) & (F.col("source_name") == source))
            .select("max_update_dt"))


def advance_feeds(meta: DataFrame, file_dates: dict[str, dt.date | None],
                  before: DataFrame | None = None) -> DataFrame:
    """K5: set each loaded feed's watermark to its file date; feeds that
    loaded nothing (None) keep theirs: the one in ``meta``, or in ``before`` if that is
    given (a literal run's snapshot updates have overwritten the one in ``meta``)."""
    v = F.col("max_update_dt")
    if before is not None:
        meta = meta.join(before.select("source_name", F.col("max_update_dt").alias("_old")), "source_name", "left")
        v = F.when(F.col("source_name").isin(*FEED_SOURCES), F.col("_old")).otherwise(v)
    for source, d in file_dates.items():
        if d is not None:
            v = F.when(F.col("source_name") == source, date_lit(d)).otherwise(v)
    return meta.select("schema_name", "source_name", v.alias("max_update_dt"))


def snapshot_maxima(staged: dict[str, DataFrame]) -> DataFrame:
    """(source_name, max_dt): the latest ``update_dt`` of each staged snapshot
    (NULL when the snapshot has none)."""
    parts = [df.agg(F.max("update_dt").cast("date").alias("max_dt"))
             .select(F.lit(src).alias("source_name"), "max_dt") for src, df in staged.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def advance_snapshots(meta: DataFrame, maxima: DataFrame, mode: str = INTENDED,
                      order: tuple[str, ...] = ("cards", "accounts", "clients")) -> DataFrame:
    """K6: ``coalesce(max(update_dt), old value)`` per snapshot source.

    literal: each of the three updates has no row filter, so every row takes
    the value of the last one, computed from the value the one before left."""
    if mode == INTENDED:
        j = meta.join(maxima, "source_name", "left")
        return j.select("schema_name", "source_name",
                        F.coalesce(F.col("max_dt"), F.col("max_update_dt")).alias("max_update_dt"))
    cur = meta
    for src in order:
        mx = maxima.where(F.col("source_name") == src).select("max_dt").scalar()
        old = cur.where(F.col("source_name") == src).select("max_update_dt").scalar()
        cur = cur.select("schema_name", "source_name",
                         F.coalesce(mx, old).alias("max_update_dt"))
    return cur
