"""Rows joined to the version of a history that was valid at their time.

A join on the key alone would meet every row of a key with every version of it, which
grows with the product for a busy card with a long history.  Here the rows' distinct
(key, day) first meet the versions, clipped to those days: nearly always one version a
day.  The rows then join on (key, day), an equi-join that also splits a hot key by day;
the exact interval test is left for the few days on which the version changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "start_dt", "end_dt"


def valid_at(time: Column, start: Column, end: Column) -> Column:
    """Intervals are whole seconds, both ends included: the last second counts in full."""
    return (start <= time) & (time < end + F.expr("INTERVAL 1 SECOND"))


def as_of(rows: DataFrame, history: DataFrame, key: str, time: str, history_key: str,
          attrs: dict[str, str]) -> DataFrame:
    """``rows`` with ``attrs`` (history column -> name in the result) of the version of ``key``
    that is valid at ``time``; NULL where there is none (no such key, a gap, a NULL key or
    time).  Every row stays; versions that overlap give a row each."""
    versions = history.where(F.col(history_key).isNotNull()).select(
        F.col(history_key).alias("_k"), F.col(START).alias("_from"), F.col(END).alias("_to"),
        *[F.col(c).alias("_v_" + name) for c, name in attrs.items()])
    day = F.to_date(time)
    days = (rows.where(F.col(key).isNotNull() & F.col(time).isNotNull())
            .select(F.col(key).alias("_key"), day.alias("_day")).distinct())
    meet = ((F.col("_k") == F.col("_key")) & (F.to_date("_from") <= F.col("_day"))
            & (F.to_date("_to") >= F.col("_day")))
    by_day = days.join(versions, meet, "inner").drop("_k")
    on = ((F.col(key) == F.col("_key")) & (day == F.col("_day"))
          & valid_at(F.col(time), F.col("_from"), F.col("_to")))
    return rows.join(by_day, on, "left").select(
        *[rows[c] for c in rows.columns], *[F.col("_v_" + name).alias(name) for name in attrs.values()])
