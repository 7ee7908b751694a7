"""Type-2 history maintenance in one pass.

The open rows of a dimension (``end_dt = INF``, live or tombstone) are full
outer joined with the staged snapshot on the business key: one shuffle per
side, one classification per key, and one or two rows emitted per key.
Closed history never enters the join, so a run costs O(open + staged).

=============  ========  ==============  =========================================
class          open row  staged row      rows emitted
=============  ========  ==============  =========================================
NEW            none      yes             staged opened (start = create_dt / feed)
SAME           live      yes, equal      open row kept
CHANGED        live      yes, differs    open closed at eff - 1 s; staged from eff
DELETED        live      none            open closed at del - 1 s; tombstone from del
RETURNED       deleted   yes             tombstone closed at del - 1 s; staged from del
STILL_DELETED  deleted   none            open row kept
=============  ========  ==============  =========================================

``del`` is the run timestamp for snapshot dimensions and the feed date for
terminals.  ``eff`` is the staged ``update_dt`` (terminals: the feed date),
replaced by the run timestamp when missing, not after the open row's start,
or later than the run.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.expr import inf_ts, ntz_lit
from cardwatch.schemas import FLAG_DELETED, FLAG_LIVE, INF, DimSpec

NEW, SAME, CHANGED, DELETED, RETURNED, STILL_DELETED = (
    "NEW", "SAME", "CHANGED", "DELETED", "RETURNED", "STILL_DELETED")

# Step names: which part of the daily load produced an emitted row.
STEP_INSERT = "insert"                # H1: first version of a key (or its return)
STEP_CLOSE_CHANGED = "close_changed"  # U1: version superseded by staged data
STEP_VERSION = "version"              # V1: new version of a changed key
STEP_TOMBSTONE = "tombstone"          # D1: deletion marker
STEP_CLOSE_DELETED = "close_deleted"  # E1: live version of a deleted key closed
STEP_KEEP = "keep"                    # open row carried over unchanged
STEPS = (STEP_INSERT, STEP_CLOSE_CHANGED, STEP_VERSION, STEP_TOMBSTONE, STEP_CLOSE_DELETED)


@dataclass(frozen=True)
class Clock:
    """Timestamps of one run.  ``feed_dt`` is required for feed-clocked
    dimensions (terminals)."""

    run_ts: dt.datetime
    feed_dt: dt.date | None = None

    def deletion(self, spec: DimSpec) -> Column:
        if spec.feed_clock:
            if self.feed_dt is None:
                raise ValueError(f"{spec.name}: a feed date is required")
            return ntz_lit(self.feed_dt)
        return ntz_lit(self.run_ts)


def open_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("end_dt") == inf_ts())


def _keyed(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Rows with a non-NULL key, each with the number of rows sharing it.

    The window shuffles and sorts by key exactly as the join needs, so the
    duplicate check adds no exchange of its own."""
    w = Window.partitionBy(key)
    cols = [F.col(c).alias(prefix + c) for c in df.columns if c != key]
    return (df.where(F.col(key).isNotNull())
            .select(key, *cols, F.count(F.lit(1)).over(w).alias(prefix + "_n")))


def _ts(v: dt.datetime | dt.date) -> str:
    """SQL literal of a timestamp without zone (a date means its midnight)."""
    if not isinstance(v, dt.datetime):
        v = dt.datetime(v.year, v.month, v.day)
    return f"TIMESTAMP_NTZ'{v:%Y-%m-%d %H:%M:%S}'"


def _fail(spec: DimSpec, text: str) -> str:
    return f"raise_error(concat('{spec.name}: {text} ', cast({spec.key} AS STRING)))"


def classify(history_open: DataFrame, staged: DataFrame, spec: DimSpec, clock: Clock,
             deletions: bool = True) -> DataFrame:
    """One row per key: class, effective timestamps, open (``o_*``) and staged (``s_*``) values.

    ``deletions=False``: the staged side is known to lack rows, so a key that
    it doesn't have stays as it is (class SAME) instead of being tombstoned.
    The expressions are plain SQL text, so each is handed to the JVM in one
    call rather than assembled node by node."""
    k = spec.key
    o = _keyed(history_open.select(*spec.dim_columns), k, "o_")
    stg_cols = [k, *spec.attrs] + ([] if spec.feed_clock else ["create_dt", "update_dt"])
    s = _keyed(staged.select(*stg_cols), k, "s_")
    j = o.join(s, on=k, how="full_outer")

    run = _ts(clock.run_ts)
    if spec.feed_clock:
        if clock.feed_dt is None:
            raise ValueError(f"{spec.name}: a feed date is required")
        dl = _ts(clock.feed_dt)
        eff_raw, start_new = dl, dl
    else:
        dl = run
        eff_raw = "s_update_dt"
        start_new = (f"CASE WHEN s_create_dt IS NULL OR s_create_dt > {run} THEN {run} "
                     f"ELSE s_create_dt END")
    differs = " OR ".join(f"NOT (o_{a} <=> s_{a})" for a in spec.attrs)
    cls = f"""CASE
        WHEN coalesce(o__n, 1) + coalesce(s__n, 1) > 2
             THEN {_fail(spec, 'key is not unique in staging or open history:')}
        WHEN o__n IS NULL THEN '{NEW}'
        WHEN s__n IS NULL AND o_deleted_flg = '{FLAG_LIVE}' THEN '{DELETED if deletions else SAME}'
        WHEN s__n IS NULL THEN '{STILL_DELETED}'
        WHEN o_deleted_flg <> '{FLAG_LIVE}' THEN '{RETURNED}'
        WHEN {differs} THEN '{CHANGED}'
        ELSE '{SAME}' END"""
    eff = (f"CASE WHEN {eff_raw} IS NULL OR {eff_raw} <= o_start_dt OR {eff_raw} > {run} "
           f"THEN {run} ELSE {eff_raw} END")
    return j.selectExpr("*", f"{cls} AS class", f"{eff} AS eff", f"{start_new} AS start_new",
                        f"{dl} AS del_ts")


def _row(spec: DimSpec, src: str, start: str, end: str, flag: str, processed: str,
         step: str, state: str) -> str:
    fields = [(spec.key, spec.key)] + [(a, src + a) for a in spec.attrs]
    fields += [("start_dt", start), ("end_dt", end), ("deleted_flg", flag)]
    if spec.has_processed_dt:
        fields.append(("processed_dt", processed))
    fields += [("step", step), ("state", f"'{state}'")]
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields) + ")"


def merge(history_open: DataFrame, staged: DataFrame, spec: DimSpec, clock: Clock,
          deletions: bool = True) -> DataFrame:
    """Next open set plus the rows this run closes, each tagged with ``step``
    and ``state`` ('open' / 'closed').  Older closed history is untouched and
    not part of the result."""
    c = classify(history_open, staged, spec, clock, deletions)
    run, inf = _ts(clock.run_ts), _ts(INF)
    close_at = f"(CASE WHEN class = '{CHANGED}' THEN eff ELSE del_ts END - INTERVAL 1 SECOND)"
    close_checked = (f"CASE WHEN {close_at} < o_start_dt "
                     f"THEN {_fail(spec, 'run clock is not after the open version of key')} "
                     f"ELSE {close_at} END")
    closed = _row(spec, "o_", "o_start_dt", close_checked, "o_deleted_flg", run,
                  f"CASE WHEN class = '{DELETED}' THEN '{STEP_CLOSE_DELETED}' "
                  f"ELSE '{STEP_CLOSE_CHANGED}' END", "closed")
    opened = _row(spec, "s_",
                  f"CASE WHEN class = '{NEW}' THEN start_new WHEN class = '{CHANGED}' THEN eff "
                  f"ELSE del_ts END", inf, f"'{FLAG_LIVE}'", run,
                  f"CASE WHEN class = '{CHANGED}' THEN '{STEP_VERSION}' ELSE '{STEP_INSERT}' END",
                  "open")
    tombstone = _row(spec, "o_", "del_ts", inf, f"'{FLAG_DELETED}'", run,
                     f"'{STEP_TOMBSTONE}'", "open")
    kept = _row(spec, "o_", "o_start_dt", "o_end_dt", "o_deleted_flg", "o_processed_dt",
                f"'{STEP_KEEP}'", "open")
    first = f"CASE WHEN class IN ('{CHANGED}', '{DELETED}', '{RETURNED}') THEN {closed} END"
    second = (f"CASE WHEN class IN ('{NEW}', '{CHANGED}', '{RETURNED}') THEN {opened} "
              f"WHEN class = '{DELETED}' THEN {tombstone} ELSE {kept} END")
    out = c.selectExpr(f"inline(filter(array({first}, {second}), x -> x IS NOT NULL))")
    return out.select(*spec.dim_columns, "step", "state")


def step_rows(merged: DataFrame, spec: DimSpec, step: str) -> DataFrame:
    return merged.where(F.col("step") == step).select(*spec.dim_columns)


def next_state(history: DataFrame, staged: DataFrame, spec: DimSpec, clock: Clock) -> DataFrame:
    """The whole history after the run: untouched closed rows plus the merge."""
    m = merge(open_rows(history), staged, spec, clock).select(*spec.dim_columns)
    closed_before = history.where(F.col("end_dt") != inf_ts()).select(*spec.dim_columns)
    return closed_before.unionByName(m)
