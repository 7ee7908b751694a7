"""Literal SCD2 mode: the original statement sequence, replayed over the whole
history (SURVEY 2.9 B2-B5, B18).

This exists to reproduce earlier output for comparison, not for production:
it reads and rewrites all history (O(history) per run), keeps the original
defects (overlapping versions, duplicate open rows, keys that never return),
and is only offered where the result is deterministic.  The cards close step
updates every row from one changed row of its choosing; it is replayed only
when all changed rows carry the same ``update_dt`` and fails otherwise.

Statement order per run: insert new keys, close changed versions, insert
changed versions, insert tombstones, close deleted versions.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.expr import inf_ts, minus_one_second, ntz_lit, null_safe_differs
from cardwatch.operators.scd2 import Clock
from cardwatch.schemas import FLAG_DELETED, FLAG_LIVE, DimSpec


def _is_open_live(h: DataFrame) -> Column:
    return (h.end_dt == inf_ts()) & (h.deleted_flg == FLAG_LIVE)


def _differs(spec: DimSpec, left: str, right: str, attrs=None) -> Column:
    attrs = spec.attrs if attrs is None else attrs
    return null_safe_differs([(F.col(f"{left}.{a}"), F.col(f"{right}.{a}")) for a in attrs])


def _row_from(spec: DimSpec, src: str, start: Column, flag: str, processed: Column | None,
              key_src: str | None = None) -> list[Column]:
    cols = [F.col(f"{key_src or src}.{spec.key}").alias(spec.key)]
    cols += [F.col(f"{src}.{a}").alias(a) for a in spec.attrs]
    cols += [start.alias("start_dt"), inf_ts().alias("end_dt"), F.lit(flag).alias("deleted_flg")]
    if spec.has_processed_dt:
        cols.append(processed.alias("processed_dt"))
    return cols


def _set_end(h: DataFrame, spec: DimSpec, hit: Column, end: Column,
             processed: Column | None = None) -> DataFrame:
    cols = []
    for c in spec.dim_columns:
        if c == "end_dt":
            cols.append(F.when(hit, end).otherwise(F.col("end_dt")).alias("end_dt"))
        elif c == "processed_dt" and processed is not None:
            cols.append(F.when(hit, processed).otherwise(F.col("processed_dt")).alias(c))
        else:
            cols.append(F.col(c))
    return h.select(*cols)


def _mark(h: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``h`` with ``_hit`` = some row of ``keys`` equals it on ``on`` (plain =)."""
    k = keys.select(*on).where(F.col(on[0]).isNotNull()).distinct().withColumn("_hit", F.lit(True))
    return h.join(k, on, "left").withColumn("_hit", F.coalesce(F.col("_hit"), F.lit(False)))


def step(history: DataFrame, staged: DataFrame, spec: DimSpec, clock: Clock) -> DataFrame:
    """One literal run: the whole history afterwards."""
    name, k = spec.name, spec.key
    now = ntz_lit(clock.run_ts)
    cols = spec.dim_columns
    h = history.select(*cols)
    s = staged.alias("s")

    # ---- H1: insert keys without a matching version
    if name == "terminals":
        fd = ntz_lit(clock.feed_dt)
        ins = (s.join(h.select(k).alias("d"), F.col(f"s.{k}") == F.col(f"d.{k}"), "left_anti")
               .select(*_row_from(spec, "s", fd, FLAG_LIVE, now)).distinct())
    else:
        match = h.where(_is_open_live(h)) if name in ("cards", "clients") \
            else h.where(h.deleted_flg == FLAG_LIVE)
        ins = (s.join(match.select(k).alias("d"), F.col(f"s.{k}") == F.col(f"d.{k}"), "left_anti")
               .select(*_row_from(spec, "s", F.col("s.create_dt"), FLAG_LIVE, None)))
    h = h.unionByName(ins.select(*cols))

    # ---- U1: close changed versions
    if name == "cards":
        o = h.where(_is_open_live(h)).alias("d")
        tmp = (s.join(o, F.col(f"s.{k}") == F.col(f"d.{k}"), "left")
               .where(_differs(spec, "s", "d")).select(F.col("s.update_dt").alias("u")))
        agg = tmp.agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("lo"), F.max("u").alias("hi"),
                      F.count("u").alias("nn"))
        n, lo, hi, nn = (agg.select(c).scalar() for c in ("n", "lo", "hi", "nn"))
        ambiguous = (nn != n) & (nn > 0) | (lo != hi)
        end = F.when(ambiguous, F.raise_error(F.lit(
            "cards: changed rows disagree on update_dt; the literal close is not deterministic")
        ).cast("timestamp_ntz")).otherwise(minus_one_second(hi))
        h = _set_end(h, spec, n > 0, end)
    elif name in ("accounts", "clients"):
        o = h.where(_is_open_live(h)).alias("d")
        tmp = (s.join(o, F.col(f"s.{k}") == F.col(f"d.{k}"), "inner")
               .where(_differs(spec, "s", "d"))
               .groupBy(F.col(f"s.{k}").alias(k)).agg(F.max("s.update_dt").alias("_u")))
        h = h.join(tmp.withColumn("_hit", F.lit(True)), k, "left")
        h = _set_end(h, spec, F.col("_hit").isNotNull(), minus_one_second(F.col("_u")))
    else:
        fd = ntz_lit(clock.feed_dt)
        o = h.where(_is_open_live(h)).alias("d")
        on = [F.col(f"s.{a}") == F.col(f"d.{a}") for a in spec.attrs]
        tmp = (s.join(o, on[0] & on[1] & on[2], "left")
               .where(_differs(spec, "s", "d", (k, *spec.attrs)))
               .select(F.col(f"s.{k}").alias(k), F.col("s.terminal_type").alias("terminal_type"),
                       F.col("s.terminal_city").alias("terminal_city")))
        h = _mark(h, tmp, [k, "terminal_type", "terminal_city"])
        h = _set_end(h, spec, F.col("_hit"), minus_one_second(fd), now)

    # ---- V1: insert changed versions (compared with every live version;
    # terminals: with every version)
    if name == "terminals":
        fd = ntz_lit(clock.feed_dt)
        ins = (s.join(h.alias("d"), F.col(f"s.{k}") == F.col(f"d.{k}"), "inner")
               .where(_differs(spec, "s", "d"))
               .select(*_row_from(spec, "s", fd, FLAG_LIVE, now, key_src="d")).distinct())
    else:
        live = h.where(h.deleted_flg == FLAG_LIVE).alias("d")
        ins = (s.join(live, F.col(f"s.{k}") == F.col(f"d.{k}"), "left")
               .where(_differs(spec, "s", "d"))
               .select(*_row_from(spec, "s", F.col("s.update_dt"), FLAG_LIVE, None)).distinct())
    h = h.unionByName(ins.select(*cols))

    # ---- D1 + E1: tombstone and close open live versions of vanished keys
    gone = (h.where(_is_open_live(h)).select(k)
            .join(staged.select(k), k, "left_anti").distinct())
    when_del = ntz_lit(clock.feed_dt) if name == "terminals" else now
    opened = h.where(_is_open_live(h)).join(gone, k, "left_semi")
    tomb = opened.select(*[F.col(c) for c in (k, *spec.attrs)], when_del.alias("start_dt"),
                         inf_ts().alias("end_dt"), F.lit(FLAG_DELETED).alias("deleted_flg"),
                         *([now.alias("processed_dt")] if spec.has_processed_dt else []))
    if name == "terminals":
        tomb = tomb.distinct()
    h = _mark(h, gone, [k])
    h = _set_end(h, spec, F.col("_hit") & _is_open_live(h), minus_one_second(when_del),
                 now if spec.has_processed_dt else None)
    return h.unionByName(tomb.select(*cols))
