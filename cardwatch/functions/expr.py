"""Column expressions shared by the operators.  All stay JVM-side."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwatch.schemas import INF


def ntz(c: Column) -> Column:
    """Any date/timestamp column as timestamp without zone."""
    return c.cast("timestamp_ntz")


def ntz_lit(value: dt.datetime | dt.date | str) -> Column:
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return F.lit(value.isoformat()).cast("date").cast("timestamp_ntz")


def date_lit(value: dt.date | str) -> Column:
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value if isinstance(value, str) else value.isoformat()).cast("date")


def inf_ts() -> Column:
    return ntz_lit(INF)


def minus_one_second(c: Column) -> Column:
    """``ts - 1 second`` kept as timestamp_ntz (a date is first cast to NTZ)."""
    return ntz(c) - F.expr("INTERVAL 1 SECOND")


def null_safe_differs(pairs) -> Column:
    """True when any (a, b) pair differs, NULL counting as a value."""
    return reduce(lambda x, y: x | y, [~a.eqNullSafe(b) for a, b in pairs])


def fio(last: Column, first: Column, middle: Column) -> Column:
    """``last || ' ' || first || ' ' || middle``; NULL when any part is NULL."""
    return F.concat(last, F.lit(" "), first, F.lit(" "), middle)


def round_to_seconds(c: Column) -> Column:
    """Half-up rounding to whole seconds, as a ``timestamp(0)`` column stores
    it.  Zone-free: NTZ arithmetic plus ``make_timestamp_ntz`` from the
    fields (no detour through zoned timestamps)."""
    t = c + F.expr("INTERVAL '0.5' SECOND")
    return F.when(c.isNotNull(), F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t)))


def trimmed(c: Column) -> Column:
    """Blank-only trim on both sides (tabs stay)."""
    return F.trim(c)
