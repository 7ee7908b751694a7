"""The next, or the previous, row of each group in a total order, exact under any skew.

``with_previous_within_hour`` serves the one-hour rule.  ``with_next`` is for the
literal report and the hop base, whose successor may lie any time ahead.

``Window.partitionBy(group)`` sends a whole group to one task, so a card that
holds a third of all transactions would be one task.  Here the order is cut into
spans (hours of the transaction time), and the window runs over (group, span), which
splits a hot group by hour.  The last row of a span takes the first row of the group's
next span that has any: that second window sees one row per group and span, at most the
hours that the data covers, reduced on the map side.

Nothing is run while the DataFrame is built, and nothing is checkpointed.  The ordering
key should be unique for a deterministic successor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _span(df: DataFrame, name: str) -> Column:
    """A coarse value that never falls while ``name`` rises."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("hour", name)
    if isinstance(kind, T.DateType):
        return F.trunc(name, "month")
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(name) / 4096)
    raise TypeError(f"{name}: order by a time or a number first, not by {kind.simpleString()}")


def with_next(df: DataFrame, group: str, order: list[str], carry: list[str], prefix: str = "lead_") -> DataFrame:
    """``df`` plus ``prefix + c`` for each ``c`` in ``carry``: the value in the
    next row of the same ``group`` (NULL is a group like any other) by ``order``, whose
    first column is a time or a number; NULL for the group's last row."""
    fields = F.struct(*dict.fromkeys([*order, *carry]))
    # a NULL group gets a value that no other has, so that the join is a plain one on the
    # window's own keys and the rows are shuffled once
    rows = df.withColumns({"_g": F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")),
                           "_s": _span(df, order[0])})
    rows = rows.withColumn("_s", F.coalesce(F.col("_s").cast("string"), F.lit("")))
    first = rows.groupBy("_g", "_s").agg(F.min_by(fields, F.struct(*order)).alias("_first"))
    after = first.select("_g", "_s", F.lead("_first").over(
        Window.partitionBy("_g").orderBy(*[F.col("_first")[c] for c in order])).alias("_after"))
    here = rows.withColumn("_next", F.lead(fields).over(Window.partitionBy("_g", "_s").orderBy(*order)))
    found = F.coalesce("_next", "_after")
    return here.join(after, ["_g", "_s"], "left").select(*df.columns, *[found[c].alias(prefix + c) for c in carry])


def with_previous_within_hour(df: DataFrame, group: str, time: str, order: str, carry: list[str],
                              prefix: str = "prev_") -> DataFrame:
    """``df`` plus ``prefix + c`` for each ``c`` in ``carry``: the value in the row just before
    on the same ``group`` (NULL is a group) by ``time``, then ``order``, if it lies in the same
    or in the preceding clock hour; NULL otherwise.

    The window runs over (group, hour), so a hot group is split by hour; an hour's
    first row takes the last row of the hour before through an equi-join with one row
    per (group, hour).  One shuffle of the rows, one of those last rows."""
    fields = list(dict.fromkeys([time, order, *carry]))
    rows = df.withColumn("_hour", F.date_trunc("hour", time).cast("timestamp_ntz"))
    w = Window.partitionBy(group, "_hour").orderBy(time, order)
    here = rows.withColumn("_before", F.lag(F.struct(*fields)).over(w))
    last = rows.groupBy(group, "_hour").agg(
        F.max_by(F.struct(*fields), F.struct(time, order)).alias("_last"))
    last = last.select(F.col(group).alias("_g"), (F.col("_hour") + F.expr("INTERVAL 1 HOUR")).alias("_h"), "_last")
    j = here.join(last, here[group].eqNullSafe(last["_g"]) & (here["_hour"] == last["_h"]), "left")
    before = F.coalesce("_before", "_last")
    return j.select(*df.columns, *[before[c].alias(prefix + c) for c in carry])
