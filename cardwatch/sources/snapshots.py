"""Full source snapshots (S1-S3) of cards, accounts and clients.

Any DataFrame with the snapshot's columns will do (the staging step selects
them by name).  For a database source, ``read_jdbc`` opens ``num_partitions``
parallel range queries split on a numeric, date or timestamp column, e.g.
``create_dt`` (the keys are text and cannot be split on), instead of one
connection pulling the whole table.  Equal widths give unequal queries where the values are
uneven; ``depth_bounds`` takes bounds of equal depth from a quantile sketch of an earlier copy
(yesterday's staging, say), and ``read_jdbc_ranges`` opens one query for each range.  Connection options always come from the
caller; nothing is stored.  No JDBC driver ships with this repository.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.schemas import STG_ACCOUNTS, STG_CARDS, STG_CLIENTS

SCHEMAS = {"cards": STG_CARDS, "accounts": STG_ACCOUNTS, "clients": STG_CLIENTS}


def jdbc_options(url: str, table: str, options: dict[str, str] | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update({k: str(v) for k, v in (options or {}).items()})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, name: str, url: str, table: str,
              options: dict[str, str] | None = None, **split) -> DataFrame:
    """S1-S3: one snapshot, columns selected by name and typed."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, options, **split)).load()
    return select_snapshot(df, name)


def depth_bounds(df: DataFrame, column: str, ranges: int) -> list:
    """At most ``ranges`` - 1 ascending bounds that cut the values of ``column`` into ranges of about equal
    numbers of rows.  The sketch is combined from the tasks' sketches; the bounds alone reach the driver."""
    cuts = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    found = df.select(F.percentile_approx(column, cuts, F.lit(max(10_000, 100 * ranges)))).collect()[0][0]  # ranges - 1 values
    return sorted(set(found or []))


def _literal(value) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return str(value)


def range_predicates(column: str, bounds: list) -> list[str]:
    """SQL predicates of the ranges that ``bounds`` cut; each value is in one, NULL in the first."""
    if not bounds:
        return ["1 = 1"]
    cut = [_literal(b) for b in bounds]
    middle = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(cut, cut[1:])]
    return [f"({column} <= {cut[0]} OR {column} IS NULL)", *middle, f"{column} > {cut[-1]}"]


def range_of(column: str, bounds: list) -> Column:
    """The number, from 0, of the range that a row is in."""
    out = F.lit(len(bounds))
    for i, predicate in reversed(list(enumerate(range_predicates(column, bounds)[:-1]))):
        out = F.when(F.expr(predicate.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")), i).otherwise(out)
    return out


def read_jdbc_ranges(spark: SparkSession, name: str, url: str, table: str, column: str, bounds: list,
                     options: dict[str, str] | None = None) -> DataFrame:
    """S1-S3: one snapshot by one query for each range of ``column``."""
    df = spark.read.jdbc(url, table, predicates=range_predicates(column, bounds), properties=options or {})
    return select_snapshot(df, name)


def select_snapshot(df: DataFrame, name: str) -> DataFrame:
    """Bind by name (never by position) and cast to the staging types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])
