"""Staging transforms (T1-T6): raw feed text and snapshots -> typed staging rows.

Each ``stage_*`` returns a ``Staged``: one typed frame with a ``reason``
column (NULL for good rows).  It unpacks as ``(good, rejects)``; the daily
run writes ``tagged`` once, so the source is scanned once.  Keys are trimmed
here so that later joins are plain equi-joins.  Only rows that can't be used
have a reason (a missing key, a value that is no date or number); text of any
length is kept.  The daily run fails on such rows unless its caller opts in.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.expr import date_lit, round_to_seconds, trimmed
from cardwatch.schemas import (DIMS, STG_ACCOUNTS, STG_BLACKLIST, STG_CARDS,
                               STG_CLIENTS, STG_TERMINALS, STG_TRANSACTIONS)


class Staged(tuple):
    """``(good, rejects)`` plus ``tagged``: every row with its ``reason``."""

    def __new__(cls, tagged: DataFrame, columns: list[str]):
        good = tagged.where(F.col("reason").isNull()).select(*columns)
        bad = tagged.where(F.col("reason").isNotNull())
        obj = super().__new__(cls, (good, bad))
        obj.tagged, obj.columns = tagged, columns
        return obj


def _split(df: DataFrame, reason: Column, columns: list[str]) -> Staged:
    keep = [c for c in df.columns if c != "reason"]
    return Staged(df.select(*keep, reason.alias("reason")), columns)


def _first_reason(checks: list[tuple[Column, str]]) -> Column:
    expr = F.lit(None).cast("string")
    for cond, text in reversed(checks):
        expr = F.when(F.coalesce(cond, F.lit(False)), F.lit(text)).otherwise(expr)
    return expr


def decimal_comma(c: Column) -> Column:
    """T1: '10,50' -> 10.50 as decimal(10,2); NULL (a reject) when the text is
    not a number or does not fit, instead of failing the whole job."""
    return F.translate(c, ",", ".").try_cast("decimal(10,2)")


def stage_transactions(raw: DataFrame) -> Staged:
    """T1 + T2: rename, trim the card number, type every field."""
    typed = raw.select(
        F.col("transaction_id").alias("trans_id"),
        round_to_seconds(F.col("transaction_date").try_cast("timestamp_ntz")).alias("trans_date"),
        decimal_comma(F.col("amount")).alias("amt"),
        trimmed(F.col("card_num")).alias("card_num"),
        F.col("oper_type"), F.col("oper_result"), F.col("terminal"),
        F.col("transaction_date").alias("_raw_date"), F.col("amount").alias("_raw_amount"))
    reason = _first_reason([
        (F.col("trans_id").isNull(), "missing transaction id"),
        (F.col("trans_date").isNull() & F.col("_raw_date").isNotNull(), "bad transaction date"),
        (F.col("amt").isNull() & F.col("_raw_amount").isNotNull(), "bad amount"),
    ])
    return _split(typed, reason, [f.name for f in STG_TRANSACTIONS.fields])


def stage_terminals(raw: DataFrame, feed_dt: dt.date) -> Staged:
    """T3 + T4: trim the id, add ``update_dt`` = feed file date."""
    typed = raw.select(trimmed(F.col("terminal_id")).alias("terminal_id"), "terminal_type",
                       "terminal_city", "terminal_address",
                       date_lit(feed_dt).alias("update_dt"))
    reason = _first_reason([
        (F.col("terminal_id").isNull(), "missing terminal id"),
    ])
    return _split(typed, reason, [f.name for f in STG_TERMINALS.fields])


def stage_blacklist(raw: DataFrame) -> Staged:
    """T5: entry date as date, passport trimmed."""
    typed = raw.select(F.col("enty_dt").try_cast("date").alias("enty_dt"),
                       trimmed(F.col("passport_num")).alias("passport_num"),
                       F.col("enty_dt").alias("_raw_date"))
    reason = _first_reason([
        (F.col("passport_num").isNull(), "missing passport"),
        (F.col("enty_dt").isNull() & F.col("_raw_date").isNotNull(), "bad entry date"),
    ])
    return _split(typed, reason, [f.name for f in STG_BLACKLIST.fields])


_SNAPSHOT_SCHEMAS = {"cards": STG_CARDS, "accounts": STG_ACCOUNTS, "clients": STG_CLIENTS}


def stage_snapshot(name: str, snapshot: DataFrame) -> Staged:
    """S1-S3: select the snapshot's columns by name, cast, trim the key."""
    schema = _SNAPSHOT_SCHEMAS[name]
    key = DIMS[name].key
    def typed_col(f):
        c = (trimmed(F.col(f.name)) if f.name == key else F.col(f.name)).cast(f.dataType)
        return (round_to_seconds(c) if f.dataType.typeName() == "timestamp_ntz" else c).alias(f.name)

    cols = [typed_col(f) for f in schema.fields]
    typed = snapshot.select(*cols)
    return _split(typed, _first_reason([(F.col(key).isNull(), "missing key")]),
                  [f.name for f in schema.fields])


class DuplicateKey(ValueError):
    pass


def assert_unique_keys(staged: DataFrame, name: str) -> None:
    """Fail on a key that occurs twice (B17).  ``count`` per key aggregates
    partially on the map side, so even a key repeated in a third of all rows
    is reduced before the shuffle and never gathered into one task; only one
    offending key travels to the driver."""
    key = DIMS[name].key
    dup = (staged.where(F.col(key).isNotNull()).groupBy(key).count()
           .where(F.col("count") > 1).limit(1).collect())
    if dup:
        raise DuplicateKey(f"{name}: key {dup[0][0]!r} occurs {dup[0][1]} times in staging")


def key_snapshot(staged: DataFrame, name: str) -> DataFrame:
    """T6: the keys seen in this run's staging."""
    return staged.select(DIMS[name].key)
