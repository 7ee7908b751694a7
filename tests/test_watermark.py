"""Watermarks (S7, K5, K6) including the literal overwrite of every row (B10)."""

import datetime as dt

from cardwatch.plans import watermark
from tests.helpers import d


def _maxima(spark, cards, accounts, clients):
    rows = [("cards", cards), ("accounts", accounts), ("clients", clients)]
    return spark.createDataFrame(rows, "source_name string, max_dt date")


def test_seed_and_read(spark):
    meta = watermark.seed(spark)
    assert {r.source_name for r in meta.collect()} == {
        "terminals", "cards", "accounts", "clients", "transactions", "blacklist"}
    assert watermark.read(meta, "transactions").collect()[0][0] == dt.date(1900, 1, 1)


def test_feeds_advance_only_their_own_row(spark):
    meta = watermark.advance_feeds(watermark.seed(spark), {"transactions": d("2021-03-01"),
                                                           "terminals": None})
    got = {r.source_name: r.max_update_dt for r in meta.collect()}
    assert got["transactions"] == d("2021-03-01") and got["terminals"] == d("1900-01-01")


def test_snapshots_intended_vs_literal(spark):
    meta = watermark.seed(spark)
    maxima = _maxima(spark, d("2021-03-02"), None, d("2021-03-04"))
    got = {r.source_name: r.max_update_dt
           for r in watermark.advance_snapshots(meta, maxima).collect()}
    assert (got["cards"], got["accounts"], got["clients"]) == \
        (d("2021-03-02"), d("1900-01-01"), d("2021-03-04"))
    assert got["transactions"] == d("1900-01-01")
    # literal: three unfiltered updates, each taking the value the previous one left
    lit = {r.source_name: r.max_update_dt
           for r in watermark.advance_snapshots(meta, maxima, "literal").collect()}
    assert set(lit.values()) == {d("2021-03-04")}
    lit2 = {r.source_name: r.max_update_dt for r in watermark.advance_snapshots(
        meta, _maxima(spark, d("2021-03-02"), None, None), "literal").collect()}
    assert set(lit2.values()) == {d("2021-03-02")}   # accounts/clients keep the cards value
