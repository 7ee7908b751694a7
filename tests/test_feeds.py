"""FIXTURES section 4: feed selection and feed parsing edge cases."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import staging
from cardwatch.sources import feeds
from tests.helpers import d, rows


def _names(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def _pick(spark, names, after, mode="intended"):
    wm = spark.createDataFrame([("transactions", d(after))], "source_name string, max_update_dt date")
    return feeds.pick_feeds(names, wm, {"transactions": "transactions_"}, mode)


def test_file_order_intended_vs_literal(spark):
    n = _names(spark, "transactions_01032021.txt", "transactions_28022021.txt", "terminals_01012021.xlsx")
    assert rows(_pick(spark, n, "1900-01-01"), "name") == [("transactions_28022021.txt",)]
    assert rows(_pick(spark, n, "1900-01-01", "literal"), "name") == [("transactions_01032021.txt",)]


def test_no_newer_file_gives_no_pick(spark):
    assert _pick(spark, _names(spark, "transactions_01032021.txt"), "2021-03-01").count() == 0


def test_a_name_with_an_unreadable_date_fails(spark):
    with pytest.raises(Exception, match="unreadable date"):
        _pick(spark, _names(spark, "transactions_01032021.txt", "transactions_bad.txt"), "2021-03-01").collect()


def test_listing_reads_names_only(spark, tmp_path):
    for name in ("transactions_01032021.txt", "terminals_02032021.csv"):
        (tmp_path / name).write_text("x\n")
    got = feeds.list_entries(spark, str(tmp_path))
    assert rows(got) == [("terminals_02032021.csv",), ("transactions_01032021.txt",)]


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def test_transactions_text_parsing(spark, tmp_path):
    path = _write(tmp_path, "transactions_01032021.txt", HEADER
                  + "00042;2021-03-01 10:00:00;10,50;C1 ;PAY;SUCCESS;T1\n"
                  + "7;2021-03-01 11:00:00;3,00;C2;PAY;SUCCESS;\n"
                  + "8;2021-03-01 12:00:00;1,00;C3;PAY;SUCCESS;T12345\n")
    good, bad = staging.stage_transactions(feeds.read_transactions(spark, path))
    g = {r.trans_id: r for r in good.collect()}
    assert set(g) == {"00042", "7", "8"}                  # leading zeros kept as text
    assert g["8"].terminal == "T12345"                      # longer than its old column: kept
    assert str(g["00042"].amt) == "10.50"                   # decimal comma
    assert g["00042"].card_num == "C1"                      # trimmed once in staging
    assert g["7"].terminal is None                          # empty cell is NULL, not 'NaN'
    assert g["00042"].trans_date == dt.datetime(2021, 3, 1, 10, 0)
    assert bad.count() == 0


def test_columns_are_selected_by_header_name(spark, tmp_path):
    swapped = HEADER.replace("amount;card_num", "card_num;extra;amount")
    path = _write(tmp_path, "transactions_02032021.txt", swapped + "1;2021-03-01 10:00:00;C1;x;1,00;P;S;T\n")
    got = feeds.read_transactions(spark, path).collect()[0]
    assert (got.card_num, got.amount, got.terminal) == ("C1", "1,00", "T")
    t = _write(tmp_path, "terminals_02032021.csv", "terminal_city;terminal_id;terminal_address;terminal_type\nX;T1;a;POS\n")
    assert rows(feeds.read_terminals(spark, t)) == [("T1", "POS", "X", "a")]
    short = _write(tmp_path, "transactions_03032021.txt", HEADER.replace(";amount", ""))
    with pytest.raises(ValueError, match="no column amount"):
        feeds.read_transactions(spark, short)


def test_rows_of_another_width_fail(spark, tmp_path):
    for name, row in (("a", "2021-02-01;P1;junk"), ("b", "2021-02-01")):
        path = _write(tmp_path, f"passport_blacklist_{name}.csv", f"date;passport\n{row}\n")
        with pytest.raises(Exception):
            feeds.read_blacklist(spark, path).collect()


def test_terminals_and_blacklist_feeds(spark, tmp_path):
    t = _write(tmp_path, "terminals_01032021.csv",
               "terminal_id;terminal_type;terminal_city;terminal_address\nT1;POS;;addr\n")
    good, _ = staging.stage_terminals(feeds.read_terminals(spark, t), d("2021-03-01"))
    assert rows(good) == [("T1", "POS", None, "addr", d("2021-03-01"))]
    b = _write(tmp_path, "passport_blacklist_01032021.csv", "date;passport\n2021-02-01;0012 345\n")
    good, _ = staging.stage_blacklist(feeds.read_blacklist(spark, b))
    assert rows(good) == [(d("2021-02-01"), "0012 345")]


def test_parquet_blacklist_is_positional(spark, tmp_path):
    p = str(tmp_path / "passport_blacklist_01032021.parquet")
    spark.createDataFrame([("2021-02-01", "PP1")], "entry string, pass string").write.parquet(p)
    assert rows(feeds.read_blacklist(spark, p)) == [("2021-02-01", "PP1")]
    assert os.path.isdir(p)
    assert F  # noqa


def test_malformed_values_are_rejected_not_fatal(spark, tmp_path):
    path = _write(tmp_path, "transactions_03032021.txt", HEADER
                  + "1;not a date;1,00;C1;PAY;SUCCESS;T1\n"
                  + "2;2021-03-01 10:00:00;12,3,4;C1;PAY;SUCCESS;T1\n"
                  + "3;2021-03-01 10:00:00;123456789,00;C1;PAY;SUCCESS;T1\n"
                  + "4;2021-03-01 10:00:00;1,00;C1;PAY;SUCCESS;T1\n")
    good, bad = staging.stage_transactions(feeds.read_transactions(spark, path))
    assert rows(good, "trans_id") == [("4",)]
    assert rows(bad, "trans_id", "reason") == [("1", "bad transaction date"), ("2", "bad amount"),
                                               ("3", "bad amount")]


def test_jdbc_snapshot_options_split_on_a_date_column():
    from cardwatch.sources.snapshots import jdbc_options
    o = jdbc_options("jdbc:postgresql://db/x", "src.cards", {"user": "u"}, partition_column="create_dt",
                     lower_bound="2000-01-01", upper_bound="2030-01-01", num_partitions=64)
    assert o["partitionColumn"] == "create_dt" and o["numPartitions"] == "64" and o["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="create_dt")


def test_snapshot_binds_by_name(spark):
    from cardwatch.sources.snapshots import select_snapshot
    df = spark.createDataFrame([("2021-01-01 00:00:00", "A1", "C1", None)],
                               "create_dt string, account_num string, card_num string, update_dt string")
    r = select_snapshot(df, "cards").collect()[0]
    assert (r.card_num, r.account_num) == ("C1", "A1")
    assert r.create_dt == dt.datetime(2021, 1, 1)


def test_timestamps_round_half_up_to_whole_seconds(spark, tmp_path):
    path = _write(tmp_path, "transactions_04032021.txt", HEADER
                  + "1;2021-03-01 10:00:00.499999;1,00;C1;PAY;SUCCESS;T1\n"
                  + "2;2021-03-01 10:00:00.5;1,00;C1;PAY;SUCCESS;T1\n"
                  + "3;2021-12-31 23:59:59.7;1,00;C1;PAY;SUCCESS;T1\n")
    good, _ = staging.stage_transactions(feeds.read_transactions(spark, path))
    assert rows(good, "trans_id", "trans_date") == [
        ("1", dt.datetime(2021, 3, 1, 10, 0, 0)), ("2", dt.datetime(2021, 3, 1, 10, 0, 1)),
        ("3", dt.datetime(2022, 1, 1, 0, 0, 0))]


def test_spark_written_feed_folder_is_one_entry(spark, tmp_path):
    root = tmp_path / "feeds"
    df = spark.range(20).selectExpr("CAST(id AS STRING) AS transaction_id").repartition(3)
    feeds.write_text_feed(df, str(root / "transactions_05032021.txt"))
    (root / "terminals_05032021.csv").write_text("x\n")
    got = rows(feeds.list_entries(spark, str(root)))
    assert got == [("terminals_05032021.csv",), ("transactions_05032021.txt",)]
    picked = _pick(spark, feeds.list_entries(spark, str(root)), "2021-03-01")
    assert rows(picked, "name", "file_dt") == [("transactions_05032021.txt", d("2021-03-05"))]


def test_entries_are_a_data_source_that_reads_no_content(spark, tmp_path):
    spark.dataSource.register(feeds.FeedEntries)
    for name in ("transactions_01032021.txt", "notes.md", "terminals_31022021.csv", "_SUCCESS", ".hidden_01032021"):
        (tmp_path / name).write_text("x\n")
    part = tmp_path / "passport_blacklist_02032021.csv"
    part.mkdir()
    (part / "part-0").write_text("x\n")
    os.chmod(part / "part-0", 0)
    got = spark.read.format("feed_entries").load(str(tmp_path))
    assert rows(got, "name", "file_dt", "folder") == [
        ("notes.md", None, False), ("passport_blacklist_02032021.csv", d("2021-03-02"), True),
        ("terminals_31022021.csv", None, False), ("transactions_01032021.txt", d("2021-03-01"), False)]
    assert rows(spark.read.format("feed_entries").load(f"file://{tmp_path}"), "name") == rows(got, "name")
    assert all(r.modified is not None for r in got.collect())


def test_entries_written_in_one_job(spark, tmp_path):
    lines = spark.createDataFrame([("a_01032021.txt", "x;y"), ("a_01032021.txt", "1;2"), ("b_02032021.csv", "z")], "name string, value string")
    feeds.write_text_entries(lines, str(tmp_path))
    assert rows(feeds.list_entries(spark, str(tmp_path))) == [("a_01032021.txt",), ("b_02032021.csv",)]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "a_01032021.txt")).collect()) == ["1;2", "x;y"]


def test_vacuum_keeps_staged_copies_that_later_runs_share(spark, tmp_path):
    from cardwatch.sinks import warehouse
    root = str(tmp_path)
    df = spark.createDataFrame([("C1",)], "card_num string")
    for run, cards in (("r1", "r1"), ("r2", "r2"), ("r3", "r2"), ("r4", "r2"), ("r5", "r2")):
        if cards == run:
            warehouse.write_staging(df, root, "cards", run)
        warehouse.commit(spark, root, run, dt.datetime(2024, 1, 1), dim_runs={"cards": cards})
    warehouse.vacuum(spark, root)
    assert not os.path.exists(f"{root}/stg_cards/run=r1") and os.path.exists(f"{root}/stg_cards/run=r2")
    assert warehouse.current_staging(spark, root, "cards").count() == 1
