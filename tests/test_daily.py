"""End-to-end daily runs through the warehouse layout."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardwatch.plans import daily
from cardwatch.schemas import STG_ACCOUNTS, STG_CARDS, STG_CLIENTS
from cardwatch.sinks import warehouse
from tests.helpers import d, rows, ts

C0 = ts("2021-01-01 00:00:00")
INF = ts("9999-12-31 00:00:00")
HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
TERM_HEADER = "terminal_id;terminal_type;terminal_city;terminal_address\n"


def _snapshots(spark, day):
    cards = [("C1", "A1", C0, None), ("C2", "A2", C0, None)]
    if day == 2:
        cards = [("C1", "A1", C0, None)]            # C2 deleted on day 2
    accounts = [("A1", d("2021-12-31"), "1", C0, None), ("A2", d("2021-02-28"), "2", C0, None)]
    clients = [("1", "Ivanov", "Ivan", "I", d("1980-01-01"), "P1", d("2030-01-01"), "+1", C0, None),
               ("2", "Petrov", "Petr", None, d("1980-01-01"), "P2", d("2021-03-01"), "+2", C0, None)]
    return {"cards": spark.createDataFrame(cards, STG_CARDS),
            "accounts": spark.createDataFrame(accounts, STG_ACCOUNTS),
            "clients": spark.createDataFrame(clients, STG_CLIENTS)}


@pytest.fixture(scope="module")
def feeds_dir(tmp_path_factory):
    f = tmp_path_factory.mktemp("feeds")
    (f / "transactions_01032021.txt").write_text(
        HEADER
        + "1;2021-03-01 10:00:00;10,50;C1 ;PAY;SUCCESS;T1\n"
        + "2;2021-03-01 10:30:00;5,00;C1;PAY;SUCCESS;T2\n"
        + "3;2021-03-01 12:00:00;1,00;C2;PAY;SUCCESS;T1\n"
        + "4;2021-03-01 12:59:59;1,00;C2;PAY;SUCCESS;T2\n"
        + "5;2021-03-01 13:00:00;1,00;C2;PAY;REJECT;T1\n")
    (f / "transactions_02032021.txt").write_text(HEADER + "6;2021-03-02 09:00:00;1,00;C1;PAY;SUCCESS;T1\n")
    (f / "passport_blacklist_01032021.csv").write_text("date;passport\n2021-02-15;P1\n")
    (f / "terminals_01032021.csv").write_text(TERM_HEADER + "T1;POS;X;a1\nT2;ATM;Y;a2\n")
    # no terminals file on day 2: the dimension must stay as it is
    return str(f)


def test_three_daily_runs(spark, tmp_path, feeds_dir):
    root = str(tmp_path / "wh")
    r1 = daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds_dir), root, ts("2021-03-01 06:00:00"))
    assert set(r1.picked) == {"transactions", "blacklist", "terminals"} and r1.reported
    mart = warehouse.current_reports(spark, root)
    f1, f2 = "Ivanov Ivan I", None
    assert rows(mart, "event_type", "event_dt", "passport", "fio") == sorted([
        ("1", ts("2021-03-01 10:00:00"), "P1", f1), ("1", ts("2021-03-01 10:30:00"), "P1", f1),
        ("1", ts("2021-03-01 12:00:00"), "P2", f2), ("1", ts("2021-03-01 12:59:59"), "P2", f2),
        ("2", ts("2021-03-01 12:00:00"), "P2", f2), ("2", ts("2021-03-01 12:59:59"), "P2", f2),
        # P2 hops twice (12:00 X->Y, then 12:59:59 Y->X to a rejected one): latest earlier side
        ("3", ts("2021-03-01 10:00:00"), "P1", f1), ("3", ts("2021-03-01 12:59:59"), "P2", f2),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert {r.report_dt for r in mart.collect()} == {d("2021-03-01")}

    r2 = daily.run(spark, daily.Sources(_snapshots(spark, 2), feeds_dir), root, ts("2021-03-02 06:00:00"))
    assert set(r2.picked) == {"transactions"}
    r3 = daily.run(spark, daily.Sources(_snapshots(spark, 2), feeds_dir), root, ts("2021-03-03 06:00:00"))
    assert r3.picked == {} and not r3.reported

    runs = warehouse.committed_run_ids(spark, root)
    assert runs == ["20210301T060000", "20210302T060000", "20210303T060000"]
    cards = warehouse.current_history(spark, root, "cards")
    assert rows(cards, "card_num", "start_dt", "end_dt", "deleted_flg") == sorted([
        ("C1", C0, INF, "N"),
        ("C2", C0, ts("2021-03-02 05:59:59"), "N"),
        ("C2", ts("2021-03-02 06:00:00"), INF, "Y"),
    ], key=lambda t: tuple(str(x) for x in t))
    terms = warehouse.current_history(spark, root, "terminals")
    assert rows(terms, "terminal_id", "start_dt", "end_dt") == [
        ("T1", ts("2021-03-01 00:00:00"), INF), ("T2", ts("2021-03-01 00:00:00"), INF)]
    meta = {r.source_name: r.max_update_dt for r in warehouse.read_meta(spark, root, runs[-1]).collect()}
    assert meta["transactions"] == d("2021-03-02") and meta["terminals"] == d("2021-03-01")
    assert meta["blacklist"] == d("2021-03-01") and meta["cards"] == d("1900-01-01")
    fact = warehouse.current_transactions(spark, root)
    assert fact.count() == 6 and {r.feed_dt for r in fact.collect()} == {d("2021-03-01"), d("2021-03-02")}
    # the day-2 report only holds day-2 events (intended scope), day 1 is untouched
    assert rows(warehouse.current_reports(spark, root).where("report_dt = '2021-03-02'"),
                "event_type", "passport") == [("1", "P1")]


def test_failed_run_publishes_nothing(spark, tmp_path, feeds_dir):
    root = str(tmp_path / "wh")
    daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds_dir), root, ts("2021-03-01 06:00:00"))
    bad = _snapshots(spark, 1)
    bad["cards"] = bad["cards"].limit(0)
    with pytest.raises(daily.EmptySnapshot):
        daily.run(spark, daily.Sources(bad, feeds_dir), root, ts("2021-03-02 06:00:00"))
    assert warehouse.committed_run_ids(spark, root) == ["20210301T060000"]
    # the rerun of the day succeeds and the debris of the failed attempt is ignored
    daily.run(spark, daily.Sources(_snapshots(spark, 2), feeds_dir), root, ts("2021-03-02 07:00:00"))
    runs = warehouse.committed_run_ids(spark, root)
    assert runs == ["20210301T060000", "20210302T070000"]
    assert warehouse.current_history(spark, root, "cards").count() == 3


def test_run_must_move_forward(spark, tmp_path, feeds_dir):
    root = str(tmp_path / "wh")
    daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds_dir), root, ts("2021-03-01 06:00:00"))
    with pytest.raises(ValueError):
        daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds_dir), root, ts("2021-03-01 05:00:00"))
    assert dt  # noqa


def test_catch_up_takes_backlog_in_date_order(spark, tmp_path):
    from cardwatch.streaming import run_until_caught_up
    f = tmp_path / "feeds"
    f.mkdir()
    for day in ("28022021", "01032021"):          # name order differs from date order
        (f / f"transactions_{day}.txt").write_text(
            HEADER + f"{day};{day[4:]}-{day[2:4]}-{day[:2]} 10:00:00;1,00;C1;PAY;SUCCESS;T1\n")
    root = str(tmp_path / "wh")
    done = run_until_caught_up(spark, daily.Sources(_snapshots(spark, 1), str(f)), root,
                               ts("2021-03-02 06:00:00"))
    assert [r.picked.get("transactions", (None, None))[1] for r in done] == \
        [d("2021-02-28"), d("2021-03-01"), None]
    assert warehouse.current_transactions(spark, root).count() == 2


def test_vacuum_keeps_the_current_state(spark, tmp_path, feeds_dir):
    root = str(tmp_path / "wh")
    for day, t in ((1, "2021-03-01 06:00:00"), (2, "2021-03-02 06:00:00"), (2, "2021-03-03 06:00:00")):
        daily.run(spark, daily.Sources(_snapshots(spark, day), feeds_dir), root, ts(t))
    before = rows(warehouse.current_history(spark, root, "cards"))
    removed = warehouse.vacuum(spark, root, keep=1)
    assert any("dim_cards/run=20210301T060000/state=open" in p for p in removed)
    assert not any("dim_terminals" in p for p in removed)   # its only open set is current
    assert rows(warehouse.current_history(spark, root, "cards")) == before
    assert warehouse.current_open(spark, root, "terminals").count() == 2


def test_duplicate_snapshot_key_fails_the_run(spark, tmp_path, feeds_dir):
    from cardwatch.operators.staging import DuplicateKey
    root = str(tmp_path / "wh")
    snaps = _snapshots(spark, 1)
    snaps["cards"] = snaps["cards"].unionByName(snaps["cards"].limit(1))
    with pytest.raises(DuplicateKey, match="cards: key 'C1' occurs 2 times"):
        daily.run(spark, daily.Sources(snaps, feeds_dir), root, ts("2021-03-01 06:00:00"))
    assert warehouse.committed_run_ids(spark, root) == []


def test_literal_daily_runs_reproduce_the_original_history(spark, tmp_path):
    from tests.test_scd2_scenario import DAYS
    feeds = tmp_path / "nofeeds"
    feeds.mkdir()
    (feeds / "readme.txt").write_text("no feed files\n")
    root = str(tmp_path / "wh")
    base = _snapshots(spark, 1)
    for i, day in enumerate(DAYS):
        cards = [(k, v, C0, ts(u + " 00:00:00") if u else None) for k, v, u in day]
        snaps = dict(base, cards=spark.createDataFrame(cards, STG_CARDS))
        daily.run(spark, daily.Sources(snaps, str(feeds)), root,
                  dt.datetime(2021, 3, 1 + i, 6), mode="literal")
    e3, inf = ts("2021-03-03 23:59:59"), INF
    want = sorted([("a", "1", C0, e3), ("a", "2", ts("2021-03-02 00:00:00"), e3),
                   ("a", "2", ts("2021-03-02 00:00:00"), e3), ("a", "3", ts("2021-03-04 00:00:00"), inf),
                   ("b", "1", C0, e3), ("b", "1", C0, e3), ("c", "1", C0, e3), ("c", "1", C0, e3)],
                  key=lambda t: tuple(str(x) for x in t))
    got = rows(warehouse.current_history(spark, root, "cards"), "card_num", "account_num",
               "start_dt", "end_dt")
    assert got == want
    # an intended run may follow: it starts from the literal history's open rows
    assert warehouse.current_open(spark, root, "cards").count() == 1


def test_commit_refuses_a_run_built_on_a_stale_state(spark, tmp_path):
    root = str(tmp_path / "wh")
    warehouse.commit(spark, root, "20210301T060000", ts("2021-03-01 06:00:00"), expect_previous=None)
    warehouse.commit(spark, root, "20210302T060000", ts("2021-03-02 06:00:00"),
                     expect_previous="20210301T060000")
    with pytest.raises(warehouse.ConcurrentRun):
        warehouse.commit(spark, root, "20210302T070000", ts("2021-03-02 07:00:00"),
                         expect_previous="20210301T060000")
    assert warehouse.committed_run_ids(spark, root) == ["20210301T060000", "20210302T060000"]


def test_debris_of_a_run_failing_at_commit_is_invisible(spark, tmp_path, feeds_dir, monkeypatch):
    root = str(tmp_path / "wh")
    daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds_dir), root, ts("2021-03-01 06:00:00"))

    def boom(*a, **k):
        raise RuntimeError("lost the driver just before publishing")
    monkeypatch.setattr(warehouse, "commit", boom)
    with pytest.raises(RuntimeError):
        daily.run(spark, daily.Sources(_snapshots(spark, 2), feeds_dir), root, ts("2021-03-02 06:00:00"))
    monkeypatch.undo()
    # the failed run wrote fact and report rows for 2021-03-02 ...
    assert {r.feed_dt for r in warehouse.read_transactions(spark, root, ["20210302T060000"]).collect()} == {d("2021-03-02")}
    # ... which committed readers do not see
    assert {r.feed_dt for r in warehouse.current_transactions(spark, root).collect()} == {d("2021-03-01")}
    assert {r.report_dt for r in warehouse.current_reports(spark, root).collect()} == {d("2021-03-01")}
    assert warehouse.current_history(spark, root, "cards").count() == 2


def test_bucketed_open_sets_give_the_same_history_and_skip_a_shuffle(spark, tmp_path, feeds_dir):
    import re

    from cardwatch.operators import scd2
    from cardwatch.schemas import DIMS
    from tests.helpers import plan_text
    root = str(tmp_path / "wh")
    for day, t in ((1, "2021-03-01 06:00:00"), (2, "2021-03-02 06:00:00")):
        daily.run(spark, daily.Sources(_snapshots(spark, day), feeds_dir), root, ts(t),
                  open_buckets=8)
    cards = warehouse.current_history(spark, root, "cards")
    assert rows(cards, "card_num", "start_dt", "end_dt", "deleted_flg") == sorted([
        ("C1", C0, INF, "N"), ("C2", C0, ts("2021-03-02 05:59:59"), "N"),
        ("C2", ts("2021-03-02 06:00:00"), INF, "Y")], key=lambda t: tuple(str(x) for x in t))
    last = warehouse.holders(spark, root, "cards")[-1]
    assert warehouse.buckets_of(spark, root, last[0]) == 8
    opened = warehouse.open_of(spark, root, "cards", *last, buckets=8)
    staged = _snapshots(spark, 2)["cards"]
    plan = plan_text(scd2.merge(opened, staged, DIMS["cards"], scd2.Clock(ts("2021-03-03 06:00:00"))))
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1   # only the staged side


def test_vacuum_after_literal_runs_keeps_the_newest_history(spark, tmp_path, feeds_dir):
    root = str(tmp_path / "wh")
    for day, t in ((1, "2021-03-01 06:00:00"), (2, "2021-03-02 06:00:00")):
        daily.run(spark, daily.Sources(_snapshots(spark, day), feeds_dir), root, ts(t), mode="literal")
    before = rows(warehouse.current_history(spark, root, "cards"))
    removed = warehouse.vacuum(spark, root, keep=1)
    assert any("dim_cards/run=20210301T060000/state=history" in p for p in removed)
    assert not any("run=20210302T060000/state=history" in p for p in removed)
    assert rows(warehouse.current_history(spark, root, "cards")) == before


def _feeds(tmp_path, transactions, terminals="T1;POS;X;a1\nT2;ATM;Y;a2\n"):
    f = tmp_path / "feeds"
    f.mkdir()
    for day, text in transactions.items():
        (f / f"transactions_{day}.txt").write_text(HEADER + text)
    if terminals is not None:
        (f / "terminals_01032021.csv").write_text(TERM_HEADER + terminals)
    return str(f)


def test_long_values_are_kept_and_close_nothing(spark, tmp_path):
    """A surname or a terminal id beyond its old column width is a value like any other."""
    feeds = _feeds(tmp_path, {"01032021": "1;2021-03-01 10:00:00;1,00;C1;PAY;SUCCESS;T000001\n"})
    root = str(tmp_path / "wh")
    daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds), root, ts("2021-03-01 06:00:00"))
    snaps = _snapshots(spark, 1)
    long = "Petrov" * 5
    snaps["clients"] = snaps["clients"].selectExpr(
        "client_id", f"if(client_id = '2', '{long}', last_name) AS last_name", *snaps["clients"].columns[2:])
    daily.run(spark, daily.Sources(snaps, feeds), root, ts("2021-03-02 06:00:00"))
    assert warehouse.current_transactions(spark, root).collect()[0].terminal == "T000001"
    now = {r.client_id: r for r in warehouse.current_open(spark, root, "clients").collect()}
    assert now["2"].last_name == long and {r.deleted_flg for r in now.values()} == {"N"}


def test_rejected_rows_fail_the_run_or_delete_nothing(spark, tmp_path):
    feeds = _feeds(tmp_path, {"01032021": "1;not a date;1,00;C1;PAY;SUCCESS;T1\n2;2021-03-01 10:00:00;1,00;C1;PAY;SUCCESS;T1\n"})
    root = str(tmp_path / "wh")
    with pytest.raises(daily.RejectedRows, match="transactions: 1 rows"):
        daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds), root, ts("2021-03-01 06:00:00"))
    assert warehouse.committed_run_ids(spark, root) == []
    r = daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds), root, ts("2021-03-01 07:00:00"), allow_rejects=True)
    assert r.rejects["transactions"] == 1 and warehouse.current_transactions(spark, root).count() == 1
    snaps = _snapshots(spark, 2)      # C2 is missing, and one row's key can't be read
    snaps["cards"] = snaps["cards"].unionByName(spark.createDataFrame([(None, "A2", C0, None)], STG_CARDS))
    with pytest.raises(daily.RejectedRows):
        daily.run(spark, daily.Sources(snaps, feeds), root, ts("2021-03-02 06:00:00"))
    daily.run(spark, daily.Sources(snaps, feeds), root, ts("2021-03-02 07:00:00"), allow_rejects=True)
    assert rows(warehouse.current_open(spark, root, "cards"), "card_num", "deleted_flg") == [("C1", "N"), ("C2", "N")]
    daily.run(spark, daily.Sources(_snapshots(spark, 2), feeds), root, ts("2021-03-03 06:00:00"))
    assert rows(warehouse.current_open(spark, root, "cards"), "card_num", "deleted_flg") == [("C1", "N"), ("C2", "Y")]


def test_empty_terminals_file_fails_the_run(spark, tmp_path):
    feeds = _feeds(tmp_path, {}, terminals="")
    with pytest.raises(daily.EmptySnapshot, match="terminals"):
        daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds), str(tmp_path / "wh"), ts("2021-03-01 06:00:00"))


def test_literal_runs_take_successive_files(spark, tmp_path):
    day = lambda n: f"{n};2021-03-0{n} 10:00:00;1,00;C1;PAY;SUCCESS;T1\n"
    feeds = _feeds(tmp_path, {"01032021": day(1), "02032021": day(2)})
    root = str(tmp_path / "wh")
    picked = []
    for n in (1, 2, 3):
        r = daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds), root, dt.datetime(2021, 3, n, 6), mode="literal")
        picked.append({k: v[1] for k, v in r.picked.items()})
    assert picked == [{"transactions": d("2021-03-01"), "terminals": d("2021-03-01")}, {"transactions": d("2021-03-02")}, {}]
    meta = {r.source_name: r.max_update_dt for r in warehouse.read_meta(spark, root, "20210301T060000").collect()}
    assert meta["transactions"] == meta["terminals"] == d("2021-03-01") and meta["cards"] == d("1900-01-01")
    assert warehouse.current_transactions(spark, root).count() == 2


def test_rerun_after_a_crash_replaces_what_the_crashed_run_wrote(spark, tmp_path, monkeypatch):
    feeds = _feeds(tmp_path, {"01032021": "1;2021-03-01 10:00:00;1,00;C2;PAY;SUCCESS;T1\n"})
    root, at = str(tmp_path / "wh"), ts("2021-03-02 06:00:00")
    snaps = _snapshots(spark, 1)      # client 2's passport runs out on 2021-03-01: an R1 row

    def boom(*a, **k):
        raise RuntimeError("lost the driver just before publishing")
    monkeypatch.setattr(warehouse, "commit", boom)
    with pytest.raises(RuntimeError):
        daily.run(spark, daily.Sources(snaps, feeds), root, at)
    monkeypatch.undo()
    fixed = dict(snaps, clients=snaps["clients"].withColumn("passport_valid_to", F.lit(d("2030-01-01"))))
    daily.run(spark, daily.Sources(fixed, feeds), root, at)
    assert rows(warehouse.current_reports(spark, root), "event_type") == [("2",)]
    assert warehouse.current_transactions(spark, root).count() == 1


def test_catch_up_reports_late_rows_once_and_leaves_no_backlog(spark, tmp_path):
    """Days without a file, rows that come with a later file, and more files than runs in a week."""
    from cardwatch.streaming import run_until_caught_up
    line = lambda i, day, hour: f"{i};2021-03-{day:02d} {hour:02d}:00:00;1,00;C2;PAY;SUCCESS;T1\n"
    files = {f"{day:02d}032021": line(day, day, 9) + line(100 + day, day - 1, 23) for day in (2, 3, 4, 7, 8, 9, 10, 11)}
    root = str(tmp_path / "wh")
    done = run_until_caught_up(spark, daily.Sources(_snapshots(spark, 1), _feeds(tmp_path, files)), root, ts("2021-03-12 06:00:00"))
    assert [r.picked["transactions"][1].day for r in done[:-1]] == [2, 3, 4, 7, 8, 9, 10, 11] and not done[-1].picked
    contract = rows(warehouse.current_reports(spark, root).where("event_type = '2'"), "event_dt")
    # the account ran out on 2021-02-28: every row is a case, each exactly once
    want = [(dt.datetime(2021, 3, day, 9),) for day in (2, 3, 4, 7, 8, 9, 10, 11)]
    want += [(dt.datetime(2021, 3, day - 1, 23),) for day in (2, 3, 4, 7, 8, 9, 10, 11)]
    assert sorted(contract) == sorted(want)


@pytest.mark.parametrize("mode", ["intended", "literal"])
def test_catch_up_extracts_and_merges_the_snapshots_once(spark, tmp_path, mode):
    from cardwatch.streaming import run_until_caught_up
    line = lambda day: f"{day};2021-03-{day:02d} 09:00:00;1,00;C2;PAY;SUCCESS;T1\n"
    feeds = _feeds(tmp_path, {f"{day:02d}032021": line(day) for day in (1, 2)})
    at, once, each = ts("2021-03-12 06:00:00"), str(tmp_path / "once"), str(tmp_path / "each")
    done = run_until_caught_up(spark, daily.Sources(_snapshots(spark, 1), feeds), once, at, mode)
    for n in range(len(done)):  # the same runs, each with an extract and merges of its own
        daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds), each, at + dt.timedelta(seconds=n), mode)
    assert len(done) == 3
    assert [p.name for p in sorted((tmp_path / "once" / "stg_clients").iterdir())] == [f"run={done[0].run_id}"]
    writers = {p.name for p in (tmp_path / "once" / "dim_clients").iterdir()}
    assert len(writers) == (1 if mode == "intended" else 3)
    for name in ("cards", "accounts", "clients", "terminals"):
        got, want = (warehouse.current_history(spark, r, name) for r in (once, each))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
    for read in (warehouse.current_reports, warehouse.current_transactions):
        assert sorted(map(str, read(spark, once).collect())) == sorted(map(str, read(spark, each).collect()))


def test_staged_snapshots_are_not_taken_up_after_another_merge(spark, tmp_path, feeds_dir):
    root = str(tmp_path / "wh")
    first = daily.run(spark, daily.Sources(_snapshots(spark, 1), feeds_dir), root, ts("2021-03-01 06:00:00"))
    daily.run(spark, daily.Sources(_snapshots(spark, 2), feeds_dir), root, ts("2021-03-02 06:00:00"))
    with pytest.raises(ValueError, match="no longer"):
        daily.run(spark, daily.Sources(_snapshots(spark, 2), feeds_dir), root, ts("2021-03-03 06:00:00"), snapshots_of=first)
