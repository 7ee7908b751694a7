"""FIXTURES sections 2 and 3, literal mode: the original statements' output."""

import datetime as dt

from cardwatch.operators import literal
from cardwatch.operators.scd2 import Clock
from cardwatch.schemas import ACCOUNTS, CARDS, CLIENTS, STG_ACCOUNTS, STG_CARDS, STG_CLIENTS, \
    STG_TERMINALS, TERMINALS
from tests.helpers import d, rows, ts
from tests.test_scd2_scenario import CREATE, DAYS

INF = ts("9999-12-31 00:00:00")
E3 = ts("2021-03-03 23:59:59")


def _staged(spark, spec, day):
    out = []
    for k, v, u in DAYS[day]:
        upd = ts(u + " 00:00:00") if u else None
        if spec is CARDS:
            out.append((k, v, CREATE, upd))
        elif spec is ACCOUNTS:
            out.append((k, d("2030-01-01"), v, CREATE, upd))          # v is the client attribute
        else:
            out.append((k, "L", "F", v, d("1990-01-01"), "P", d("2030-01-01"), "+1", CREATE, upd))
    schema = {CARDS: STG_CARDS, ACCOUNTS: STG_ACCOUNTS, CLIENTS: STG_CLIENTS}[spec]
    return spark.createDataFrame(out, schema)


def _run(spark, spec):
    h = spark.createDataFrame([], spec.dim_schema())
    for i in range(4):
        h = literal.step(h, _staged(spark, spec, i), spec, Clock(dt.datetime(2021, 3, 1 + i, 6)))
        h = spark.createDataFrame(h.collect(), spec.dim_schema())
    return h


def _kv(h, spec):
    v = {CARDS: "account_num", ACCOUNTS: "client", CLIENTS: "patronymic"}[spec]
    return rows(h, spec.key, v, "start_dt", "end_dt", "deleted_flg")


ACCOUNTS_LITERAL = [
    ("a", "1", ts("2021-01-01 00:00:00"), E3, "N"),
    ("a", "2", ts("2021-03-02 00:00:00"), E3, "N"),
    ("a", "2", ts("2021-03-02 00:00:00"), E3, "N"),
    ("a", "3", ts("2021-03-04 00:00:00"), INF, "N"),
    ("b", "1", ts("2021-01-01 00:00:00"), INF, "N"),
    ("c", "1", ts("2021-01-01 00:00:00"), ts("2021-03-02 05:59:59"), "N"),
    ("c", "1", ts("2021-03-02 06:00:00"), INF, "Y"),
]


def _sorted(x):
    return sorted(x, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_accounts_literal(spark):
    assert _kv(_run(spark, ACCOUNTS), ACCOUNTS) == _sorted(ACCOUNTS_LITERAL)


def test_clients_literal(spark):
    want = ACCOUNTS_LITERAL + [("c", "1", ts("2021-01-01 00:00:00"), INF, "N")]
    assert _kv(_run(spark, CLIENTS), CLIENTS) == _sorted(want)


def test_cards_literal(spark):
    want = [("a", "1", ts("2021-01-01 00:00:00"), E3, "N"),
            ("a", "2", ts("2021-03-02 00:00:00"), E3, "N"), ("a", "2", ts("2021-03-02 00:00:00"), E3, "N"),
            ("a", "3", ts("2021-03-04 00:00:00"), INF, "N"),
            ("b", "1", ts("2021-01-01 00:00:00"), E3, "N"), ("b", "1", ts("2021-01-01 00:00:00"), E3, "N"),
            ("c", "1", ts("2021-01-01 00:00:00"), E3, "N"), ("c", "1", ts("2021-01-01 00:00:00"), E3, "N")]
    assert _kv(_run(spark, CARDS), CARDS) == _sorted(want)


def test_terminals_literal(spark):
    feeds = [
        [("T1", "P", "X", "a1"), ("T2", "A", "Y", "a2"), ("T3", "P", "Z", "a3")],
        [("T1", "P", "X", "a1b"), ("T2", "A", "Y2", "a2")],
        [("T1", "P", "X", "a1b"), ("T2", "A", "Y2", "a2"), ("T3", "P", "Z", "a3")],
    ]
    h = spark.createDataFrame([], TERMINALS.dim_schema())
    for i, f in enumerate(feeds):
        fd = dt.date(2021, 3, 1 + i)
        staged = spark.createDataFrame([(*r, fd) for r in f], STG_TERMINALS)
        h = literal.step(h, staged, TERMINALS, Clock(dt.datetime(2021, 3, 1 + i, 6), fd))
        h = spark.createDataFrame(h.collect(), TERMINALS.dim_schema())
    got = rows(h, "terminal_id", "terminal_city", "terminal_address", "start_dt", "end_dt",
               "deleted_flg")
    assert got == _sorted([
        ("T1", "X", "a1", ts("2021-03-01 00:00:00"), ts("2021-03-01 23:59:59"), "N"),
        ("T1", "X", "a1b", ts("2021-03-02 00:00:00"), INF, "N"),
        ("T1", "X", "a1b", ts("2021-03-03 00:00:00"), INF, "N"),
        ("T2", "Y", "a2", ts("2021-03-01 00:00:00"), INF, "N"),
        ("T2", "Y2", "a2", ts("2021-03-02 00:00:00"), INF, "N"),
        ("T2", "Y2", "a2", ts("2021-03-03 00:00:00"), INF, "N"),
        ("T3", "Z", "a3", ts("2021-03-01 00:00:00"), ts("2021-03-02 23:59:59"), "N"),
        ("T3", "Z", "a3", ts("2021-03-02 00:00:00"), ts("2021-03-02 23:59:59"), "Y"),
    ])


def _one(spark, spec, hist_rows, staged_rows, run_ts):
    schema = {CARDS: STG_CARDS, ACCOUNTS: STG_ACCOUNTS}[spec]
    h = spark.createDataFrame(hist_rows, spec.dim_schema())
    return h, spark.createDataFrame(staged_rows, schema), Clock(run_ts)


def test_b1_ambiguous_cards_close_fails_in_literal_mode(spark):
    import pytest
    hist = [("a", "1", CREATE, INF, "N"), ("b", "1", CREATE, INF, "N")]
    staged = [("a", "2", CREATE, ts("2021-03-02 00:00:00")), ("b", "2", CREATE, ts("2021-03-03 00:00:00"))]
    h, s, clock = _one(spark, CARDS, hist, staged, ts("2021-03-04 06:00:00"))
    with pytest.raises(Exception, match="not deterministic"):
        literal.step(h, s, CARDS, clock).collect()


def test_b18_null_update_dt_literal_vs_intended(spark):
    from cardwatch.operators import scd2
    hist = [("a", d("2030-01-01"), "1", CREATE, INF, "N")]
    staged = [("a", d("2030-01-01"), "2", CREATE, None)]          # changed, no update_dt
    h, s, clock = _one(spark, ACCOUNTS, hist, staged, ts("2021-03-04 06:00:00"))
    lit = rows(literal.step(h, s, ACCOUNTS, clock), "client", "start_dt", "end_dt")
    assert lit == [("1", CREATE, None), ("2", None, INF)]          # NULL end and NULL start
    got = rows(scd2.next_state(h, s, ACCOUNTS, clock), "client", "start_dt", "end_dt")
    assert got == [("1", CREATE, ts("2021-03-04 05:59:59")), ("2", ts("2021-03-04 06:00:00"), INF)]
