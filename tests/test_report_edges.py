"""FIXTURES section 5: report edge cases on hand-built tables (report date D)."""

import datetime as dt

import pytest

from pyspark.sql import types as T

from cardwatch.plans import reports
from cardwatch.schemas import (ACCOUNTS, CARDS, CLIENTS, STG_ACCOUNTS, STG_BLACKLIST, STG_CARDS,
                               STG_CLIENTS, STG_TERMINALS, STG_TRANSACTIONS)
from tests.helpers import d, rows, ts

D = dt.date(2024, 1, 15)
C0 = ts("2023-01-01 00:00:00")
INF = ts("9999-12-31 00:00:00")

# client id -> (passport, passport_valid_to, patronymic); account valid_to
CLIENTS_ROWS = [
    ("1", "Exp", "A", "P", d("2000-01-01"), "PP1", D, "+1", C0, None),           # expires on D
    ("2", "Blk", "B", "P", d("2000-01-01"), "PP2", d("2023-01-01"), "+2", C0, None),  # both
    ("3", "Nul", "C", "P", d("2000-01-01"), "PP3", None, "+3", C0, None),         # NULL validity
    ("4", "Nop", "D", None, d("2000-01-01"), "PP4", d("2020-01-01"), "+4", C0, None),  # NULL middle
    ("5", "Ok", "E", "P", d("2000-01-01"), "PP5", d("2030-01-01"), "+5", C0, None),
]
ACCOUNTS_ROWS = [("A1", d("2030-01-01"), "1", C0, None), ("A2", d("2030-01-01"), "2", C0, None),
                 ("A3", d("2030-01-01"), "3", C0, None), ("A4", d("2030-01-01"), "4", C0, None),
                 ("A5", D, "5", C0, None)]
CARDS_ROWS = [(f"C{i}", f"A{i}", C0, None) for i in range(1, 6)]
TERMINALS_ROWS = [("T1", "POS", "X", "a", D), ("T2", "POS", "Y", "b", D)]


FACT = T.StructType([*STG_TRANSACTIONS.fields, T.StructField("feed_dt", T.DateType())])


def _tx(rows_, feed_dt=D):
    """Delivered by the file of D unless a row names another date."""
    return [(str(i), ts(r[0]), None, r[1], "PAY", r[2], r[3], r[4] if len(r) > 4 else feed_dt) for i, r in enumerate(rows_)]


@pytest.fixture(scope="module")
def base(spark):
    mk = spark.createDataFrame
    cl = mk(CLIENTS_ROWS, STG_CLIENTS)
    ac = mk(ACCOUNTS_ROWS, STG_ACCOUNTS)
    ca = mk(CARDS_ROWS, STG_CARDS)

    def as_open(df, spec):
        from pyspark.sql import functions as F
        return df.select(*[spec.key, *spec.attrs]).withColumn("start_dt", F.lit(C0)) \
            .withColumn("end_dt", F.lit(INF)).withColumn("deleted_flg", F.lit("N"))
    return dict(clients=cl, accounts=ac, cards=ca,
                blacklist=mk([(d("2024-01-01"), "PP2")], STG_BLACKLIST),
                terminals=mk(TERMINALS_ROWS, STG_TERMINALS),
                cards_open=as_open(ca, CARDS), accounts_open=as_open(ac, ACCOUNTS),
                clients_open=as_open(cl, CLIENTS))


def _passport(spark, base, tx, mode="intended"):
    fact = spark.createDataFrame(_tx(tx), FACT)
    return reports.passport_report(fact, base["cards"], base["accounts"], base["clients"],
                                   base["blacklist"], D, mode)


def _contract(spark, base, tx, mode="intended"):
    fact = spark.createDataFrame(_tx(tx), FACT)
    return reports.contract_report(fact, base["cards"], base["accounts"], base["clients"], D, mode)


def _hops(spark, base, tx, mode="intended"):
    fact = spark.createDataFrame(_tx(tx), FACT)
    return reports.city_hop_report(fact, base["terminals"], base["cards_open"],
                                   base["accounts_open"], base["clients_open"], D, mode)


def test_passport_expiring_on_report_day_counts_after_midnight(spark, base):
    r = _passport(spark, base, [("2024-01-15 10:00:00", "C1", "SUCCESS", "T1")])
    assert rows(r, "event_dt", "passport", "event_type") == [(ts("2024-01-15 10:00:00"), "PP1", "1")]


def test_contract_valid_to_day_at_midnight_is_not_flagged(spark, base):
    assert _contract(spark, base, [("2024-01-15 00:00:00", "C5", "SUCCESS", "T1")]).count() == 0
    assert _contract(spark, base, [("2024-01-15 00:00:01", "C5", "SUCCESS", "T1")]).count() == 1


def test_blacklisted_and_expired_gives_one_row(spark, base):
    assert _passport(spark, base, [("2024-01-15 09:00:00", "C2", "SUCCESS", "T1")]).count() == 1


def test_null_validity_not_blacklisted_is_clean(spark, base):
    assert _passport(spark, base, [("2024-01-15 09:00:00", "C3", "SUCCESS", "T1")]).count() == 0


def test_rejected_transaction_is_not_reported(spark, base):
    tx = [("2024-01-15 09:00:00", "C2", "REJECT", "T1"), ("2024-01-15 09:00:00", "C5", "REJECT", "T1")]
    assert _passport(spark, base, tx).count() == 0
    assert _contract(spark, base, tx).count() == 0


def test_card_padded_on_one_side_is_joined(spark, base):
    r = _passport(spark, base, [("2024-01-15 09:00:00", "C2   ", "SUCCESS", "T1")])
    assert rows(r, "passport") == [("PP2",)]


def test_null_patronymic_gives_null_fio_and_keeps_row(spark, base):
    r = _passport(spark, base, [("2024-01-15 09:00:00", "C4", "SUCCESS", "T1")])
    assert rows(r, "passport", "fio") == [("PP4", None)]


def test_rows_are_reported_with_the_file_that_delivers_them(spark, base):
    other = dt.date(2024, 1, 16)
    late = [("2024-01-11 23:59:59", "C2", "SUCCESS", "T1"), ("2024-01-15 10:00:00", "C2", "SUCCESS", "T1", other)]
    assert rows(_passport(spark, base, late), "event_dt") == [(ts("2024-01-11 23:59:59"),)]
    assert _passport(spark, base, late, "literal").count() == 1   # after midnight of D, no upper bound
    # a hop counts with its later side's file; the earlier side may have come with any
    sides = [("2024-01-12 10:00:00", "C5", "SUCCESS", "T1", dt.date(2024, 1, 12)), ("2024-01-12 10:30:00", "C5", "SUCCESS", "T2"),
             ("2024-01-12 10:50:00", "C5", "SUCCESS", "T1", other)]
    assert rows(_hops(spark, base, sides), "event_dt") == [(ts("2024-01-12 10:00:00"),)]


def test_null_card_is_a_group_of_its_own(spark, base):
    tx = [("2024-01-15 10:00:00", None, "SUCCESS", "T1"), ("2024-01-15 10:30:00", None, "SUCCESS", "T2")]
    for mode in ("intended", "literal"):
        assert rows(_hops(spark, base, tx, mode), "event_dt", "passport") == [(ts("2024-01-15 10:00:00"), None)]


@pytest.mark.parametrize("gap,intended,literal", [
    ("10:59:59", 1, 1),   # 59 min 59 s
    ("11:00:00", 0, 1),   # exactly one hour
    ("13:05:00", 0, 1),   # 3 h 5 min
])
def test_two_cities_gap(spark, base, gap, intended, literal):
    tx = [("2024-01-15 10:00:00", "C5", "SUCCESS", "T1"), (f"2024-01-15 {gap}", "C5", "SUCCESS", "T2")]
    assert _hops(spark, base, tx).count() == intended
    assert _hops(spark, base, tx, "literal").count() == literal


def test_hop_success_rules(spark, base):
    first_reject = [("2024-01-15 10:00:00", "C5", "REJECT", "T1"),
                    ("2024-01-15 10:10:00", "C5", "SUCCESS", "T2")]
    assert _hops(spark, base, first_reject).count() == 0
    second_reject = [("2024-01-15 10:00:00", "C5", "SUCCESS", "T1"),
                     ("2024-01-15 10:10:00", "C5", "REJECT", "T2")]
    assert _hops(spark, base, second_reject).count() == 1


def test_unknown_terminal_is_not_a_hop(spark, base):
    for a, b in (("T1", "T9"), ("T9", "T2")):
        tx = [("2024-01-15 10:00:00", "C5", "SUCCESS", a), ("2024-01-15 10:10:00", "C5", "SUCCESS", b)]
        assert _hops(spark, base, tx).count() == 0


def test_three_hops_one_row_latest_earlier_side(spark, base):
    tx = [("2024-01-15 10:00:00", "C5", "SUCCESS", "T1"), ("2024-01-15 10:20:00", "C5", "SUCCESS", "T2"),
          ("2024-01-15 10:40:00", "C5", "SUCCESS", "T1"), ("2024-01-15 10:50:00", "C5", "SUCCESS", "T2")]
    r = _hops(spark, base, tx)
    assert rows(r, "event_dt", "passport", "event_type") == [(ts("2024-01-15 10:40:00"), "PP5", "3")]


def test_hop_across_hour_boundary_and_midnight(spark, base):
    # the hourly split must still pair 10:59 with 11:30, and a pair whose
    # earlier side is the evening before counts on D when its later side is on D
    tx = [("2024-01-15 10:59:00", "C5", "SUCCESS", "T1"), ("2024-01-15 11:30:00", "C5", "SUCCESS", "T2")]
    assert rows(_hops(spark, base, tx), "event_dt") == [(ts("2024-01-15 10:59:00"),)]
    tx = [("2024-01-14 23:40:00", "C5", "SUCCESS", "T1"), ("2024-01-15 00:10:00", "C5", "SUCCESS", "T2")]
    assert rows(_hops(spark, base, tx), "event_dt") == [(ts("2024-01-14 23:40:00"),)]


def test_same_timestamp_ties_break_on_trans_id(spark, base):
    tx = [("2024-01-15 10:00:00", "C5", "SUCCESS", "T1"), ("2024-01-15 10:00:00", "C5", "SUCCESS", "T2")]
    fact = spark.createDataFrame(_tx(tx), FACT)
    p = reports.hop_pairs(fact, base["terminals"], D)
    assert rows(p, "trans_id", "lead_tran") == [("0", "1")]
