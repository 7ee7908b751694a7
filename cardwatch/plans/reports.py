"""Fraud reports R1-R4.

R1  card used with an expired or blacklisted passport       (event_type '1')
R2  card used under an expired contract (account valid_to)  (event_type '2')
R3  card used in two cities within an hour                  (event_type '3')
R4  the mart: union of the three

``mode="intended"`` (default) takes for R1/R2 the transactions that the file of
``report_dt`` delivered, whenever they happened; for R3 the pairs whose later
side came with that file (the earlier side with any file) and whose gap is under
one hour; and stores R1 in the mart.  So a row that comes late, or after days
without a file, is reported with its file, and once.  ``mode="literal"`` keeps the original
statement text: R1 takes everything after midnight of the report day, R2
and R3 scan the whole fact, R3's gap test is always true (the minute field
of an interval is below 60), and the mart has no R1 rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.expr import date_lit, fio, ntz, ntz_lit, trimmed
from cardwatch.operators.bloom import may_meet
from cardwatch.operators.interval import as_of
from cardwatch.operators.lookup import attach_owners
from cardwatch.operators.sequence import with_next, with_previous_within_hour
from cardwatch.schemas import (EVENT_CITY_HOP, EVENT_CONTRACT, EVENT_PASSPORT,
                               REP_FRAUD, SUCCESS)

INTENDED, LITERAL = "intended", "literal"
REP_COLUMNS = [f.name for f in REP_FRAUD.fields]


def _check_mode(mode: str) -> None:
    if mode not in (INTENDED, LITERAL):
        raise ValueError(f"mode must be {INTENDED!r} or {LITERAL!r}, not {mode!r}")


# ---------------------------------------------------------------- R1a / R1b
def client_info(accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """Accounts with their client's name, passport and phone (R1a)."""
    a = accounts.select("account_num", "valid_to", "client")
    c = clients.select("client_id", "last_name", "first_name", "patronymic", "passport_num",
                       "passport_valid_to", "phone")
    return (a.join(c, a.client == c.client_id, "inner")
            .select("account_num", "valid_to", "client",
                    fio(F.col("last_name"), F.col("first_name"), F.col("patronymic")).alias("fio"),
                    "passport_num", "passport_valid_to", "phone"))


def scoped_transactions(fact: DataFrame, report_dt: dt.date, mode: str, report: str) -> DataFrame:
    """SUCCESS transactions in the scope of R1 or R2; the bound is a literal on the
    partition column ``feed_dt`` (literal mode: on ``trans_date``) and reaches the scan."""
    _check_mode(mode)
    t = fact.where(F.col("oper_result") == SUCCESS)
    if mode == INTENDED:
        t = t.where(F.col("feed_dt") == date_lit(report_dt))
    elif report == "passport":
        t = t.where(F.col("trans_date") > ntz_lit(report_dt))
    return t


def trans_info(fact: DataFrame, cards: DataFrame, report_dt: dt.date,
               mode: str = INTENDED, report: str = "passport") -> DataFrame:
    """Scoped transactions with the account of their card (R1b)."""
    t = scoped_transactions(fact, report_dt, mode, report).select(
        "trans_id", "trans_date", trimmed(F.col("card_num")).alias("card_key"))
    k = cards.select(trimmed(F.col("card_num")).alias("card_key"), "account_num")
    return (t.join(k, "card_key", "inner")
            .select("trans_id", "trans_date", F.col("card_key").alias("card_num"), "account_num"))


def _base(fact, cards, accounts, clients, report_dt, mode, report, blacklist=None) -> DataFrame:
    """Scoped SUCCESS transactions with their card's owner (inner joins);
    with ``blacklist``, each owner carries ``listed``."""
    t = scoped_transactions(fact, report_dt, mode, report).select(
        "trans_date", trimmed(F.col("card_num")).alias("card_key"))
    return attach_owners(t, cards, accounts, clients, outer=False, blacklist=blacklist)


def _rep(event_dt: Column, event_type: str, report_dt: dt.date) -> list[Column]:
    return [event_dt.alias("event_dt"), F.col("passport_num").alias("passport"), F.col("fio"),
            F.col("phone"), F.lit(event_type).alias("event_type"),
            date_lit(report_dt).alias("report_dt")]


def _passport_bad() -> Column:
    # ``listed`` comes from the owner lookup: the blacklist is checked once per
    # card (duplicate entries collapse), not once per transaction.
    return F.col("listed") | (ntz(F.col("passport_valid_to")) < F.col("trans_date"))


def _contract_bad() -> Column:
    return F.col("trans_date") > ntz(F.col("valid_to"))


# ---------------------------------------------------------------------- R1
def passport_report(fact, cards, accounts, clients, blacklist, report_dt: dt.date,
                    mode: str = INTENDED, prefilter: bool = False) -> DataFrame:
    """R1.  With ``prefilter`` the transactions are first told by a bitmap of the cards whose owner
    is listed, or has a passport that ends before the last of them: worth while where few
    cards are such and the scope's rows would be shuffled to meet all cards."""
    if not prefilter:
        b = _base(fact, cards, accounts, clients, report_dt, mode, "passport", blacklist)
    else:
        t = scoped_transactions(fact, report_dt, mode, "passport").select(
            "trans_date", trimmed(F.col("card_num")).alias("card_key"))
        last = t.agg(F.max("trans_date")).scalar()
        keys = cards.select(trimmed(F.col("card_num")).alias("card_key"))
        bad = attach_owners(keys, cards, accounts, clients, outer=False, blacklist=blacklist).where(
            F.col("listed") | (ntz(F.col("passport_valid_to")) < last))
        b = attach_owners(may_meet(t, "card_key", bad, "card_key"), cards, accounts, clients, outer=False, blacklist=blacklist)
    return (b.where(_passport_bad())
            .select(*_rep(F.col("trans_date"), EVENT_PASSPORT, report_dt)).distinct())


# ---------------------------------------------------------------------- R2
def contract_report(fact, cards, accounts, clients, report_dt: dt.date,
                    mode: str = INTENDED) -> DataFrame:
    b = _base(fact, cards, accounts, clients, report_dt, mode, "contract")
    return (b.where(_contract_bad())
            .select(*_rep(F.col("trans_date"), EVENT_CONTRACT, report_dt)).distinct())


def passport_and_contract(fact, cards, accounts, clients, blacklist, report_dt: dt.date) -> DataFrame:
    """R1 and R2 from one join pass (intended mode: both use the same scope).

    Each joined transaction yields zero, one or two report rows."""
    b = _base(fact, cards, accounts, clients, report_dt, INTENDED, "passport", blacklist)
    r1 = F.struct(*_rep(F.col("trans_date"), EVENT_PASSPORT, report_dt))
    r2 = F.struct(*_rep(F.col("trans_date"), EVENT_CONTRACT, report_dt))
    rows = F.array(F.when(_passport_bad(), r1), F.when(_contract_bad(), r2))
    return b.select(F.inline(F.filter(rows, lambda x: x.isNotNull()))).distinct()


# ---------------------------------------------------------------------- R3
def _cities(pairs: DataFrame, terminals: DataFrame) -> DataFrame:
    here = terminals.select(F.col("terminal_id").alias("terminal"), "terminal_city")
    there = terminals.select(F.col("terminal_id").alias("lead_terminal"),
                             F.col("terminal_city").alias("lead_city"))
    return (pairs.join(here, "terminal", "inner").join(there, "lead_terminal", "inner")
            .where(F.col("terminal_city") != F.col("lead_city"))
            .select("trans_id", "trans_date", "card_num", "terminal_city", "lead_tran",
                    "lead_city", "lead_date"))


def _sided(fact: DataFrame) -> DataFrame:
    return fact.select("trans_id", "trans_date", trimmed(F.col("card_num")).alias("card_num"),
                       "terminal", "oper_result", *[c for c in fact.columns if c in ("feed_dt", "trans_day")])


def _on_days_near(t: DataFrame, delivered: Column) -> DataFrame:
    """The rows of ``t`` on the days of the delivered ones or of the hour before them.  The days
    (one row each, as many as the calendar has at most) are broadcast, so that Spark prunes the
    fact's ``trans_day`` partitions with them when it runs."""
    if "trans_day" not in t.columns:
        return t
    hour = F.expr("INTERVAL 1 HOUR")
    days = t.where(delivered).select(F.explode(F.array(F.to_date("trans_date"), F.to_date(F.col("trans_date") - hour))).alias("near_day"))
    return t.join(F.broadcast(days.distinct()), F.col("trans_day") == F.col("near_day"), "left_semi").drop("trans_day")


def hop_pairs(fact: DataFrame, terminals: DataFrame, report_dt: dt.date,
              mode: str = INTENDED) -> DataFrame:
    """Each transaction with the next one on the same card and both cities,
    kept when the cities differ, the next one is close enough and the first
    one succeeded (R3a).  A NULL card is a group like any other.

    Intended mode looks from the delivered (later) side: the rows of its cards in
    its hours and the hours before, from any file, and the row just before it
    (``sequence.with_previous_within_hour``).  The earlier side carries its
    *terminal*; a terminal has one city, so pairs at the same terminal are dropped
    before any city is looked up, and the lookups run on the few candidates.  A fact with
    ``trans_day`` (``warehouse.read_transactions(..., days=True)``) is opened only at the
    delivered rows' days."""
    _check_mode(mode)
    t = _sided(fact)
    if mode == LITERAL:
        t = with_next(t, "card_num", ["trans_date", "trans_id"], ["trans_id", "terminal", "trans_date"])
        t = t.where((F.col("oper_result") == SUCCESS) & (F.col("terminal") != F.col("lead_terminal")))
        return _cities(t.withColumnsRenamed({"lead_trans_id": "lead_tran", "lead_trans_date": "lead_date"}), terminals)
    delivered = F.col("feed_dt") == date_lit(report_dt)
    hour = F.date_trunc("hour", "trans_date").cast("timestamp_ntz")
    near = (t.where(delivered).select("card_num", hour.alias("h")).distinct()
            .select(F.col("card_num").alias("c"), F.explode(F.array("h", F.col("h") - F.expr("INTERVAL 1 HOUR"))).alias("h"))
            .distinct())
    t = _on_days_near(t, delivered)
    t = t.join(near, t.card_num.eqNullSafe(near.c) & (hour == near.h), "left_semi")
    t = with_previous_within_hour(t, "card_num", "trans_date", "trans_id",
                                  ["trans_id", "trans_date", "terminal", "oper_result"])
    cand = t.where(delivered & (F.col("prev_oper_result") == SUCCESS) & (F.col("terminal") != F.col("prev_terminal"))
                   & (F.col("trans_date") < F.col("prev_trans_date") + F.expr("INTERVAL 1 HOUR")))
    cand = cand.select(F.col("prev_trans_id").alias("trans_id"), F.col("prev_trans_date").alias("trans_date"), "card_num",
                       F.col("prev_terminal").alias("terminal"), F.col("trans_id").alias("lead_tran"),
                       F.col("terminal").alias("lead_terminal"), F.col("trans_date").alias("lead_date"))
    return _cities(cand, terminals)


def hop_base(fact: DataFrame, terminals: DataFrame, cards: DataFrame, accounts: DataFrame,
             clients: DataFrame) -> DataFrame:
    """Every transaction with its city, the card, account and client as they were at its time
    (``cards``, ``accounts``, ``clients`` are whole histories), and the id, city and time of
    the next one on its card (NULL for the last), before any test (R3a).  Left joins
    throughout: whatever is missing is NULL, and no transaction is lost."""
    t = with_next(_sided(fact).drop("feed_dt", "trans_day"), "card_num", ["trans_date", "trans_id"],
                  ["trans_id", "terminal", "trans_date"])
    t = as_of(t, cards.withColumn("card_key", trimmed(F.col("card_num"))), "card_num", "trans_date", "card_key",
              {"card_num": "dim_card_num", "account_num": "account_num"})
    t = as_of(t, accounts, "account_num", "trans_date", "account_num",
              {"account_num": "dim_account_num", "client": "client"})
    names = clients.withColumn("fio", fio(F.col("last_name"), F.col("first_name"), F.col("patronymic")))
    t = as_of(t, names, "client", "trans_date", "client_id",
              {"client_id": "client_id", "fio": "fio", "passport_num": "passport_num", "phone": "phone"})
    here = terminals.select(F.col("terminal_id"), "terminal_city")
    there = terminals.select(F.col("terminal_id").alias("lead_terminal"), F.col("terminal_city").alias("lead_city"))
    return (t.join(here, t.terminal == here.terminal_id, "left").join(there, "lead_terminal", "left")
            .select("client_id", "fio", "passport_num", "phone", "terminal_id", "terminal_city", "dim_card_num",
                    "account_num", "dim_account_num", "client", "trans_date", "card_num", "terminal", "oper_result",
                    "trans_id", F.col("lead_trans_id").alias("lead_tran"), "lead_city",
                    F.col("lead_trans_date").alias("lead_date"))
            .distinct())


def city_hop_report(fact, terminals, cards_open, accounts_open, clients_open,
                    report_dt: dt.date, mode: str = INTENDED) -> DataFrame:
    """Latest earlier-side time per (passport, fio, phone) over the pairs.

    Pairs are found first and only then joined to the single open version of
    card, account and client (left joins, as in the original statement)."""
    p = hop_pairs(fact, terminals, report_dt, mode).select("trans_date", F.col("card_num").alias("card_key"))
    j = attach_owners(p, cards_open, accounts_open, clients_open, outer=True)
    return (j.groupBy("passport_num", "fio", "phone")
            .agg(F.max("trans_date").alias("event_dt"))
            .select(*_rep(F.col("event_dt"), EVENT_CITY_HOP, report_dt)))


# ---------------------------------------------------------------------- R4
def fraud_mart(fact, cards, accounts, clients, blacklist, terminals, cards_open,
               accounts_open, clients_open, report_dt: dt.date,
               mode: str = INTENDED) -> DataFrame:
    r3 = city_hop_report(fact, terminals, cards_open, accounts_open, clients_open,
                         report_dt, mode)
    if mode == INTENDED:
        r12 = passport_and_contract(fact, cards, accounts, clients, blacklist, report_dt)
    else:
        r12 = contract_report(fact, cards, accounts, clients, report_dt, LITERAL)
    return r12.select(*REP_COLUMNS).unionByName(r3.select(*REP_COLUMNS))
