"""Logical schemas of the warehouse and the open-interval sentinel."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the warehouse model (must stay as they are):
# open-interval end, watermark seed date, flag values, report event types,
# feed file prefixes and the date format inside feed file names.
INF = dt.datetime(9999, 12, 31, 0, 0, 0)
WATERMARK_SEED = dt.date(1900, 1, 1)
FLAG_LIVE = "N"
FLAG_DELETED = "Y"
EVENT_PASSPORT = "1"
EVENT_CONTRACT = "2"
EVENT_CITY_HOP = "3"
FEED_PREFIX_TRANSACTIONS = "transactions_"
FEED_PREFIX_BLACKLIST = "passport_blacklist_"
FEED_PREFIX_TERMINALS = "terminals_"
FEED_DATE_FORMAT = "ddMMyyyy"
SUCCESS = "SUCCESS"
META_SCHEMA = "dwh"
META_SOURCES = ("terminals", "cards", "accounts", "clients", "transactions", "blacklist")

S = T.StringType()
TS = T.TimestampNTZType()
D = T.DateType()
AMT = T.DecimalType(10, 2)


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


STG_TRANSACTIONS = _st(("trans_id", S), ("trans_date", TS), ("amt", AMT), ("card_num", S),
                       ("oper_type", S), ("oper_result", S), ("terminal", S))
STG_TERMINALS = _st(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                    ("terminal_address", S), ("update_dt", D))
STG_CARDS = _st(("card_num", S), ("account_num", S), ("create_dt", TS), ("update_dt", TS))
STG_ACCOUNTS = _st(("account_num", S), ("valid_to", D), ("client", S), ("create_dt", TS),
                   ("update_dt", TS))
STG_CLIENTS = _st(("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
                  ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
                  ("phone", S), ("create_dt", TS), ("update_dt", TS))
STG_BLACKLIST = _st(("enty_dt", D), ("passport_num", S))
META = _st(("schema_name", S), ("source_name", S), ("max_update_dt", D))
REP_FRAUD = _st(("event_dt", TS), ("passport", S), ("fio", S), ("phone", S),
                ("event_type", S), ("report_dt", D))

# Raw feed layouts: every field is read as text, then cast.
FEED_TRANSACTIONS_RAW = _st(("transaction_id", S), ("transaction_date", S), ("amount", S),
                            ("card_num", S), ("oper_type", S), ("oper_result", S),
                            ("terminal", S))
FEED_TERMINALS_RAW = _st(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                         ("terminal_address", S))
FEED_BLACKLIST_RAW = _st(("date", S), ("passport", S))

@dataclass(frozen=True)
class DimSpec:
    """One SCD2 dimension.

    ``feed_clock``: True for terminals, whose versions start at the feed file
    date and whose deletions are dated by it; False for snapshot dimensions,
    where new keys start at ``create_dt``, changes at ``update_dt`` and
    deletions at the run timestamp.
    """

    name: str
    key: str
    attrs: tuple[str, ...]
    staged_schema: T.StructType
    feed_clock: bool = False
    has_processed_dt: bool = False

    @property
    def dim_columns(self) -> list[str]:
        cols = [self.key, *self.attrs, "start_dt", "end_dt", "deleted_flg"]
        if self.has_processed_dt:
            cols.append("processed_dt")
        return cols

    def dim_schema(self) -> T.StructType:
        types = {f.name: f.dataType for f in self.staged_schema.fields}
        fields = [T.StructField(self.key, types[self.key], True)]
        fields += [T.StructField(a, types[a], True) for a in self.attrs]
        fields += [T.StructField("start_dt", TS, True), T.StructField("end_dt", TS, True),
                   T.StructField("deleted_flg", S, True)]
        if self.has_processed_dt:
            fields.append(T.StructField("processed_dt", TS, True))
        return T.StructType(fields)


CARDS = DimSpec("cards", "card_num", ("account_num",), STG_CARDS)
ACCOUNTS = DimSpec("accounts", "account_num", ("valid_to", "client"), STG_ACCOUNTS)
CLIENTS = DimSpec("clients", "client_id",
                  ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
                   "passport_valid_to", "phone"), STG_CLIENTS)
TERMINALS = DimSpec("terminals", "terminal_id",
                    ("terminal_type", "terminal_city", "terminal_address"), STG_TERMINALS,
                    feed_clock=True, has_processed_dt=True)
DIMS = {d.name: d for d in (CARDS, ACCOUNTS, CLIENTS, TERMINALS)}
