"""Driver test tables -> the warehouse's logical inputs.

The driver tables hold no bank data, so card, account, client, terminal,
transaction and blacklist rows are derived from ``customer``, ``supplier``,
``nation`` and ``events`` by fixed formulas that plain SQL can repeat.  All
derivations are projections and filters over whole tables (one small join
with ``nation``), so they scale with the input.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.expr import date_lit
from cardwatch.schemas import DIMS, FLAG_DELETED, FLAG_LIVE

# Fixed values of the test scenario: one run on 2024-01-15 at 06:00, the
# feed files of that day, snapshot timestamps and the history seeded before.
RUN_TS = dt.datetime(2024, 1, 15, 6, 0, 0)
REPORT_DT = dt.date(2024, 1, 15)
FEED_DT = dt.date(2024, 1, 15)
WATERMARK_BEFORE = dt.date(2024, 1, 14)
CREATE_DT = "2023-01-01 00:00:00"
UPDATE_DT = "2024-01-14 00:00:00"
OPEN_START = "2023-01-01 00:00:00"
OLD_START = "2022-01-01 00:00:00"
OLD_END = "2022-12-31 23:59:59"
SEED_PROCESSED = "2023-01-01 06:00:00"
BLACKLIST_ENTRY = "2024-01-01"
INF_TEXT = "9999-12-31 00:00:00"

# Fixed derivation rules as SQL over the driver tables:
# dimension -> (key column of the source table, [(column, expression)]).
BASE_RULES = {
    "cards": ("c_custkey", [
        ("card_num", "concat('C', CAST(c_custkey AS STRING))"),
        ("account_num", "concat('A', CAST(c_custkey AS STRING))")]),
    "accounts": ("c_custkey", [
        ("account_num", "concat('A', CAST(c_custkey AS STRING))"),
        ("valid_to", "date_add(DATE'2024-01-01', CAST((c_custkey * 7) % 45 AS INT))"),
        ("client", "CAST(c_custkey AS STRING)")]),
    "clients": ("c_custkey", [
        ("client_id", "CAST(c_custkey AS STRING)"),
        ("last_name", "c_name"),
        ("first_name", "c_mktsegment"),
        ("patronymic", "CASE WHEN c_custkey % 13 = 0 THEN NULL "
                       "ELSE concat('P', CAST(c_nationkey AS STRING)) END"),
        ("date_of_birth", "date_add(DATE'1960-01-01', CAST(c_custkey % 9000 AS INT))"),
        ("passport_num", "concat('PP', CAST(c_custkey AS STRING))"),
        ("passport_valid_to", "date_add(DATE'2024-01-01', CAST(c_custkey % 60 AS INT))"),
        ("phone", "concat('+', CAST(c_custkey + 70000 AS STRING))")]),
    "terminals": ("s_suppkey", [
        ("terminal_id", "concat('T', CAST(s_suppkey AS STRING))"),
        ("terminal_type", "CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END"),
        ("terminal_city", "n_name"),
        ("terminal_address", "s_name")]),
}
# dimension -> (altered attribute, its value in the prior open version (keys
# with k % 5 = 0), its value in the oldest closed version (k % 7 = 0)).
PRIOR_RULES = {
    "cards": ("account_num", "concat('B', CAST(k AS STRING))", "concat('Z', CAST(k AS STRING))"),
    "accounts": ("valid_to", "date_add(DATE'2023-12-01', CAST((k * 7) % 45 AS INT))",
                 "DATE'2022-06-30'"),
    "clients": ("phone", "concat('+', CAST(k + 60000 AS STRING))",
                "concat('+', CAST(k + 50000 AS STRING))"),
    "terminals": ("terminal_address", "concat(terminal_address, ' old')",
                  "concat(terminal_address, ' older')"),
}


def _txt(c: Column) -> Column:
    return c.cast("string")


# The file that delivers an event: that of its day, or of the next day for some; the two
# days before the report day have no file, and their events come with the report day's.
DELIVERY = """CASE WHEN date_add(CAST(ts AS DATE), IF(event_id % 7 = 3, 1, 0)) BETWEEN DATE'2024-01-13' AND DATE'2024-01-14'
  THEN DATE'2024-01-15' ELSE date_add(CAST(ts AS DATE), IF(event_id % 7 = 3, 1, 0)) END"""


@dataclass
class TestTables:
    spark: SparkSession
    sf_dir: str
    whole: bool = False  # today's snapshots hold every key; else some are gone, for the deletions
    _tables: dict = field(default_factory=dict, repr=False)
    _derived: dict = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        """Each driver table is opened once per instance (one listing and one
        schema read); the DataFrame itself stays lazy."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._tables[name]

    def _memo(self, key, build):
        if key not in self._derived:
            self._derived[key] = build()
        return self._derived[key]

    # ---- per-key attribute rules (current, prior and oldest versions) ----
    def _base(self, dim: str) -> DataFrame:
        """Key column ``k`` plus the current attributes of one dimension."""
        if dim == "terminals":
            s = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
            n = self.table("nation").select("n_nationkey", "n_name")
            src = s.join(n, s.s_nationkey == n.n_nationkey, "left")
        else:
            src = self.table("customer")
        key_col, rules = BASE_RULES[dim]
        return src.selectExpr(f"{key_col} AS k", *[f"{e} AS {c}" for c, e in rules])

    def _snapshot(self, dim: str) -> DataFrame:
        spec = DIMS[dim]
        cols = [spec.key, *spec.attrs]
        if spec.feed_clock:
            dates = [f"DATE'{FEED_DT.isoformat()}' AS update_dt"]
        else:
            dates = [f"TIMESTAMP_NTZ'{CREATE_DT}' AS create_dt",
                     f"CASE WHEN k % 5 = 0 THEN TIMESTAMP_NTZ'{UPDATE_DT}' END AS update_dt"]
        rows = self._base(dim) if self.whole else self._base(dim).where("k % 17 <> 0")
        return rows.selectExpr(*cols, *dates)

    # ---- logical inputs ----
    def snapshot(self, dim: str) -> DataFrame:
        """Today's full source snapshot (staging input) of one dimension."""
        return self._memo(("snapshot", dim), lambda: self._snapshot(dim))

    def dim_before(self, dim: str) -> DataFrame:
        """History as it stood before the run: one open row per key (some of
        them tombstones) plus an older closed version for some keys."""
        return self._memo(("dim_before", dim), lambda: self._dim_before(dim))

    def _dim_before(self, dim: str) -> DataFrame:
        spec = DIMS[dim]
        attr, prior, oldest = PRIOR_RULES[dim]
        base = self._base(dim).where("k % 11 <> 0")
        proc = [f"TIMESTAMP_NTZ'{SEED_PROCESSED}' AS processed_dt"] if spec.has_processed_dt else []

        def attrs(replacement: str | None) -> list[str]:
            return [f"{replacement} AS {a}" if a == attr and replacement else a for a in spec.attrs]

        open_rows = base.selectExpr(
            spec.key, *attrs(f"CASE WHEN k % 5 = 0 THEN {prior} ELSE {attr} END"),
            f"TIMESTAMP_NTZ'{OPEN_START}' AS start_dt", f"TIMESTAMP_NTZ'{INF_TEXT}' AS end_dt",
            f"CASE WHEN k % 19 = 0 THEN '{FLAG_DELETED}' ELSE '{FLAG_LIVE}' END AS deleted_flg",
            *proc)
        old_rows = base.where("k % 7 = 0").selectExpr(
            spec.key, *attrs(oldest), f"TIMESTAMP_NTZ'{OLD_START}' AS start_dt",
            f"TIMESTAMP_NTZ'{OLD_END}' AS end_dt", f"'{FLAG_LIVE}' AS deleted_flg", *proc)
        return open_rows.unionByName(old_rows).select(*spec.dim_columns)

    def transactions(self) -> DataFrame:
        """Transactions of the whole feed history (the fact before reports)."""
        return self._memo("transactions", self._transactions)

    def _transactions(self) -> DataFrame:
        e = self.table("events")
        n_terminals = self.table("supplier").select(F.count(F.lit(1))).scalar()
        return e.select(
            _txt(F.col("event_id")).alias("trans_id"),
            F.col("ts").cast("timestamp_ntz").alias("trans_date"),
            F.col("value").cast("decimal(10,2)").alias("amt"),
            F.concat(F.lit("C"), _txt(F.col("user_id")), F.lit(" ")).alias("card_num"),
            F.col("event_type").alias("oper_type"),
            F.when(F.col("event_type") == "error", F.lit("REJECT"))
            .otherwise(F.lit("SUCCESS")).alias("oper_result"),
            F.concat(F.lit("T"), _txt(F.col("event_id") % n_terminals)).alias("terminal"),
            F.expr(DELIVERY).alias("feed_dt"))

    def blacklist(self) -> DataFrame:
        c = self.table("customer")
        return (c.where(F.col("c_acctbal") < 0)
                .select(date_lit(BLACKLIST_ENTRY).alias("enty_dt"),
                        F.concat(F.lit("PP"), _txt(F.col("c_custkey"))).alias("passport_num")))


def load(spark: SparkSession, sf_dir: str, whole: bool = False) -> TestTables:
    return TestTables(spark, sf_dir, whole)
