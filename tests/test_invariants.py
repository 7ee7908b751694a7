"""SCD2 invariants on random snapshot sequences."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardwatch.operators import scd2
from cardwatch.schemas import ACCOUNTS, STG_ACCOUNTS

KEYS = ["k1", "k2", "k3", "k4", "k5"]
C0 = dt.datetime(2021, 1, 1)
INF = dt.datetime(9999, 12, 31)

# one day: for each key either absent or (valid_to choice, client choice, updated?)
day = st.fixed_dictionaries({k: st.one_of(st.none(), st.tuples(
    st.sampled_from([None, dt.date(2030, 1, 1), dt.date(2031, 1, 1)]),
    st.sampled_from(["c1", "c2"]), st.booleans())) for k in KEYS})


def _staged(spark, snap, run_ts):
    rows = [(k, v[0], v[1], C0, run_ts.replace(hour=0) if v[2] else None)
            for k, v in snap.items() if v is not None]
    return spark.createDataFrame(rows, STG_ACCOUNTS)


def _check(rows, seen):
    by_key = {}
    for r in rows:
        by_key.setdefault(r.account_num, []).append(r)
    assert set(by_key) == seen
    for k, versions in by_key.items():
        versions.sort(key=lambda r: r.start_dt)
        assert sum(1 for r in versions if r.end_dt == INF) == 1, k
        for a, b in zip(versions, versions[1:]):
            assert a.end_dt < b.start_dt, (k, a, b)        # disjoint and ordered
        assert all(r.start_dt <= r.end_dt for r in versions)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=st.lists(day, min_size=1, max_size=3))
def test_history_invariants_and_idempotent_rerun(spark, days):
    hist = spark.createDataFrame([], ACCOUNTS.dim_schema())
    seen = set()
    for i, snap in enumerate(days):
        run_ts = dt.datetime(2021, 3, 1 + i, 6)
        hist = scd2.next_state(hist, _staged(spark, snap, run_ts), ACCOUNTS, scd2.Clock(run_ts))
        hist = spark.createDataFrame(hist.collect(), ACCOUNTS.dim_schema())
        seen |= {k for k, v in snap.items() if v is not None}
        _check(hist.collect(), seen)
    # the same snapshot again, a day later: nothing changes
    run_ts = dt.datetime(2021, 3, 1 + len(days), 6)
    again = scd2.merge(scd2.open_rows(hist), _staged(spark, days[-1], run_ts.replace(day=len(days))),
                       ACCOUNTS, scd2.Clock(run_ts))
    steps = {r.step for r in again.select("step").distinct().collect()}
    assert steps <= {"keep"}
