"""Dimensions by key bucket (sinks/buckets.py): a run writes the buckets that changed."""

import datetime as dt
import glob
import os
import re

from pyspark.sql import functions as F

from cardwatch import catalog
from cardwatch.operators import scd2
from cardwatch.schemas import DIMS
from cardwatch.sinks import buckets
from tests.conftest import SF0001
from tests.helpers import plan_text, rows

NEXT = scd2.Clock(dt.datetime(2024, 1, 16, 6), dt.date(2024, 1, 16))


def _files(root, name):
    return sorted(os.path.relpath(f, root) for f in glob.glob(f"{root}/dimb_{name}/run=*/state=*/bucket=*/*.parquet"))


def test_only_changed_buckets_are_written(spark, tmp_path):
    root, name = str(tmp_path), "clients"
    tt, spec = catalog._tt(spark, SF0001), DIMS["clients"]
    buckets.bootstrap(tt.dim_before(name), root, name, "r1", 16)
    staged = catalog.staged(tt, name)
    assert buckets.refresh(staged, root, name, "r2", "r1", catalog._clock())
    assert rows(buckets.history(spark, root, name, "r2")) == rows(scd2.next_state(tt.dim_before(name), staged, spec, catalog._clock()))
    before = _files(root, name)

    assert buckets.refresh(staged, root, name, "r3", "r2", NEXT) == []       # the same snapshot once more
    assert _files(root, name) == before
    assert rows(buckets.history(spark, root, name, "r3")) == rows(buckets.history(spark, root, name, "r2"))

    key = staged.select(F.min("client_id")).collect()[0][0]
    moved = staged.withColumn("phone", F.when(F.col("client_id") == key, F.lit("+1")).otherwise(F.col("phone")))
    touched = buckets.refresh(moved, root, name, "r4", "r3", NEXT)
    assert len(touched) == 1
    new = sorted(set(_files(root, name)) - set(before))
    assert set(_files(root, name)) >= set(before)                            # files of other buckets keep their names
    assert {re.search(r"run=(\w+)/state=\w+/bucket=(\d+)", f).groups() for f in new} == {("r4", str(touched[0]))}
    want = scd2.next_state(buckets.history(spark, root, name, "r3"), moved, spec, NEXT)
    assert rows(buckets.history(spark, root, name, "r4")) == rows(want)
    held = {r.run for r in buckets.open_versions(spark, root, name, "r4").select("run").distinct().collect()}
    assert "r4" in held and len(held) > 1
    # what the run built on is as it was; a rerun replaces its own buckets alone
    assert rows(buckets.history(spark, root, name, "r3")) == rows(buckets.history(spark, root, name, "r2"))
    buckets.refresh(moved, root, name, "r4", "r3", NEXT)
    assert rows(buckets.history(spark, root, name, "r4")) == rows(want)


def test_unchanged_keys_are_decided_on_key_and_digest(spark, tmp_path):
    root, name = str(tmp_path), "clients"
    tt = catalog._tt(spark, SF0001)
    buckets.bootstrap(tt.dim_before(name), root, name, "r1", 8)
    found = buckets.classes(buckets.open_versions(spark, root, name, "r1"), catalog.staged(tt, name), DIMS[name])
    stored = [e for e in plan_text(found).split("\n\n") if "Scan parquet" in e and "dimb_clients" in e]
    assert stored and all(re.search(r"ReadSchema: struct<client_id:string,deleted_flg:string,digest:binary>", e) for e in stored)
    want = scd2.classify(scd2.open_rows(tt.dim_before(name)), catalog.staged(tt, name), DIMS[name], catalog._clock())
    assert rows(found) == rows(want, "client_id", "class")
    kept = buckets.classes(buckets.open_versions(spark, root, name, "r1"), catalog.staged(tt, name), DIMS[name], deletions=False)
    assert kept.where("class = 'DELETED'").count() == 0


def test_digests_tell_nulls_and_neighbours_apart(spark):
    spec = DIMS["clients"]
    base = {a: None for a in spec.attrs}
    cases = [dict(base), {**base, "last_name": ""}, {**base, "last_name": "a"}, {**base, "first_name": "a"}, {**base, "last_name": "a\",\"first_name\":\"b"},
             {**base, "last_name": "a", "first_name": "b"}, {**base, "date_of_birth": dt.date(2000, 1, 1)}, {**base, "passport_valid_to": dt.date(2000, 1, 1)}]
    types = {f.name: f.dataType for f in spec.staged_schema.fields}
    df = spark.createDataFrame([tuple(c[a] for a in spec.attrs) for c in cases],
                               ", ".join(f"{a} {types[a].simpleString()}" for a in spec.attrs))
    got = [bytes(r[0]) for r in df.select(buckets.digest(spec)).collect()]
    assert len(set(got)) == len(cases) and {len(g) for g in got} == {16}


def test_a_bucket_gets_its_first_key(spark, tmp_path):
    root, name = str(tmp_path), "cards"
    hist = spark.createDataFrame([("C1", "A1", dt.datetime(2023, 1, 1), dt.datetime(9999, 12, 31), "N")],
                                 "card_num string, account_num string, start_dt timestamp_ntz, end_dt timestamp_ntz, deleted_flg string")
    buckets.bootstrap(hist, root, name, "r1", 32)
    staged = spark.createDataFrame([(f"C{i}", f"A{i}", dt.datetime(2023, 1, 1), None) for i in range(1, 40)],
                                   "card_num string, account_num string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    buckets.refresh(staged, root, name, "r2", "r1", NEXT)
    assert buckets.open_versions(spark, root, name, "r2").count() == 39
    gone = buckets.refresh(staged.where("card_num = 'C1'"), root, name, "r3", "r2", NEXT, deletions=False)
    assert gone == [] and buckets.open_versions(spark, root, name, "r3").count() == 39
