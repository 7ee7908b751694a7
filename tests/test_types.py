"""SURVEY 7.4.1: no zoned timestamps anywhere; report columns typed as the DDL."""

from pyspark.sql import types as T

import __spark_entry__ as entry
from cardwatch.schemas import REP_FRAUD
from tests.conftest import SF0001


def _walk(dt):
    yield dt
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            yield from _walk(f.dataType)
    elif isinstance(dt, T.ArrayType):
        yield from _walk(dt.elementType)


def test_no_zoned_timestamps_in_any_output(spark):
    for key, q in entry.queries().items():
        schema = q(spark, SF0001).schema
        zoned = [t for t in _walk(schema) if isinstance(t, T.TimestampType)]
        assert not zoned, key


def test_report_outputs_match_the_mart_schema(spark):
    want = [(f.name, f.dataType) for f in REP_FRAUD.fields]
    for key in ("report_passport", "report_contract", "report_city_hop", "report_fraud_all",
                "report_fraud_all_literal"):
        got = [(f.name, f.dataType) for f in entry.queries()[key](spark, SF0001).schema.fields]
        assert got == want, key
