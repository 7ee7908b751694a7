"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import ensure_checkpoint_dir, scratch_dir

#: Upper bound, in rows, of a table that is broadcast after it was counted.
BROADCAST_ROWS = 200_000


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_hash(name: str = "text") -> Column:
    """Second half of a row's key: rows that repeat a ``doc_id`` with another
    text stay apart, rows that repeat both are the same document."""
    return F.xxhash64(text_or_empty(name))


def row_key(id_col: str) -> Column:
    """First half of a row's key, as text that is never null (ids are numbers)."""
    return F.coalesce(F.col(id_col).cast("string"), F.lit("null"))


def packed(docs: DataFrame, **extra: Column) -> DataFrame:
    """``docs`` as one struct column ``_row`` beside internal columns, so that no
    column of the caller can clash with a helper column."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
                       *[c.alias(n) for n, c in extra.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def stored(spark: SparkSession, df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage and
    survives the loss of executors)."""
    ensure_checkpoint_dir(spark)
    return stored_at(spark, df, scratch_dir(spark, f"llm-{purpose}"), codec)


def stored_at(spark: SparkSession, df: DataFrame, path: str, codec: str = "snappy") -> DataFrame:
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count proves that it has at most ``rows``
    rows (of fixed-width columns); otherwise as it is, for a shuffled join.
    ``df`` should be stored, as counting runs it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def slices(batches: Iterator[pa.RecordBatch], column: str,
           most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most_bytes`` in each
    (one row at least), which bounds a worker's memory."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        step = max(1, int(n * most_bytes / max(1, col.nbytes)))
        for at in range(0, n, step):
            yield batch.slice(at, min(step, n - at))
