"""A corpus pipeline of five of the operators.

Each stage works on all that the one before kept; between stages the documents are
written as Parquet to the shared checkpoint folder and read again.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwatch.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from cardwatch.llm.common import stored_at
from cardwatch.session import delete_folder, scratch_dir, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, with_ids=False)


STAGES = [("quality_rules", quality), ("line_dedup", dedup_lines), ("simhash", near_duplicates),
          ("decontaminate", benchmark_leaks), ("packing", pack)]

#: No SQL expresses rolling hashes, fingerprints or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage kept for itself is deleted when its documents are written, and
    those of the stage before with it; the last stage's scratch stays for the rows returned
    (``cardwatch.session.release_scratch`` deletes it)."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"stage-{name}")
        with scratch_scope(spark):
            docs = stored_at(spark, stage(spark, docs, sf_dir), path, "zstd")
        if last:
            delete_folder(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
