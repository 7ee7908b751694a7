"""The pipeline against its stages by definition."""

import collections

import corpus_pipeline
from tokenizers import Tokenizer

from cardwatch.llm import packing, quality_rules, queries

from . import brute

SF0001 = "/root/testdata/sf0.001"


def test_pipeline_by_definition(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    rows = [(d, t) for d, t in rows if brute.quality_kept(
        t, quality_rules.NGRAM_LIMITS, quality_rules.MAX_DUP_LINE_CHARS, quality_rules.MAX_SYMBOLS_PER_WORD)]
    removed = brute.removed_lines(rows)
    rows = [(d, brute.cut(t, removed.get((d, t), []))) for d, t in rows]
    rows = [(d, t) for (d, t), (_, _, c) in zip(rows, brute.near_duplicates(rows)) if d == c]
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t in rows if not any(i in " ".join(t.split()) for i in items)]

    got = corpus_pipeline.run(spark, SF0001).collect()
    t = Tokenizer.from_file(packing.tokenizer_path())
    tokens = collections.Counter()
    for r in got:
        tokens[r["doc_id"]] += r["length"]
    assert dict(tokens) == {d: len(t.encode(x, add_special_tokens=False).ids) + 1 for d, x in rows}


def test_stages_return_documents_and_take_extra_columns(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(40).withColumn("_row", docs_extra())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF0001).columns == docs.columns
        assert stage(spark, docs.where("false"), SF0001).collect() == []


def test_the_pipeline_leaves_the_last_stages_folders_alone(spark):
    import os

    from cardwatch import session

    session.release_scratch(spark)
    out = corpus_pipeline.run(spark, SF0001)
    n = out.count()
    held = session._SCRATCH[spark.sparkContext.applicationId]
    there = [p for p in held if os.path.exists(p)]
    assert {os.path.basename(p).rsplit("-", 1)[0] for p in there} <= {"stage-decontaminate", "llm-token-ids", "llm-token-counts", "llm-token-places"}
    assert n == out.count() > 0
    session.release_scratch(spark)
    assert not any(os.path.exists(p) for p in there)


def docs_extra():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_registered_names():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
