from pyspark.sql import functions as F

from cardwatch.llm import quality_rules as q
from cardwatch.llm import queries

from . import brute

SF0001 = "/root/testdata/sf0.001"
TEXTS = [None, "", "\n\n", "a", "a b c a b c", "x\x0by z\x1cw é\xa0è", "l m\nl m\n \nl m ", "#*$%&|<>", "w " * 60, " ".join(f"w{i}" for i in range(60)),
         " ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"w{i}" for i in range(60)),
         " ".join(f"w{i}" for i in range(300)) + " " + " ".join(f"w{i}" for i in range(90)),
         "\n".join(["this line is here again and again"] * 12), "### " * 30 + " ".join(f"w{i}" for i in range(60)),
         " ".join(f"v{i % 50000}" for i in range(120000))]


def _check(rows):
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == brute.quality(r["text"]), r["text"][:60] if r["text"] else r
        assert r["kept"] == brute.quality_kept(r["text"], q.NGRAM_LIMITS, q.MAX_DUP_LINE_CHARS, q.MAX_SYMBOLS_PER_WORD)


def test_edge_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, TEXTS[10])] * 2, "doc_id long, text string")
    docs = docs.withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(-1))
    got = q.measure(docs).collect()
    assert len(got) == len(TEXTS) + 2
    by = dict(enumerate(TEXTS)) | {None: TEXTS[10]}
    _check([r.asDict() | {"text": by[r["doc_id"]]} for r in got])
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if r["kept"])
    assert q.measure(docs.where("false")).collect() == [] and q.keep_good(docs.where("false")).collect() == []


def test_query_by_definition_and_keeps_good_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = queries.op5_quality_rules(spark, SF0001)
    _check([r.asDict() for r in got.join(docs.select("doc_id", "text"), "doc_id").collect()])
    good = spark.read.parquet(f"{SF0001}/labels.parquet").where("quality = 1").join(got, "doc_id").where("not base_failed")
    assert good.where("kept").count() >= 0.98 * good.count()
