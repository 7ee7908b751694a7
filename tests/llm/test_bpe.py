import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from cardwatch.llm import bpe, queries

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.tokenizer_path())


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.tokenizer_path())


def _ids(encoder, text):
    return np.frombuffer(encoder([text])[0], "<u4")


def test_query_equals_the_library(spark, library):
    want = {}
    for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op13_bpe(spark, SF0001).collect()}
    assert got == want


def test_every_code_point_is_cut_as_the_library_cuts_it():
    cut = ByteLevel(add_prefix_space=False, trim_offsets=False)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} b" for c in points[at:at + 4000])
        assert bpe.words_of(text) == [text[a:b] for _, (a, b) in cut.pre_tokenize_str(text)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    "a", "b", "ab", "the", " ", "  ", "\n", "\t", "'s", "'ll", "'", "''", "'re", "'St", "é", "漢", "\U0001f600", "1", "23", "́",
    "\x85", "　", "\x1c", "\x00", "x" * 30, "!!", "=", "<|endoftext|>", "<|endof", "text|>", "I'm", "don't"]), max_size=40), st.sampled_from([3, 40, 1 << 20]))
def test_texts_equal_the_library(library, vocab, parts, piece):
    text = "".join(parts)
    want = library.encode(text, add_special_tokens=False).ids
    got = _ids(bpe.Encoder(vocab, piece=piece, memory=5), text)
    assert got.tolist() == want
    assert vocab.decoded(got.astype(np.int64)).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_long_words_and_pairs_that_overlap(library, vocab):
    rng = random.Random(4)
    encoder = bpe.Encoder(vocab)
    for text in ("a" * 100_001, "ab" * 30_000, " " * 5000 + "x", "=" * 777, "ACGT" * 2000, "".join(rng.choice("etaoinshr") for _ in range(20_000)),
                 "".join(map(chr, range(1, 0xD800))), "漢字" * 5000):
        assert _ids(encoder, text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_any_ids_decode_as_the_library_decodes(library, vocab):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(50300) for _ in range(rng.randint(0, 20))]
        known = [i for i in ids if i < 50257]
        assert vocab.decoded(np.array(ids, np.int64)).decode("utf-8", "replace") == library.decode(known, skip_special_tokens=False)


def test_edges(spark, library):
    rows = [(1, None), (2, ""), (3, "<|endoftext|>"), (4, "w ord's " * 300_000), (5, "x"), (5, "x"), (None, "y"), (6, "\x00\U0010ffff")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("raw", F.lit("z"))
    got = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted((d or 0, t or "") for d, t in rows)
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(r["text"], add_special_tokens=False).ids
    assert bpe.decode(bpe.encode(docs.where("false"))).collect() == []
    null = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bpe.decode(null).collect()[0]["text"] == ""
