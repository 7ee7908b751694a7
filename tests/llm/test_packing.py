import collections
import random

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardwatch.llm import packing, queries

from . import brute

SF0001 = "/root/testdata/sf0.001"


def _whole(rows, docs, sequence, key=lambda r: r["doc_id"]):
    """Every id in one piece, windows gapless and full, checksums right; tokens by window and source."""
    t = Tokenizer.from_file(packing.tokenizer_path())
    want = {d: [*t.encode(x or "", add_special_tokens=False).ids, 1] for d, x in docs}
    by_doc, by_window = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[key(r)].append(r)
        by_window[r["sequence_id"]].append(r)
    assert by_doc.keys() == want.keys()
    for d, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            ids = want[d][at:at + p["length"]]
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(want[d]), brute.crc(ids)) and p["length"] > 0
            at += p["length"]
        assert at == len(want[d])
    total = sum(map(len, want.values()))
    assert sorted(by_window) == list(range(-(-total // sequence)))
    for w, pieces in by_window.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == min(sequence, total - w * sequence)
    return by_window, total


def test_query_packs_every_id_once_in_the_sources_shares(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    rows = queries.op6_packing(spark, SF0001).collect()
    by_window, total = _whole(rows, [(r["doc_id"], r["text"]) for r in docs], 2048)
    of = collections.Counter()
    for r in rows:
        of[r["source"]] += r["length"]
    # after any number of windows each source is a quantum or so away from its share: deficits are carried on
    got = collections.Counter()
    for w in range(max(by_window)):
        for p in by_window[w]:
            got[p["source"]] += p["length"]
        assert all(abs(got[s] - 2048 * (w + 1) * n / total) <= 2 * packing.QUANTUM for s, n in of.items()), w
    # documents are cut by windows and quanta alone
    assert len(rows) <= len(docs) + total // 2048 + total // packing.QUANTUM + len(of)


def test_targets_and_dry_queues(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "b", "b"]), " ".join(rng.choice("xyzuvw") for _ in range(rng.randint(0, 40)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = packing.pack(docs, targets={"a": 3.0, "b": 1.0}, sequence=64).collect()
    by_window, _ = _whole(got, [(d, t) for d, _, t in rows], 64)
    assert all(brute.crc(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in got)
    got = collections.Counter()
    for w in range(10):
        for p in by_window[w]:
            got[p["source"]] += p["length"]
        assert abs(got["a"] - 48 * (w + 1)) <= 16 and abs(got["b"] - 16 * (w + 1)) <= 16
    assert {p["source"] for p in by_window[max(by_window)]} == {"b"}


def test_mixture_is_the_order_of_due_times():
    for totals, shares in (([50, 30, 7, 1], None), ([40, 40], [3.0, 1.0]), ([5], None), ([3, 0, 9], [1.0, 1.0, 2.0]), ([40, 40, 40], None)):
        for quantum in (1, 4, 7):
            m = packing.Mixture(totals, shares, quantum)
            g = shares or totals
            order = sorted((((j + 0.5) * quantum / g[k], k, j) for k, t in enumerate(totals) for j in range(-(-t // quantum))),
                           key=lambda x: (round(x[0], 9), x[1]))
            at = 0
            for _, k, j in order:
                assert m.places(k, np.array([j])).tolist() == [at], (totals, quantum, k, j)
                at += min(quantum, totals[k] - j * quantum)
            assert at == sum(totals)


def test_a_deficit_round_robin_serves_the_same():
    """Step by step: the queue that is furthest behind its share at the middle of its next quantum."""
    totals, quantum = [900, 500, 260, 41], 16
    m, served, at = packing.Mixture(totals, None, quantum), [0] * 4, 0
    while at < sum(totals):
        k = min((k for k in range(4) if served[k] < totals[k]), key=lambda k: ((served[k] + quantum / 2) / totals[k], k))
        assert m.places(k, np.array([served[k] // quantum])).tolist() == [at]
        n = min(quantum, totals[k] - served[k])
        served[k] += n
        at += n


def test_a_tiny_source_among_very_many_tokens_is_placed_at_once():
    import time

    m = packing.Mixture([10 ** 13, 10 ** 13 // 3, 2000])
    t = time.time()
    row, start, length, window, offset = packing.pieces_of(np.array([2, 0]), np.array([100, 10 ** 13 - 1000]), np.array([1900, 1000]), m, 2048)
    assert time.time() - t < 1 and length[row == 0].sum() == 1900 and length[row == 1].sum() == 1000
    assert len(row) < 16 and window[row == 1][-1] >= 10 ** 13 // 2048 and (offset + length <= 2048).all()


def test_pieces_are_long():
    rng = random.Random(3)
    for shares in ([1] * 4, [1] * 20, [8, 4, 2, 1, 1]):
        n = [max(1, int(rng.expovariate(1 / 600))) for _ in range(2000)]
        queue = rng.choices(range(len(shares)), shares, k=2000)
        ends, at = collections.Counter(), []
        for k, x in zip(queue, n):
            at.append(ends[k])
            ends[k] += x
        m = packing.Mixture([ends[k] for k in range(len(shares))])
        row, _, length, window, offset = packing.pieces_of(np.array(queue), np.array(at), np.array(n), m, 2048)
        assert np.bincount(row, length, minlength=2000).tolist() == n
        assert np.bincount(window, length)[:-1].tolist() == [2048.0] * (sum(n) // 2048 - (sum(n) % 2048 == 0))
        # with a share of every window each, a queue would be cut in every window: windows * sources pieces more than documents
        assert len(row) < 2000 + sum(n) / 2048 * 5


def test_every_source_with_a_target_has_its_queue(spark):
    rows = [(i, f"s{i % 400:03d}", "w " * (40 if i % 400 < 300 else 3)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)
    targets = {f"s{i:03d}": 1.0 for i in range(100, 400)}  # those with few tokens too
    got = packing.pack(docs, targets=targets, sequence=256).collect()
    by_window, _ = _whole(got, [(d, t) for d, _, t in rows], 256)
    small = max(p["sequence_id"] for p in got if p["source"] >= "s300")
    others = min(p["sequence_id"] for p in got if p["source"] < "s100")
    assert small <= max(by_window) // 2 and others > small / 2  # named ones by their target, the others after them
    try:
        packing.pack(docs, targets={f"s{i}": 1.0 for i in range(packing.MAX_TARGETS + 1)})
        raise AssertionError
    except ValueError as e:
        assert "targets" in str(e)


def test_chunkwise_ids_equal_the_tokenizers():
    t, ids = Tokenizer.from_file(packing.tokenizer_path()), packing.TokenIds(packing.tokenizer_path())
    for text in (None, "", "  two  spaces ", "it's\tA tab\r\nÉcole <|endoftext|> x", "e\u0301 \u0301x ΑΣ Σ", "a\xa0b\u2003c 12,5%", "\u00c0\u024f \u00df\u0130 \u00b2\u00bd_x__y '\u017f can't 'RE", "\x1c a\x1db",
                 "".join(map(chr, range(0x21, 0x2af))), " ".join(map(chr, range(0x21, 0x400)))):
        assert np.frombuffer(ids(text), ids.kind).tolist() == [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_edge_rows_and_many_sources(spark):
    rows = [(1, None, None), (2, "", ""), (3, "s", "some words"), (4, "long", "w " * 30000)] + [(10 + i, f"q{i}", f"text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("part", F.lit(9)).withColumn("n", F.lit(9))
    got = packing.pack(docs).collect()
    _whole(got, [(d, t) for d, _, t in rows], 2048)
    twice = packing.pack(docs.where("doc_id = 3").unionByName(docs.where("doc_id = 3"))).collect()
    assert sum(r["length"] for r in twice) == 2 * twice[0]["doc_tokens"]
    assert packing.pack(docs.where("doc_id is null or false")).collect() == []
    null = packing.pack(spark.createDataFrame([(None, "s", "x")], "doc_id long, source string, text string")).collect()
    assert [r["doc_id"] for r in null] == [None]


def test_a_large_null_source_beside_the_shared_queue(spark):
    rows = [(1, None, "w " * 5000), (2, "", "v " * 3000)] + [(10 + i, f"q{i}", f"text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    counts = spark.createDataFrame([("", 9)] + [(f"q{i}", 2) for i in range(300)], "source string, n long")
    names, totals = packing.queue_totals(counts)
    assert len(set(names)) == len(names) == 256 and sum(totals) == 609
    for targets in (None, {"": 3.0, "q1": 1.0}):
        _whole(packing.pack(docs, targets=targets).collect(), [(d, t) for d, _, t in rows], 2048)
