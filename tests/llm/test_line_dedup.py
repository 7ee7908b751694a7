import random

import numpy as np

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import line_dedup as ld
from cardwatch.llm import queries

from . import brute

SF0001 = "/root/testdata/sf0.001"


def _check(spark, docs, rows):
    want = brute.removed_lines(rows)
    got = ld.report(docs).collect()
    assert len(got) == len(rows)
    expect = [(d, brute.cut(t, want.get((d, t or ""), [])), len(want.get((d, t or ""), [])), ",".join(map(str, sorted(want.get((d, t or ""), [])))))
              for d, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expect))


def _texts(seed, n, vocabulary):
    """Documents of lines, some repeated or changed in a word or two."""
    rng, lines, docs = random.Random(seed), [], []
    for i in range(n):
        own = []
        for _ in range(rng.randint(0, 6)):
            if lines and rng.random() < 0.5:
                w = rng.choice(lines).split()
                for _ in range(rng.randint(0, 3)):
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            else:
                w = [rng.choice(vocabulary) for _ in range(rng.randint(1, 25))]
            lines.append(" ".join(w))
            own.append(lines[-1] if rng.random() < 0.9 else "")
        docs.append((i, "\n".join(own)))
    return docs


def test_random_lines_against_all_pairs(spark):
    for seed, size in ((1, 30), (2, 400)):
        rows = _texts(seed, 150, [f"w{i}" for i in range(size)])
        _check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


@pytest.mark.parametrize("group", [(4, 10**6), (12, 10**6), (10**6, 0), (10**6, 2)])
def test_large_groups_against_all_pairs(spark, group):
    """Groups beyond ``GROUP`` members or ``PAIRS`` pairs for each of them meet their earliest members, then
    what is undecided meets the rest."""
    rng = random.Random(group[0] + group[1])
    base = [f"b{i}" for i in range(20)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(20)] = f"x{rng.randrange(60)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, t) for i, (_, t) in enumerate(_texts(5, 40, [f"w{i}" for i in range(60)]))]
    rng.shuffle(rows)
    pairs = list(_run_groups(spark, rows, group))
    assert any(p is None for p in pairs)
    want = brute.removed_lines(rows)
    got = {(r["d"], r["line"]) for r in _decide(spark, rows, group)}
    assert got == {(d, i) for (d, _), lines in want.items() for i in lines}


@pytest.mark.parametrize("group", [(4, 10**6), (10**6, 0)])
def test_set_aside_groups_of_many_two_line_families(spark, group):
    """Lines of 20 words share 18 with one other line alone; the two odd words of each are the rarest, so that the
    prefixes share words at the places 2 to 5."""
    rng = random.Random(7)
    rows = []
    for k in range(60):
        w = rng.sample([f"c{i}" for i in range(90)], 18)
        rows += [(2 * k + i, " ".join([f"odd{k}a{i}", f"odd{k}b{i}", *w])) for i in range(2)]
    want = brute.removed_lines(rows)
    assert len(want) == 60
    got = {(r["d"], r["line"]) for r in _decide(spark, rows, group)}
    assert got == {(d, i) for (d, _), lines in want.items() for i in lines}


def _shrunk(group):
    """The module's streaming step with other limits and small batches, as a function that carries them."""
    def run(batches):
        from cardwatch.llm import line_dedup

        old = line_dedup.GROUP, line_dedup.PAIRS, line_dedup._GATHER
        line_dedup.GROUP, line_dedup.PAIRS, line_dedup._GATHER = *group, 50
        try:
            yield from line_dedup._pair_groups(p for b in batches for p in (b.slice(i, 7) for i in range(0, b.num_rows, 7)))
        finally:
            line_dedup.GROUP, line_dedup.PAIRS, line_dedup._GATHER = old

    return run


def _run_groups(spark, rows, group):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = ld.line_sets(docs, ld.word_levels(docs)).where("n > 0")
    return [r["ed"] for r in ld.keyed(sets).mapInArrow(_shrunk(group), "m long, d long, f long, ed long, ef long").collect()]


def _decide(spark, rows, group):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    old = ld._pair_groups
    ld._pair_groups = _shrunk(group)
    try:
        return ld.removed_lines(docs).select("d", F.explode("lines").alias("line")).collect()
    finally:
        ld._pair_groups = old


def test_edge_rows(spark):
    long = " ".join(f"k{i}" for i in range(3000))
    huge = " ".join(f"h{i}" for i in range(70000))
    rows = [(5, "A line here\nb\n\nA line here"), (5, "A line here\nb\n\nA line here"), (3, "a LINE here\n \t\nÉ x"), (None, "b\nlone"), (None, None),
            (7, ""), (8, None), (9, "\n\n"), (4, "b\nfirst text"), (4, "b\nsecond text"), (11, long + "\nx1 y1"), (12, long + " k-extra"),
            (13, huge), (14, huge + " more"), (15, "x1 y1 z1\n" * 3), (16, "tab\tword\x0bhere\x0cnow"), (17, "now here word tab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _check(spark, docs, rows)
    more = docs.withColumn("lines", F.lit(1)).withColumn("_text", F.lit(2)).withColumn("n_chars", F.length("text").cast("long"))
    out = ld.dedup(more)
    assert out.columns == more.columns and out.schema["n_chars"].dataType == more.schema["n_chars"].dataType
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())
    assert ld.report(docs.where("false")).collect() == [] and ld.dedup(more.where("false")).collect() == []


def test_query_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    want = brute.removed_lines(rows)
    got = {r["doc_id"]: r for r in queries.op8_line_dedup(spark, SF0001).collect()}
    assert got.keys() == {d for d, _ in rows}
    for d, t in rows:
        assert got[d]["removed"] == ",".join(map(str, sorted(want.get((d, t), [])))), d
        assert got[d]["text"] == brute.cut(t, want.get((d, t), []))


def test_words_of_touching_texts():
    import pyarrow as pa

    texts = ["ab", "cd", None, "", " x\ny\n\nAB cd", "\n", "z"]
    w = ld.Words(pa.array(["skip", *texts]).slice(1)).lines()
    assert list(zip(w.row.tolist(), w.number.tolist())) == [(0, 0), (1, 0), (4, 0), (4, 1), (4, 3), (6, 0)]
    assert w.line.tolist() == [0, 1, 2, 3, 4, 4, 5]
    assert w.h[0] == w.h[4] and w.h[1] == w.h[5] and len(set(w.h.tolist())) == 5


def test_a_line_of_every_slice_is_told_by_the_task_that_knows_it(spark, monkeypatch):
    """Rows of small slices: the often repeated line goes on once a task, and results stay the same."""
    from cardwatch.llm import common

    rng = random.Random(5)
    rows = [(i, "\n".join(rng.sample([f"the same line {k} in every text" for k in range(4)], 3) + [f"own words {i} of a {rng.randrange(9999)} text"])) for i in range(300)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    table = docs.toArrow().to_batches()
    seen = ld._Seen()
    hot = 0
    for batch in table:
        for b in common.slices(iter([batch]), "text", 256):
            x = ld.Words(b.column("text")).lines()
            h, begin = x.sets(np.zeros(len(x.h), np.uint8))
            c = np.add.reduceat(ld.mix(h), begin[:-1]).view(np.int64)
            first = np.unique(c, return_index=True)[1]
            d = np.asarray(b.column(0))[x.row]
            known = seen.earlier(c[first], c[first], d[first], x.number[first].astype(np.int64))
            hot += int((~known).sum())
    assert hot < 300 + 4 * 40  # the 300 lines of their own, and the four each time an earlier document comes
    _check(spark, docs, rows)


def test_set_aside_groups_meet_under_two_words(spark):
    """Lines of frequent words: under one word of two hundred some thousand pairs meet, under two few."""
    rng = random.Random(11)
    words = [f"f{i}" for i in range(60)]
    rows = [(i, " ".join(rng.sample(words, 12))) for i in range(400)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(0, 400, 7)]
    want = brute.removed_lines(rows)
    got = {(r["d"], r["line"]) for r in _decide(spark, rows, (4, 10**6))}
    assert got == {(d, i) for (d, _), lines in want.items() for i in lines} and len(want) >= 57


@pytest.mark.parametrize("limits", [(0, 0), (3, 1)])
def test_groups_under_two_words_are_split_by_a_third_and_a_fourth(spark, monkeypatch, limits):
    monkeypatch.setattr(ld, "FULL", limits[0])
    monkeypatch.setattr(ld, "SPLIT", limits[1])
    rng = random.Random(13)
    words = [f"f{i}" for i in range(40)]
    rows = [(i, " ".join(rng.sample(words, rng.choice((4, 5, 8, 12, 16))))) for i in range(260)]
    for i in range(0, 260, 4):  # a word more, a word less, a word changed
        w = rows[i][1].split()
        rows.append((1000 + i, " ".join(rng.choice((w + ["more"], w[1:], w[:-1] + ["other"])))))
    rng.shuffle(rows)
    want = brute.removed_lines(rows)
    got = {(r["d"], r["line"]) for r in _decide(spark, rows, (4, 10**6))}
    assert got == {(d, i) for (d, _), lines in want.items() for i in lines} and len(want) >= 40


def _met(spark, n):
    """Lines of twelve of 50 equally frequent words, all set aside: pairs that meet, and the words they meet under."""
    rng = random.Random(17)
    words = [f"f{i}" for i in range(50)]
    docs = spark.createDataFrame([(i, " ".join(rng.sample(words, 12))) for i in range(n)], "doc_id long, text string")
    reps = ld.line_sets(docs, ld.word_levels(docs)).where("n > 0")
    aside = ld.keyed(reps)
    found = ld.groups(aside, reps, spark.createDataFrame([], "d long, f long"))
    sizes = found.groupBy("key", "next", "more").agg(F.count("*").alias("c"))
    r = sizes.agg(F.sum(F.expr("c * (c - 1) div 2")).alias("pairs"), F.max(F.size("more")).alias("deep"), F.sum("c").alias("rows")).collect()[0]
    return r["pairs"], r["deep"], r["rows"]


def test_pairs_met_grow_slower_than_the_square(spark, monkeypatch):
    """Four times the lines: sixteen times the pairs under two words alone, about seven with groups split."""
    few, _, _ = _met(spark, 3000)
    many, deep, _ = _met(spark, 12000)
    assert deep == 2 and many < 8 * few, (few, many)
    monkeypatch.setattr(ld, "FULL", 10**9)
    assert _met(spark, 3000)[0] > 2 * few


def test_lines_are_found_by_document_where_a_bitmap_would_be_full(spark, monkeypatch):
    monkeypatch.setattr(ld, "_BITS", (64, 64))
    rows = _texts(19, 120, [f"w{i}" for i in range(30)])
    rows += [(None, rows[5][1]), (None, rows[9][1] + "\nno id here at all"), (3, rows[7][1]), (4, "")]
    _check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_groups_too_large_for_a_task_are_dealt_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(ld, "SPREAD", 5)
    rng = random.Random(23)
    words = [f"f{i}" for i in range(30)]
    rows = [(i, " ".join(rng.sample(words, rng.choice((4, 8, 12))))) for i in range(220)]
    for i in range(0, 220, 4):
        w = rows[i][1].split()
        rows.append((1000 + i, " ".join(rng.choice((w + ["more"], w[1:], w[:-1] + ["other"])))))
    rng.shuffle(rows)
    want = brute.removed_lines(rows)
    got = {(r["d"], r["line"]) for r in _decide(spark, rows, (4, 10**6))}
    assert got == {(d, i) for (d, _), lines in want.items() for i in lines} and len(want) >= 30


def test_members_of_set_aside_groups_are_not_written_and_their_pairs_are_few(spark, monkeypatch):
    """Six rows and more a line under two words, many times that under four: they meet in the tasks that split them,
    and each pair goes on once."""
    rng = random.Random(29)
    words = [f"f{i}" for i in range(50)]
    docs = spark.createDataFrame([(i, " ".join(rng.sample(words, 12))) for i in range(3000)], "doc_id long, text string")
    reps = ld.line_sets(docs, ld.word_levels(docs)).where("n > 0")
    written, stored = [], ld.stored

    def counted(spark, df, purpose, codec="snappy"):
        out = stored(spark, df, purpose, codec)
        written.append(out.count())
        return out

    monkeypatch.setattr(ld, "stored", counted)
    pairs = ld.open_pairs(ld.keyed(reps), reps, spark.createDataFrame([], "d long, f long"))
    assert pairs.count() == pairs.distinct().count() > 0
    assert sum(written) <= 2 * 3000, written


def _long_lines(seed, n):
    """Lines of 50 to 140 words, and copies of some with words changed, left out or added, about as many as 0.8 allows."""
    rng, words = random.Random(seed), [f"v{i}" for i in range(700)]
    rows = [(i, " ".join(rng.sample(words, rng.randint(50, 140)))) for i in range(n)]
    for i in range(0, n, 2):
        w = rows[i][1].split()
        for k in range(rng.randint(0, len(w) // 4)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice(([f"new{k}"], [], [w[at], f"more{k}"]))
        rows.append((1000 + i, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("group", [(10**6, 10**6), (10**6, 0)])
def test_long_lines_compared_in_blocks_against_all_pairs(spark, monkeypatch, group):
    whole = _shrunk(group)

    def run(batches):
        from cardwatch.llm import line_dedup

        old = line_dedup.FEW, line_dedup._BLOCK
        line_dedup.FEW, line_dedup._BLOCK = 2, (3, 5)
        try:
            yield from whole(batches)
        finally:
            line_dedup.FEW, line_dedup._BLOCK = old

    rows = _long_lines(31, 120)
    want = brute.removed_lines(rows)
    monkeypatch.setattr(ld, "_pair_groups", run)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["d"], r["line"]) for r in ld.removed_lines(docs).select("d", F.explode("lines").alias("line")).collect()}
    assert got == {(d, i) for (d, _), lines in want.items() for i in lines} and 20 <= len(want) < 60


def test_long_lines_that_share_a_word_alone_are_no_candidates(spark):
    """The 42-bit parity alone told none of them apart: 80 words and more change about half of its bits, and may."""
    rng, words = random.Random(37), [f"v{i}" for i in range(2000)]
    docs = spark.createDataFrame([(i, " ".join(rng.sample(words, rng.randint(90, 150)))) for i in range(400)], "doc_id long, text string")
    reps = ld.line_sets(docs, ld.word_levels(docs)).where("n > 0")
    assert ld.candidates(reps).where("ed is not null").count() < 100


def test_near_copies_are_not_split_by_further_words(spark, monkeypatch):
    """Near copies share most words of their prefixes: under a third and a fourth word each would meet again and again."""
    rng = random.Random(41)
    rows = []
    for i in range(300):
        w = [f"b{k}" for k in range(40)]
        w[rng.randrange(40)] = f"own{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    reps = ld.line_sets(docs, ld.word_levels(docs)).where("n > 0")
    none = spark.createDataFrame([], "d long, f long")

    def met():
        sizes = ld.groups(ld.keyed(reps), reps, none).groupBy("key", "next", "more").agg(F.count("*").alias("c"))
        return sizes.agg(F.sum(F.expr("c * (c - 1) div 2"))).collect()[0][0]

    split = met()
    monkeypatch.setattr(ld, "FULL", 10**9)
    assert split <= met()
