import collections
import itertools
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from cardwatch.llm import filter_audit, sql

from . import brute


def by_definition(docs, labels):
    """docs: (doc_id, lang, text); one document and order at a time."""
    labels = [x for x in labels if x[0] is not None]  # a null id has no label
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    least = {}
    for d, _, t in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    failing = []
    for d, lang, t in docs:
        t = t or ""
        w = brute.words(t)
        failing.append((lang or "", d, "".join(f for f, bad in (
            ("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)), ("C", 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t)),
            ("D", any(c in "#$%&*|" for c in t)), ("E", d is not None and least[t] < d)) if bad)))
    out, by_filter = [], collections.Counter()
    for part in {p for p, _, _ in failing}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [(d, f) for p, d, f in failing if p == part]
            gone = []
            for step, name in enumerate(order, 1):
                here = [x for x in left if name in x[1]]
                redundant = sum(name in f for _, f in gone)
                left = [x for x in left if name not in x[1]]
                gone += here
                by_filter[part, name] += len(here)
                out.append([part, order, step, len(left), len(here), redundant, sum(p == part and f == name for p, _, f in failing),
                            sum(d in good for d, _ in here), sum(d in toxic for d, _ in here)])
    return sorted((*r, by_filter[r[0], r[1][r[2] - 1]]) for r in out)


COLUMNS = ("part", "filter_order", "step", *filter_audit._COLUMNS)


def _case(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, lang string, text string").withColumn("mask", F.lit("x")).withColumn("n", F.lit("y"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    got = sorted(tuple(r[c] for c in COLUMNS) for r in filter_audit.audit(d.repartition(3), lab).collect())
    return d, lab, got


def test_random_documents(spark):
    rng = random.Random(9)
    pool = [" ".join(rng.choice(["word", "Other", "THIRD", "x#", "y|z", "é"]) + (str(rng.randint(0, 400)) if rng.random() < .9 else "")
                     for _ in range(rng.choice([0, 1, 60, 99, 100, 101, 150]))) for _ in range(25)]
    docs = [(i, rng.choice(["a", "b", None, ""]), rng.choice(pool)) for i in range(160)]
    docs += [(7, "a", pool[0]), (7, "a", pool[0]), (None, "a", pool[0]), (None, None, pool[1]), (500, "c", None), (501, "c", ""), (-1, "d", pool[2]), (-1, "d", pool[2])]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 160, 2)] + [(0, 1, 1), (0, 0, 0), (None, 1, 1), (9999, 1, 1)]
    d, lab, got = _case(spark, docs, labels)
    assert got == by_definition(docs, labels)
    con = duckdb.connect()
    con.register("documents", d.toArrow())
    con.register("labels", lab.toArrow())
    r = con.execute(sql.oracle_sql()["op12_filter_audit"])
    cols = [c[0] for c in r.description]
    assert got == sorted(tuple(x[cols.index(c)] for c in COLUMNS) for x in r.fetchall())


def test_edges(spark):
    long = "Word " * 500_000
    docs = [(1, "a", long), (2, "a", long), (3, "a", " ".join(f"w{i}" for i in range(300_000)))]
    _, _, got = _case(spark, docs, [(1, 1, 1)])
    assert got == by_definition(docs, [(1, 1, 1)])
    d = spark.createDataFrame(docs[:1], "doc_id long, lang string, text string")
    assert filter_audit.audit(d.where("false"), d.selectExpr("doc_id", "1 quality", "1 toxic")).collect() == []
    assert _case(spark, docs[:1], [])[2] == by_definition(docs[:1], [])


def test_words_of_pieces():
    rng = random.Random(1)
    for n in (0, 1, 5, 400_000):
        raw = "".join(rng.choice("ab\n \x1c\x85") for _ in range(n)).encode()
        assert filter_audit._words(raw) == (len(raw.split()), len(set(raw.split())))


def test_removal_steps_follow_the_orders():
    names, position, step = filter_audit.removal_steps("ABC")
    assert len(names) == 6 and position.shape == (3, 6) and step.shape == (8, 6)
    for o, name in enumerate(names):
        for mask in range(8):
            fails = {f for i, f in enumerate("ABC") if mask >> i & 1}
            assert step[mask, o] == next((i for i, f in enumerate(name) if f in fails), 3)
    counts = filter_audit.interactions(np.zeros((3, 8), np.int64) + 2**40, "ABC")[1]  # whole numbers beyond doubles' comfort
    assert (counts["kept"][:, -1] == 2**40).all() and (counts["shapley"].sum(axis=1) == 6 * 7 * 2**40).all()
