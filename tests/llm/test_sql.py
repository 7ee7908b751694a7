"""Queries that SQL expresses, against DuckDB, on the small tables and on edge rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import chat_format, license_scan, queries, sql, url_filter

SF0001 = "/root/testdata/sf0.001"


def _duck(name, **tables):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        if t not in tables:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF0001}/{t}.parquet'")
    for t, frame in tables.items():
        con.register(t, frame)
    r = con.execute(sql.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    return sorted((dict(zip(cols, x)) for x in r.fetchall()), key=str)


def _rows(df):
    return sorted((r.asDict() for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_equals_sql(spark, name):
    got, want = _rows(queries.queries()[name](spark, SF0001)), _duck(name)
    assert [sorted(r) for r in got[:1]] == [sorted(r) for r in want[:1]]
    assert [{k: r[k] for k in sorted(r)} for r in sorted(got, key=lambda r: str(sorted(r.items())))] == [
        {k: r[k] for k in sorted(r)} for r in sorted(want, key=lambda r: str(sorted(r.items())))]


def _same(got, want):
    key = lambda r: str(sorted(r.items()))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_license_scan_edges(spark):
    texts = [None, "", "\n", "CC BY", "cc by cc by", "x cc-BY, all RIGHTS reserved", "general  public\nlicense", "ccby", "İcc by \u212A",
             "Released under the MIT License.", "released the mit license under x y z", "released under mit license",
             "Licensed under the Apache License, Version 2.0, and more words", "licensed under version license apache",
             "cc by " * 5000, "all rights reserved\n" * 3, "é all rights reservedé", "permission granted"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9, texts[9]), (None, texts[9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = _rows(license_scan.scan(docs.withColumn("words", F.lit(1)).withColumn("block", F.lit(1))).drop("n_blocks"))
    _same(got, _duck("op2_license_scan", documents=docs.toArrow()))
    assert license_scan.scan(docs.where("false")).collect() == []


def test_license_statements_wrapped_over_lines(spark):
    gpl = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License."""
    bsd = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions"""
    mpl = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this */"""
    narrow = "\n".join("Permission is hereby granted, free of charge, to any person obtaining a copy of this software".split())
    far = "licensed under the\n" + "other words go here " * 30 + "\napache license version 2 0"
    rows = [(1, "Licensed under the Apache License,\nVersion 2.0"), (2, gpl), (3, bsd), (4, mpl), (5, narrow), (6, far),
            (7, "x " * 60 + "Licensed under the Apache License,\n\n --- \nVersion 2.0 " + "y " * 60), (8, "\n" * 5000), (9, "apache\n" * 3000),
            (10, "\ue000 mit \ue000 license\nthe \ue000under\n\ue000")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    for i, label in ((1, "apache-2.0"), (2, "gpl"), (3, "bsd"), (4, "mpl"), (5, "mit"), (7, "apache-2.0")):
        assert label in out[i]["labels"].split(",") and out[i]["n_blocks"] > 0 and out[i]["score"] >= 0.8, i
    assert out[6]["labels"] == out[8]["labels"] == out[9]["labels"] == ""
    _same(_rows(license_scan.scan(docs).drop("n_blocks")), _duck("op2_license_scan", documents=docs.toArrow()))


def test_chat_edges(spark):
    hard = [r"a\b", r"\l", "\\", "<", "[", "<|im_start|>", "x<|im_end|>\n", "[INST]", "<|im_start|>user\nhi<|im_end|>\n", "</s>", "\n", "", None,
            "é<<SYS>>é", "x" * 50000, r"\\ll\b", "<|im_<|im_end|>end|>"]
    rows = [(i // 4, i % 4, role, t) for i, (t, role) in enumerate((t, r) for t in hard for r in ("user", "assistant"))]
    rows += [(100, 1, "assistant", "later"), (100, None, "user", "first"), (100, 1, "assistant", "later"), (None, 0, "assistant", "no id"),
             (101, 0, None, "no role"), (101, 1, "a\nb", "role with a line end"), (101, 2, "<|im_end|>", "odd"), (101, 3, r"\n", "odd")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ts", F.lit(1)).withColumn("turns", F.lit(1))
    out = chat_format.format_conversations(df).collect()
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, r or "", x or ""))
    order = lambda t: (t[0] is not None, t[0] or 0)
    for r in out:
        assert [(t["role"], t["text"]) for t in r["turns"]] == [t[1:] for t in sorted(by[r["conv_id"]], key=order)]
        body = r["formatted"].replace("<|im_start|>", "").replace("<|im_end|>\n", "")
        assert not any(c in body for c in chat_format.CONTROL)
    loss = chat_format.format_conversations(df).select("conv_id", chat_format.loss_text(F.col("formatted"), F.col("loss_mask")).alias("x"))
    for r in loss.collect():
        assert r["x"] == "".join(x for _, role, x in sorted(by[r["conv_id"]], key=order) if role == "assistant")
    assert chat_format.format_conversations(df.where("false")).collect() == []


def test_url_edges(spark):
    urls = [None, "", "http://", "no scheme/porn", "https://a.b://c/d", "HTTP://WWW.Example.COM/en/x?q", "http://example.com/en/", "http://x.example.com/en",
            "http://com/", "http://com", "http://a.net/es/x", "http://a.net/fr", "http://a.org/casino", "http://a.org/casinos", "http://a.org/x-casino-y",
            "http://a.org/free/cheap", "http://a.org/free-free", "http://a.org/free", "http://anet/es/", "http://a.net:80/es/", "http://net/fr/#x",
            "http://a.org#http://b.com/", "http://a.org/ü\nporn", "http://adult-x.net/", "http://M\u00dcNCHEN.\u03a3X.Example.com/en/", "x" * 100000 + "://a.com/",
            "http://a.org/track/free-shipping", "http://a.org/win-free-tickets", "http://a.org/sex-discrimination-law/adult-education",
            "http://a.org/%70orn/", "http://a.org/%50O%52n", "http://a.org/x%2Dporn%2dy", "http://a.org/%E4porn", "http://a.org/%3%337porn", "http://a.org/%zz%",
            "http://ads-track.a.org/", "http://a.org/poker/betting", "http://a.org/keygen", "http://a.org/free-free-win-win-sex"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, urls[3]), (None, None)], "page_id long, url string")
    got = _rows(url_filter.judge(df.withColumn("host", F.lit(1)).withColumn("n_soft", F.lit(1))).drop("n_strict", "n_soft", "soft_weight"))
    _same(got, _duck("op7_url_filter", pages=df.toArrow()))
    assert url_filter.judge(df.where("false")).collect() == []
    by = {r["page_id"]: r for r in got}
    assert by[5]["rule"] == "www.example.com/en/" and by[5]["verdict"] == "allow"
    assert by[6]["verdict"] == "block" and by[12]["verdict"] == "block" and by[13]["verdict"] == "allow"
    assert by[15]["verdict"] == "block" and by[16]["verdict"] == "allow"
    verdicts = [by[i]["verdict"] for i in range(26, len(urls))]
    assert verdicts == ["allow", "allow", "allow", "block", "block", "block", "block", "allow", "allow", "block", "block", "allow", "allow"]
    own = spark.createDataFrame([("Zebra", 100), ("lion", 60), ("lion", 10), ("cat", 40), (None, 5), ("dog", None), ("", 100)], "term string, weight long")
    pages = spark.createDataFrame([(1, "http://a.org/zebra"), (2, "http://a.org/lion/cat"), (3, "http://a.org/lion/dog"), (4, "http://a.org/casino")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, vocabulary=own).collect()} == {1: "block", 2: "block", 3: "allow", 4: "allow"}
    assert {r["verdict"] for r in url_filter.judge(pages, vocabulary=[]).collect()} == {"allow"}
    assert by[24]["host"] == "m\u00dcnchen.\u03a3x.example.com" and by[24]["rule"] == "example.com/en/"  # A-Z alone
