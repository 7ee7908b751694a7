"""License scan: an exact set-similarity join of text blocks with license
templates, in DataFrame functions only.

A block is a line of a text, or what stands around the end of a line: up to twice
as many words as the longest template has before and after it, so that a statement
wrapped over several lines lies whole in such a block.  A template is a short license
statement; both are sets of words.  A block meets a template if it contains at least
``threshold`` of the template's words.  The join works as follows.

* Words that no template has can't add to an overlap and are left out of blocks.
* The remaining words are counted over all blocks of the corpus (a combinable
  aggregate; at most one row per template word reaches the driver) and ordered
  from rare to frequent.
* Prefix filter: a template of ``n`` words needs ``a = ceil(threshold * n)`` of
  them, so a matching block has one of its first ``n - a + 1`` words in that
  order.  Only those words are join keys, and blocks without one are dropped.
* Length filter: the block has at least ``a`` template words.
* Positional filter: with the shared word at ``p`` in the template and ``q`` in
  the block, at most ``1 + min(n - p - 1, size - q - 1)`` words from there on can
  be shared; taken over the first shared word it must reach ``a``.
* What is left is verified with ``array_intersect``.

Beside the join, ``scan`` reports the places at which fixed phrases stand.

Null texts count as empty; empty texts give zeros, nulls for the places and
empty label strings.  Repeated rows give a row each.  An empty table gives an
empty result.  Extra columns are ignored.  Ties in frequency are broken by the
word itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# Phrases of the base scan, and the license statements looked for.
PHRASES = (("cc by", "cc-by"),
           ("general public license", "gpl"),
           ("all rights reserved", "reserved"))
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this work is dedicated to the public domain"),
    ("reserved", "all rights reserved"),
)
THRESHOLD = 0.8
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone.  ``lower`` is faster and differs in words only for the
    two characters whose lower case has an ASCII letter."""
    return F.when(text.rlike("[İK]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SEPARATOR), lambda w: w != "")


def _needed(n: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n - 1e-9))


#: Stands for the end of a line among the words of a text; two ends without a word between them are one.
LINE_END = "\ue000"
_LINE_ENDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*"


def reach(templates=TEMPLATES) -> int:
    """Places before and after a line's end that a block takes in: at least as many words as a template has,
    as no two line ends stand together."""
    return 2 * max(len(t.split()) for _, t in templates)


def _joints(low: Column, templates, keys: Sequence[str]) -> Column:
    """The words around each end of a line, where a join key is among them."""
    r = reach(templates)
    words = words_of(F.regexp_replace(low, _LINE_ENDS, f" {LINE_END} "))
    known = F.array(*[F.lit(k) for k in keys])
    windows = F.transform(words, lambda w, i: F.when(w == LINE_END, F.slice(words, F.greatest(i + 1 - r, F.lit(1)), F.least(i, F.lit(r)) + r + 1)))
    return F.filter(windows, lambda w: w.isNotNull() & F.arrays_overlap(w, known))


def _blocks(low: Column, vocabulary: Sequence[str]) -> Column:
    """Lines as arrays of distinct template words."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    return F.transform(F.split(low, "\n"), lambda b: F.array_intersect(words_of(b), known))


def word_order(docs: DataFrame, templates=TEMPLATES, text: str = "text") -> list[str]:
    """The templates' words, from rare to frequent over all blocks of ``docs``.
    Brings at most one row per template word to the driver."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    low = docs.select(ascii_lower(text_or_empty(text)).alias("low"))
    counts = (low.select(F.explode(F.flatten(_blocks(F.col("low"), vocabulary))).alias("w"))
              .groupBy("w").count())
    seen = {r["w"]: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def prefix_index(order: Sequence[str], templates=TEMPLATES, threshold: float = THRESHOLD) -> list[tuple]:
    """(word, template, label, words, n, needed, p): a row for each prefix word."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for k, (label, t) in enumerate(templates):
        words = sorted(set(t.split()), key=rank.__getitem__)
        need = _needed(len(words), threshold)
        rows += [(w, k, label, words, len(words), need, p) for p, w in enumerate(words[: len(words) - need + 1])]
    return rows


def _places(words: Column, n: Column, phrase: str) -> Column:
    parts = phrase.split()
    last = n - len(parts)

    def here(i):
        cond = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            cond = cond & (F.get(words, i + k) == part)
        return cond

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(
        F.array().cast("array<int>"))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score`` (largest containment found,
    1 for a phrase), ``n_blocks`` (blocks that meet a template)."""
    spark = docs.sparkSession
    order = word_order(docs, templates, text)
    index = prefix_index(order, templates, threshold)
    keys = sorted({r[0] for r in index})
    some_key = f"(?:^|[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F])(?:{'|'.join(keys)})(?:$|[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F])"
    some_phrase = "|".join(SEPARATOR.join(p.split()) for p, _ in phrases)
    ranked = F.array(*[F.lit(w) for w in order])

    base = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       ascii_lower(text_or_empty(text)).alias("low"))
    base = base.withColumn("words", words_of(F.col("low")))
    none = F.array().cast("array<int>")
    n = F.size("words")
    base = base.withColumn("hit", F.col("low").rlike(some_phrase))
    for i, (phrase, _) in enumerate(phrases):
        base = base.withColumn(f"at{i}", F.when(F.col("hit"), _places(F.col("words"), n, phrase)).otherwise(none))
    at = F.concat(*[F.col(f"at{i}") for i in range(len(phrases))])
    labels = F.filter(F.array(*[F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]),
                      lambda x: x.isNotNull())
    # Template words of the blocks that have a join key, in the global order.
    lines = F.filter(F.split("low", "\n"), lambda b: b.rlike(some_key))
    blocks = F.transform(F.concat(F.transform(lines, words_of), _joints(F.col("low"), templates, keys)),
                         lambda b: F.array_intersect(ranked, b))
    base = base.select("doc_id", "rid", F.size("words").cast("long").alias("n_words"),
                       F.size(at).cast("long").alias("n_base"),
                       F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
                       F.array_sort(F.array_distinct(labels)).alias("base"),
                       F.when(F.col("low").rlike(some_key), blocks).otherwise(F.array().cast("array<array<string>>"))
                       .alias("blocks"))

    found = (base.select("*", F.posexplode_outer("blocks").alias("block", "tokens")).drop("blocks")
             .select("*", F.posexplode_outer("tokens").alias("q", "w")))
    prefixes = spark.createDataFrame(
        index, "w string, template int, label string, of array<string>, n int, need int, p int")
    size = F.size("tokens")
    found = found.join(F.broadcast(prefixes), "w", "left")
    room = F.col("need") <= F.least(F.col("n") - F.col("p"), size - F.col("q"))
    overlap = F.size(F.array_intersect("tokens", "of"))
    # The first shared word of a pair passes the positional filter if the pair matches.
    ok = (size >= F.col("need")) & room
    share = F.when(ok & (overlap >= F.col("need")), overlap / F.col("n"))
    found = found.withColumn("share", share)
    out = (found.groupBy("rid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base")
           .agg(F.max("share").alias("share"), F.collect_set(F.when(F.col("share").isNotNull(), F.col("label"))).alias("more"),
                F.count_distinct(F.when(F.col("share").isNotNull(), F.col("block"))).alias("n_blocks")))
    every = F.array_sort(F.array_union("base", "more"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                      F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
                      "n_blocks")
