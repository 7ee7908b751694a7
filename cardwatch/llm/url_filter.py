"""URL filter: host and path rules, then a weighted vocabulary.

Rules decide first.  A rule ``host/path`` fits the host and its subdomains if the
url's path starts with the rule's path; of several the longest wins (length of
host and path together; block wins a tie).  A url that no rule fits is judged by
its words: an Aho-Corasick automaton finds every vocabulary term in the lower-cased
url, whose percent escapes of letters, digits and hyphens are decoded; a hit counts only
where no ASCII letter or digit touches it.  The vocabulary is a table of terms and
weights.  The url is rejected on one strict term (weight ``STRICT`` or more) or on
``min_soft`` or more distinct soft ones whose weights come to ``STRICT``; words that are
common in harmless urls too weigh little, so that a few of them alone reject nothing.
Spark deals the rows; the automaton is built once per task from the parameters.

The vocabulary may be given as a DataFrame (term, weight) of at most ``MAX_TERMS`` rows;
of a term that stands twice the larger weight counts, null and empty terms and null
weights don't.  Null or empty urls, and urls without ``://``, have an empty host and path
and are allowed unless the vocabulary rejects them.  Repeated rows give a row each, an
empty table an empty result, extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

# The rules, and the vocabulary.
RULES = (("com", "/", "allow"),
         ("example.com", "/en/", "block"),
         ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"),
         ("net", "/fr/", "block"))
#: Weight at which a term, or the sum over distinct soft terms, rejects.
STRICT = 100
VOCABULARY = (
    # strict
    ("porn", 100), ("porno", 100), ("xxx", 100), ("xvideos", 100), ("hentai", 100), ("casino", 100), ("viagra", 100),
    ("cialis", 100), ("adult-x", 100), ("spam-farm", 100), ("free-bets", 100), ("cheap-pills", 100), ("escorts", 100),
    ("sexcam", 100), ("warez", 100),
    # soft, two of them suffice
    ("bet", 50), ("bets", 50), ("betting", 50), ("pills", 50), ("poker", 50), ("slots", 50), ("nude", 60), ("crack", 50),
    ("keygen", 70), ("torrent", 50), ("spam", 50), ("ads", 60), ("cheap", 70),
    # common words
    ("adult", 30), ("sex", 30), ("win", 30), ("free", 30), ("track", 40), ("farm", 20), ("click", 20), ("bonus", 40),
    ("loan", 30), ("loans", 30), ("dating", 40), ("pharmacy", 40))
MIN_SOFT = 2
MAX_TERMS = 1_000_000
#: Escapes of the characters that terms and their boundaries are told by, decoded one after the other.
ESCAPES = tuple((f"%{c:02x}", chr(c).lower()) for c in (*range(65, 91), *range(97, 123), 45, *range(48, 58)))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Fixed values of the contract: the host reaches to the first of ``/?#``, the
    path from there to the first of ``?#``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def winning_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct<rule, verdict> of the longest fitting rule, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[2] == "block"))
    for rule_host, rule_path, verdict in ordered:  # a longer one overrides
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def unescaped(url: str | None) -> str:
    low = (url or "").translate(_LOWER)
    if "%" in low:
        for escape, char in ESCAPES:
            low = low.replace(escape, char)
        low = _ESCAPE.sub(" ", low)  # of other characters, none of which a term holds
    return low


def term_weights(urls: list[str | None], automaton) -> tuple[list[int], list[int], list[int]]:
    """For each url the distinct strict and soft terms that stand in it by themselves, and the soft ones' weight."""
    n_strict, n_soft, weight = [], [], []
    for url in urls:
        low = unescaped(url)
        found: dict[str, int] = {}
        for end, (term, w) in automaton.iter(low) if len(automaton) else ():
            start = end - len(term) + 1
            if not (start and low[start - 1] in _WORD) and not (end + 1 < len(low) and low[end + 1] in _WORD):
                found[term] = w
        soft = [w for w in found.values() if w < STRICT]
        n_strict.append(len(found) - len(soft))
        n_soft.append(len(soft))
        weight.append(sum(soft))
    return n_strict, n_soft, weight


_ESCAPE = re.compile("%[0-9a-f]{2}")
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_LOWER = str.maketrans(_UPPER, _UPPER.lower())


def terms_of(vocabulary: DataFrame | Sequence[tuple[str, int]]) -> dict[str, int]:
    """Lower-case terms and weights; a DataFrame has at most ``MAX_TERMS`` rows, or it fails."""
    if isinstance(vocabulary, DataFrame):
        rows = vocabulary.select("term", F.col("weight").cast("int")).limit(MAX_TERMS + 1).collect()  # bounded
        if len(rows) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} terms")
        vocabulary = [tuple(r) for r in rows]
    out: dict[str, int] = {}
    for term, weight in vocabulary:
        if term and weight is not None:
            low = term.translate(_LOWER)
            out[low] = max(weight, out.get(low, weight))
    return out


def _automaton(terms: dict[str, int]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for term, weight in terms.items():
        a.add_word(term, (term, weight))
    a.make_automaton()
    return a


def judge(pages: DataFrame, rules=RULES, vocabulary: DataFrame | Sequence[tuple[str, int]] = VOCABULARY,
          min_soft: int = MIN_SOFT, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``n_strict``, ``n_soft``, ``soft_weight``."""
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).cast("string").alias("url"))
    terms = pages.sparkSession.sparkContext.broadcast(terms_of(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(terms.value)
        for b in slices(batches, "url"):
            found = term_weights(b.column("url").to_pylist(), automaton)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), *(pa.array(x, pa.int32()) for x in found)],
                                             names=["page_id", "url", "n_strict", "n_soft", "soft_weight"])

    t = rows.mapInArrow(count, f"page_id {id_type}, url string, n_strict int, n_soft int, soft_weight int")
    host, path = host_and_path(F.col("url"))
    t = t.select("page_id", host.alias("host"), path.alias("path"), "n_strict", "n_soft", "soft_weight")
    t = t.withColumn("won", winning_rule(F.col("host"), F.col("path"), rules))
    by_words = F.when((F.col("n_strict") > 0) | ((F.col("n_soft") >= min_soft) & (F.col("soft_weight") >= STRICT)), F.lit("block"))
    return t.select("page_id", "host", "path", F.col("won.rule").alias("rule"),
                    F.coalesce("won.verdict", by_words, F.lit("allow")).alias("verdict"), "n_strict", "n_soft", "soft_weight")
