"""Quality rules on repetition and length.

Per text, in numpy inside Spark tasks: words are numbered, rolling polynomial
hashes of the word numbers give the n-grams of several lengths (each length from
the one before by one multiply-add over the whole text), and for every length the
characters inside n-grams that occur twice or more are measured against all word
characters, likewise the characters of repeated lines.  A text is rejected if one
of these shares, or the share of symbols, is above its limit.  Base rules: fewer
than 50 words, or more than half of the words inside repeated 3-word windows (these
windows are compared exactly, not by hash).

Each text is judged alone, so nothing is shuffled and memory follows the largest
text of a batch.  Null texts count as empty; a text without words has zeros and
fails the base rules.  Repeated rows give a row each, an empty table an empty
result; extra columns are ignored by ``measure`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
#: Largest allowed share of word characters inside repeated n-grams, by n.
NGRAM_LIMITS = {5: 0.40, 7: 0.35, 10: 0.30}
MAX_DUP_LINE_CHARS = 0.40
MAX_SYMBOLS_PER_WORD = 0.20

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _inside_repeated(keys: np.ndarray, n: int, words: int) -> np.ndarray:
    """Marks the words inside n-grams whose key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    rep = np.zeros(len(keys), bool)
    rep[order[1:][same]] = True
    rep[order[:-1][same]] = True
    edge = np.zeros(words + 1, np.int32)
    at = np.flatnonzero(rep)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0



def measures(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars,
    then a share for each length of ``NGRAM_LIMITS``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    n = len(words)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    dup_lines = dup_line_chars = 0
    seen: set[bytes] = set()
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
            dup_line_chars += sum(len(w.decode("utf-8", "surrogatepass")) for w in line.split())
        elif line.strip():
            seen.add(line)
    if not n:
        return (0, 0, symbols, dup_lines, 0, dup_line_chars, *(0.0 for _ in NGRAM_LIMITS))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    chars_of = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in number), np.int64, len(number))
    chars = chars_of[ids]
    total = int(chars.sum())
    repeat = 0
    if n >= 3 and len(number) < n:
        v = len(number)
        if v < 2_000_000:
            three = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
        else:  # pairs are numbered first, so that three numbers fit into 64 bits
            pairs = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
            three = pairs[:-1] * v + ids[2:]
        repeat = int(_inside_repeated(three, 3, n).sum())
    shares = []
    h, done = (ids + 1).astype(np.uint64), 1
    for k in sorted(NGRAM_LIMITS):
        if n < k or not repeat:  # a repeated n-gram has a repeated 3-gram inside
            shares.append(0.0)
            continue
        while done < k:
            h = h[:-1] * _BASE + (ids[done:] + 1).astype(np.uint64)
            done += 1
        mixed = h ^ (h >> np.uint64(29))
        inside = _inside_repeated(mixed, k, n)
        shares.append(float(chars[inside].sum()) / total)
    return (n, total, symbols, dup_lines, repeat, dup_line_chars, *shares)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")
_SHARES = tuple(f"dup_{k}gram_share" for k in sorted(NGRAM_LIMITS))
_SCHEMA = ", ".join([*(f"{c} long" for c in _COUNTS), *(f"{c} double" for c in _SHARES)])


def _struct_of(batch_text: pa.Array) -> list[pa.Array]:
    rows = [measures(t) for t in batch_text.to_pylist()]
    cols = list(zip(*rows)) if rows else [()] * (len(_COUNTS) + len(_SHARES))
    kinds = [pa.int64()] * len(_COUNTS) + [pa.float64()] * len(_SHARES)
    return [pa.array(c, k) for c, k in zip(cols, kinds)]


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words)


def _verdict() -> tuple[Column, Column]:
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    too_much = F.lit(False)
    for k, limit in NGRAM_LIMITS.items():
        too_much = too_much | (F.col(f"dup_{k}gram_share") > limit)
    too_much = too_much | (F.col("dup_line_chars") > MAX_DUP_LINE_CHARS * F.col("word_chars"))
    too_much = too_much | (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * F.col("n_words"))
    return failed, ~failed & ~too_much


def measure(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the counts and shares, ``base_failed`` and ``kept`` for each row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *_struct_of(b.column("text"))],
                                             names=["doc_id", *_COUNTS, *_SHARES])

    failed, kept = _verdict()
    return rows.mapInArrow(run, f"doc_id {id_type}, {_SCHEMA}").withColumns({"base_failed": failed, "kept": kept})


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns; one pass, no join."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            m = [np.asarray(c) for c in _struct_of(b.column(names.index(text)))]
            n_words, word_chars, n_symbols, _, n_repeat, line_chars = m[:6]
            good = (n_words >= MIN_WORDS) & (100 * n_repeat <= MAX_REPEATED_PERCENT * n_words)
            for k, share in zip(sorted(NGRAM_LIMITS), m[6:]):
                good &= share <= NGRAM_LIMITS[k]
            good &= (line_chars <= MAX_DUP_LINE_CHARS * word_chars) & (n_symbols <= MAX_SYMBOLS_PER_WORD * n_words)
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
