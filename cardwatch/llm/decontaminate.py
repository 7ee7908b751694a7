"""Benchmark decontamination by template canonicalisation.

Words are brought to a canonical form: punctuation around them cut off, lower case;
numbers, units after a number, and names (capitalised words that don't begin a
sentence) become typed placeholders, the slots.  Windows of ``WINDOW`` canonical words
are hashed with a rolling polynomial.  Benchmark windows are stored as a table and, by
Spark, reduced to a bitmap of fixed size.  Tasks over the documents test each window
against that bitmap, in numpy, and emit the few that pass with the words in their
slots.  These are hash-joined with the benchmark's windows in Spark.

Matches are grouped by document, item and alignment (window place in the document
less its place in the item).  An alignment counts if at least ``MIN_WINDOWS`` windows
(all, if the item has fewer) match in their own words: a copy stays one whatever was
changed elsewhere on it.  It also counts if that many match as templates and its slots
are consistent: each value of the item always stands for one and the same value of the
document, and no two for the same.  So a question with other numbers or names is found,
and a chance run of placeholders is not.  A window with fewer than ``MIN_LITERALS`` plain
words says too little as a template and is none.  Every window with slots also has the
hash of its own words, which meets those words alone, whatever their case and the
punctuation around them: so copies are found in which sentences begin elsewhere or all is
lower case, and items that are mostly numbers and names.  On an alignment with consistent
slots, windows of either sort count together.

An item of fewer words than a window is one shorter window and must match whole; empty
items match nothing.  Null texts count as empty.  Repeated rows of documents give a
row each; repeated items, or items of equal text, are each reported.  Empty tables
give empty or clean results.  Extra columns are ignored by ``contaminated`` and kept
by ``remove_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import if_small, packed, row_key, slices, stored, text_hash, unpacked
from .words import Texts, hashes, mix

WINDOW = 8
MIN_LITERALS = 5
MIN_WINDOWS = 6
#: Bits of the bitmap that tasks test windows against, for each benchmark window (one in 64 of other windows passes at
#: most), and the logarithms of its least and largest size (1 MB; 32 MB, which 4 million windows fill to that degree).
BITS_A_WINDOW = 64
BITMAP_BITS = (23, 28)
#: Bytes of text that a task works on at once (one row at least): the arrays over them are many times as large, and a
#: worker partly keeps what they took (2 MB of documents took 156 MB, of which 53 stayed).
SLICE = 1 << 19
# Units that follow a number.
UNITS = frozenset("mm cm m km in ft yd mi g kg mg lb lbs oz t l ml s sec secs second seconds min mins minute minutes h hr hrs hour "
                  "hours day days week weeks month months year years meter meters metre metres kilometer kilometers mile miles "
                  "foot feet inch inches gram grams kilogram kilograms pound pounds liter liters litre litres percent % dollar "
                  "dollars euro euros cent cents degree degrees mph kmh km/h m/s w kw v hz khz mhz ghz b kb mb gb tb".split())

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SLOT = np.array([0, *(xxhash.xxh64_intdigest(x) for x in ("number", "unit", "name"))], np.uint64)


def _kind(of) -> bytes:
    return bytes(1 if of(chr(i)) else 0 for i in range(256))


# bytes of words: all but the ASCII punctuation that is cut off at the edges; digits; what ends a sentence
_CORE = _kind(lambda c: c > "~" or c.isalnum() or c == "%")
_DIGIT = _kind(lambda c: c in "0123456789")
_STOP = _kind(lambda c: c in ".!?:;")
#: Bytes of a letter, by its first.
_LETTER_BYTES = np.array([1 if i < 0xC0 else 2 if i < 0xE0 else 3 if i < 0xF0 else 4 for i in range(256)])


def _unit_hashes() -> np.ndarray:
    words = sorted(UNITS)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(hashes(np.frombuffer("".join(words).encode(), np.uint8), ends - [len(w) for w in words], ends))


def _before(text: bytes, kind: bytes) -> np.ndarray:
    """How many bytes of a kind stand before each place."""
    out = np.zeros(len(text) + 1, np.int64)
    np.cumsum(np.frombuffer(text.translate(kind), np.uint8), out=out[1:])
    return out


def _cores(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Words without the punctuation around them; empty ones begin and end where the word begins."""
    core = np.flatnonzero(np.frombuffer(t.text.translate(_CORE), bool))
    if not len(core):
        return t.start, t.start
    n = _before(t.text, _CORE)
    i, j = n[t.start], n[t.end]
    return (np.where(j > i, core[np.minimum(i, len(core) - 1)], t.start),
            np.where(j > i, core[np.maximum(j - 1, 0)] + 1, t.start))


class Canonical:
    """Canonical words of a batch of texts: ``h`` (hash), ``own`` (hash of the word itself), ``kind`` (0 plain, 1 number,
    2 unit, 3 name) and ``row`` of each word that has more than punctuation."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        as_is, low = Texts(texts), Texts(pc.utf8_lower(texts))
        if len(as_is.start) != len(low.start):  # word by word the same, but for lower case with white space
            low = Texts(pc.ascii_lower(texts))
        first = as_is.lines()
        start, end = _cores(as_is)
        self._low, (self._start, self._end) = low, _cores(low)
        h = hashes(low.raw, self._start, self._end)
        real = end > start
        digits, stops = _before(as_is.text, _DIGIT), _before(as_is.text, _STOP)
        # a sentence ends in what was cut off after the word
        begins = np.r_[True, stops[as_is.end] > stops[np.where(real, end, as_is.start)]][:-1]
        begins[first] = True
        kind = np.where(digits[end] > digits[start], 1, 0)
        units = _unit_hashes()
        at = np.minimum(np.searchsorted(units, h), len(units) - 1)
        kind[(kind == 0) & (units[at] == h) & np.r_[False, kind == 1][:-1]] = 2
        # a name differs from its lower case in the first letter alone
        maybe = np.flatnonzero(real & (kind == 0) & ~begins & (hashes(as_is.raw, start, end) != h))
        if len(maybe):
            own, lower = (np.minimum(s[maybe] + _LETTER_BYTES[t.raw[s[maybe]]], e[maybe])
                          for t, s, e in ((as_is, start, end), (low, self._start, self._end)))
            same = hashes(as_is.raw, own, end[maybe]) == hashes(low.raw, lower, self._end[maybe])
            kind[maybe[same & (end[maybe] > own)]] = 3
        self._at = np.flatnonzero(real)
        self.kind = kind[self._at]
        self.own = h[self._at]
        self.h = np.where(self.kind == 0, self.own, _SLOT[self.kind])
        self.row = as_is.row[as_is.line[self._at]] if len(self._at) else self._at

    def slots(self, at: int, size: int) -> list[str]:
        out = []
        for i in range(at, at + size):
            if self.kind[i]:
                k = self._at[i]
                out.append(f"{self.kind[i]}:{self._low.text[self._start[k]:self._end[k]].decode('utf-8', 'replace')}")
        return out


def _rolled(h: np.ndarray, n: int, size: int) -> np.ndarray:
    out = np.full(n, _U(size), np.uint64)
    for k in range(size):
        out = out * _BASE + h[k:k + n]
    return out


def windows(c: Canonical, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the windows within one text (signed), where they begin, and a mask of templates.  A window with
    slots occurs with its own words too; a template without slots is both."""
    n = len(c.h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(c.kind == 0)])
    plain, within = before[size:] - before[:-size], c.row[:n] == c.row[size - 1:]
    templates = np.flatnonzero(within & (plain >= min(MIN_LITERALS, size)))
    slotted = np.flatnonzero(within & (plain < size))
    h = _rolled(c.h, n, size)[templates]
    if len(slotted):
        h = np.r_[h, _rolled(c.own, n, size)[slotted]]
    return mix(h).view(np.int64), np.r_[templates, slotted], np.arange(len(h)) < len(templates)


_COLUMNS = "h long, size int, at int, template boolean, slots array<string>"
_ARROW = [("h", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("template", pa.bool_()), ("slots", pa.list_(pa.string()))]


def _add(cols: list[list], c: Canonical, size: int, h: np.int64, place: int, first: int, template: bool) -> None:
    for col, v in zip(cols, (int(h), size, place - first, template, c.slots(place, size) if template else [])):
        col.append(v)


def _batch(head: list[pa.Array], names: list[str], rows: list[int], cols: list[list]) -> pa.RecordBatch:
    take = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays([*(x.take(take) for x in head), *(pa.array(c, t) for c, (_, t) in zip(cols, _ARROW))],
                                      names=[*names, *(n for n, _ in _ARROW)])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``n_windows`` and ``n_templates`` (places in the item, and those of templates) and all windows of
    each item: ``h``, ``size``, ``at``, ``template``, ``slots``."""
    id_type = benchmark.schema[id_col].dataType.simpleString()
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            c = Canonical(b.column("text"))
            words = np.bincount(c.row, minlength=b.num_rows)
            first = np.cumsum(words) - words
            at, cols, counts = [], [[] for _ in _ARROW], np.zeros((2, b.num_rows), np.int32)
            counts[0] = np.maximum(words - WINDOW, 0) + 1
            for size in sorted({int(min(WINDOW, n)) for n in words if n}):
                h, place, template = windows(c, size)
                for x in np.flatnonzero(np.minimum(words, WINDOW)[c.row[place]] == size).tolist():
                    r = int(c.row[place[x]])
                    at.append(r)
                    counts[1, r] += template[x]
                    _add(cols, c, size, h[x], int(place[x]), int(first[r]), bool(template[x]))
            out = _batch([b.column("item_id")], ["item_id"], at, cols)
            yield pa.RecordBatch.from_arrays([out.column(0), *map(pa.array, counts[:, np.array(at, np.int64)]), *out.columns[1:]],
                                             names=["item_id", "n_windows", "n_templates", *(n for n, _ in _ARROW)])

    return rows.mapInArrow(run, f"item_id {id_type}, n_windows int, n_templates int, {_COLUMNS}")


def bitmap_bits(n: int) -> int:
    """Logarithm of the bitmap's size for so many windows."""
    least, most = BITMAP_BITS
    return min(max((n * BITS_A_WINDOW - 1).bit_length(), least), most)


def _bitmap(wins: DataFrame) -> tuple[np.ndarray, int, list[int]]:
    """Bits of the windows' hashes, their number's logarithm (at most 2^(BITMAP_BITS[1] - 6) words on the
    driver), and the window sizes that occur (1 to WINDOW)."""
    per_size = wins.groupBy("size").agg(F.count("*").alias("n")).collect()  # 1 to WINDOW rows
    bits = bitmap_bits(sum(r["n"] for r in per_size))
    place = F.shiftrightunsigned("h", 64 - bits)
    words = wins.select(F.shiftrightunsigned(place, 6).alias("i"), F.expr(f"shiftleft(1L, int(shiftrightunsigned(h, {64 - bits}) & 63))").alias("b"))
    found = words.groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()  # the bitmap's words
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[found["i"].to_numpy()] = found["b"].to_numpy()
    return bitmap.view(np.uint64), bits, sorted(r["size"] for r in per_size)


def _passing(batches: Iterator[pa.RecordBatch], bits: np.ndarray, n_bits: int, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """The windows of these texts that pass the bitmap, slice by slice."""
    for b in slices(batches, "text", SLICE):
        c = Canonical(b.column("text"))
        words = np.bincount(c.row, minlength=b.num_rows)
        first = np.cumsum(words) - words
        at, cols = [], [[] for _ in _ARROW]
        for size in sizes:
            h, place, template = windows(c, size)
            bit = h.view(np.uint64) >> _U(64 - n_bits)
            there = (bits[bit >> _U(6)] >> (bit & _U(63))) & _U(1)
            for x in np.flatnonzero(there).tolist():
                r = int(c.row[place[x]])
                at.append(r)
                _add(cols, c, size, h[x], int(place[x]), int(first[r]), bool(template[x]))
        yield _batch([b.column("_key"), b.column("_th")], ["_key", "_th"], at, cols)


def document_windows(docs: DataFrame, wins: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key``, ``_th`` (the row's key) and the windows of its text that pass the bitmap."""
    spark = docs.sparkSession
    bitmap, n_bits, sizes = _bitmap(wins)
    shared = spark.sparkContext.broadcast(bitmap)
    rows = docs.select(row_key(id_col).alias("_key"), text_hash(text).alias("_th"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _passing(batches, shared.value, n_bits, sizes)

    return rows.mapInArrow(run, f"_key string, _th long, {_COLUMNS}")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
            item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``_key``, ``_th``, ``item_id``, ``n_matched``, ``n_windows``, ``n_slots``, ``changed`` (a slot's
    value differs from the item's): a row for each document and item found in it."""
    wins = stored(docs.sparkSession, benchmark_windows(benchmark, item_col, item_text), "benchmark-windows")
    found = document_windows(docs, wins, id_col, text).distinct()
    items = if_small(wins.select("item_id", "n_windows", "n_templates", "h", "size", F.col("at").alias("item_at"), "template",
                                 F.col("slots").alias("item_slots")))
    hits = found.drop("template").join(items, ["h", "size"]).where(F.size("slots") == F.size("item_slots"))
    pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    hits = hits.select("_key", "_th", "item_id", "n_windows", "n_templates", "template", "item_at", (F.col("at") - F.col("item_at")).alias("shift"),
                       pairs.alias("pairs"))
    # A group is one item laid onto one place: at most as many rows as the item has windows.
    laid = hits.groupBy("_key", "_th", "item_id", "shift").agg(
        F.first("n_windows").alias("n_windows"), F.first("n_templates").alias("n_templates"),
        F.size(F.collect_set("item_at")).alias("n_matched"),
        F.size(F.collect_set(F.when(F.col("template"), F.col("item_at")))).alias("n_matched_templates"),
        F.size(F.collect_set(F.when(F.forall("pairs", lambda p: p["a"] == p["b"]), F.col("item_at")))).alias("n_literal"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    one_to_one = ((F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"]))) == F.size("pairs"))
                  & (F.size(F.array_distinct(F.transform("pairs", lambda p: p["b"]))) == F.size("pairs")))
    enough = ((F.col("n_matched") >= F.least(F.lit(MIN_WINDOWS), F.col("n_windows")))
              | ((F.col("n_templates") > 0)
                 & (F.col("n_matched_templates") >= F.least(F.lit(MIN_WINDOWS), F.col("n_templates")))))
    literal = F.col("n_literal") >= F.least(F.lit(MIN_WINDOWS), F.col("n_windows"))
    laid = laid.where(literal | (one_to_one & enough))
    return laid.groupBy("_key", "_th", "item_id").agg(
        F.max("n_matched").alias("n_matched"), F.first("n_windows").alias("n_windows"),
        F.max(F.size("pairs")).alias("n_slots"), F.max(F.exists("pairs", lambda p: p["a"] != p["b"])).alias("changed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **items) -> DataFrame:
    """``doc_id``, ``contaminated``, ``n_items``, ``item_ids`` (sorted) for each row."""
    of = matches(docs, benchmark, id_col, text, **items).groupBy("_key", "_th").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col).alias("_key"), text_hash(text).alias("_th"))
    none = F.array().cast(of.schema["item_ids"].dataType)
    out = rows.join(of, ["_key", "_th"], "left").withColumn("item_ids", F.coalesce("item_ids", none))
    return out.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"),
                      F.size("item_ids").cast("long").alias("n_items"), "item_ids")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **items) -> DataFrame:
    """The rows of ``docs`` in which no item was found, with all their columns."""
    bad = stored(docs.sparkSession, matches(docs, benchmark, id_col, text, **items).select("_key", "_th").distinct(),
                 "contaminated")
    rows = packed(docs, _key=row_key(id_col), _th=text_hash(text))
    return unpacked(rows.join(if_small(bad), ["_key", "_th"], "left_anti"))
