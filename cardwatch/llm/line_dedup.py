"""Corpus-wide line deduplication by an exact set-similarity join.

A line is the set of its words (split at ASCII white space, A-Z lower-cased, compared
by 64-bit hash).  A line is removed if an earlier one, by document id, then line
number, has a Jaccard similarity of at least 0.8 with it; equal sets have 1.  Lines
without words stay.

1. Rarity.  Tasks count all words into a fixed table of ``SKETCH`` counters, Spark adds
   the tables up.  A word's rank is its counter's logarithm, then its hash: one global
   order, about from rare to frequent.  Any such order gives the exact result; a good
   one gives few candidates.
2. Lines.  Each line becomes a 128-bit hash of its set and its prefix in that order.
   Similarity 0.8 needs a shared word among the first ``n - ceil(0.8 n) + 1``; with one
   more, lines of different sets share two, with three more four.  Equal lines of one slice of text are reduced
   to the first there, then Spark finds the first of each set, so that a set copied a
   million times meets in few rows.  Later ones are removed, the first ones
   (representatives) go on.
3. Join.  Representatives are dealt by prefix word and sorted by it and by size; tasks
   stream over the words' groups and compare their members in numpy, a block of rows with a
   block of columns at a time, under the length filter, a parity filter (bits of a parity
   that differ can't exceed the words that differ; 64 bits of ``sign``, with ``wide`` 128
   for lines of ``WIDE`` words and more, and 42 others) and the positional filter (words
   left after the shared one).  Pairs met under two words go on.  A group of more than ``GROUP`` members, or with more than
   ``PAIRS`` pairs for each, is not paired at once: its members meet its ``STARS``
   earliest, and are set aside.
4. Verify.  The words of the paired lines alone are read again (found through a bitmap
   or, if there are too many for one, by document) and Jaccard is computed on them.
5. Set-aside groups: those members that are still undecided are joined with all of
   their group under the same filters, and verified.  A group is split by a second word of
   its members' prefixes first, and, in the task that holds it, by a third and a fourth
   while it is too large; its pairs are compared there in numpy.  In a large group of near
   copies most are decided by then, so that its pairs are never written out; no pair that
   could decide a line is left out.

Null texts count as empty; repeated rows (same id and text) are one document and lose
the same lines; of rows that share an id but not the text, lines are ordered by number,
then by a hash; a null id comes first.  An empty table gives an empty result.  Extra
columns are kept by ``dedup``; ``n_chars``, if there, is brought up to date.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, if_small, packed, slices, stored, text_hash, text_or_empty, unpacked
from .words import LOWER, Texts, hashes, mix

#: Counters of the rarity table (fixed: 8 MB for each task, 1 MB once ranked).
SKETCH = 1 << 20
#: Sets that a task remembers, each in the place that its hash names (fixed: 7 MB).
SEEN = 1 << 17
_CHUNK = 1 << 13
#: Words that two similar lines of different sets share at least in their prefixes.
SHARED = 2
#: Words of the prefixes kept: similar lines of different sets share as many (at most 4: the smallest such sets
#: have 4 and 5 words).  Groups that are set aside are split by up to so many words.
DEPTH = 4
#: A group under two or three words is split by one more beyond so many members, if it would have at least so many
#: pairs for each row of the split.
FULL = 32
SPLIT = 8
#: A word's group is set aside beyond so many members, or so many pairs for each of them.
GROUP = 1 << 15
PAIRS = 16
STARS = 4
#: A set-aside group under two words is dealt in pieces of about so many members if it has more.
SPREAD = 1 << 14
#: Pairs, or words, that a task looks at in one go.
_MEET = 1 << 18
_GATHER = 1 << 17
#: Groups of more members are compared in blocks of so many rows and columns.
FEW = 32
_BLOCK = (64, 1 << 10)
PARITY_BITS = 42
#: Lines of so many words have 128 bits of ``sign`` and ``wide``, shorter ones the 64 of ``sign``.
WIDE = 64
#: Bits of the bitmaps through which lines are found again: 16 for a line, within these bounds.
_BITS = (1 << 16, 1 << 28)
#: Sizes and places are packed into 12 and 10 bits; the largest values stand for "that or more".
_SIZE_MAX, _PLACE_MAX = (1 << 12) - 1, (1 << 10) - 1
_U = np.uint64


# ------------------------------------------------------------------ words of a batch
class Words:
    """All words of a batch of texts: ``h`` (hash) and, after ``lines()``, ``line`` (running number of the
    line with words); for each such line ``row`` (of the batch) and ``number`` (in its text, from 0)."""

    def __init__(self, texts: pa.Array):
        self._texts = t = Texts(texts)
        self.h = hashes(np.frombuffer(t.text.translate(LOWER), np.uint8), t.start, t.end)

    def lines(self) -> Words:
        t = self._texts
        t.lines()
        self.row, self.number, self.line = t.row, t.number, t.line
        return self

    def sets(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each line's distinct words by level and hash, and where each line begins (with
        the end)."""
        n = len(self.row)
        order = None
        if n < 1 << 23:
            key = self.line << 40 | level.astype(np.int64) << 32 | (self.h >> _U(32)).astype(np.int64)
            order = np.argsort(key)
            h, k = self.h[order], key[order]
            same = k[1:] == k[:-1]
            if (same & (h[1:] != h[:-1])).any():  # half a hash decides the order but for this case
                order = None
        if order is None:
            order = np.lexsort((self.h, level, self.line))
            h, line = self.h[order], self.line[order]
            same = (line[1:] == line[:-1]) & (h[1:] == h[:-1])
        keep = np.r_[True, ~same] if len(h) else np.zeros(0, bool)
        return h[keep], np.searchsorted(self.line[order][keep], np.arange(n + 1))


def _parity(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    bit = (h & _U(0xFFFFFF)) * _U(PARITY_BITS) >> _U(24)
    return np.bitwise_xor.reduceat(_U(1) << bit, begin[:-1]).view(np.int64)


def _signs(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sign`` (a 64-bit parity) and, for long lines, ``wide``: half of a 128-bit one, whose halves make ``sign``."""
    bit, half = _U(1) << (h >> _U(24) & _U(63)), h >> _U(30) & _U(1)
    sign, wide = (np.bitwise_xor.reduceat(x, begin[:-1]) for x in (bit, bit * half))
    return sign.view(np.int64), np.where(np.diff(begin) < WIDE, 0, wide.view(np.int64))


def _spans(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices begin[i], ..., begin[i] + count[i] - 1 for all i."""
    return np.repeat(begin - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())


def _place(d: np.ndarray, f: np.ndarray) -> np.ndarray:
    return mix(mix(d.view(np.uint64) + _U(0x9E3779B97F4A7C15)) ^ f.view(np.uint64))


# ------------------------------------------------------------------ rarity
def word_levels(docs: DataFrame, text: str = "text") -> np.ndarray:
    """A level (0 to 255, eight times the logarithm of its count) for each of the ``SKETCH`` counters
    that words fall into; all words of ``docs`` are counted."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, some = np.zeros(SKETCH, np.int64), []
        for b in slices(batches, "text"):
            some.append((Words(b.column("text")).h % _U(SKETCH)).astype(np.int32))
            if sum(map(len, some)) > 2 * SKETCH:
                table += np.bincount(np.concatenate(some), minlength=SKETCH)
                some = []
        if some:
            table += np.bincount(np.concatenate(some), minlength=SKETCH)
        yield from _chunks(table)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                table = np.zeros(SKETCH, np.int64) if table is None else table
                table[i * _CHUNK:(i + 1) * _CHUNK] += np.frombuffer(raw, np.int64)
        if table is not None:
            yield from _chunks(table)

    schema = "i int, counts binary"
    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, schema)
    added = parts.repartition(8, "i").mapInArrow(add, schema)
    table = np.zeros(SKETCH, np.int64)  # at most SKETCH counters come to the driver
    for i, raw in zip(*added.toArrow().to_pydict().values()):
        table[i * _CHUNK:(i + 1) * _CHUNK] += np.frombuffer(raw, np.int64)
    return np.minimum(255, 8 * np.log2(table + 1)).astype(np.uint8)


def _chunks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    used = [i for i in range(SKETCH // _CHUNK) if table[i * _CHUNK:(i + 1) * _CHUNK].any()]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()),
                                      pa.array([table[i * _CHUNK:(i + 1) * _CHUNK].tobytes() for i in used], pa.binary())],
                                     names=["i", "counts"])


# ------------------------------------------------------------------ sets and representatives
_LINE = "d long, th long, line int, c1 long, c2 long, n int, parity long, sign long, wide long, prefix array<int>"


def _doc_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(_doc_key(id_col).alias("d"), text_hash(text).alias("th"), F.col(text).cast("string").alias("text"))


class _Seen:
    """Sets that a task has met before, and the earliest line of each."""

    def __init__(self):
        self.c1, self.c2, self.d, self.line = (np.zeros(SEEN, np.int64) for _ in range(4))
        self.there, self.often = np.zeros(SEEN, bool), np.zeros(SEEN, bool)
        self.slices = 0

    def earlier(self, c1: np.ndarray, c2: np.ndarray, d: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Which of some different sets' lines have an equal line before them, by document and number."""
        at = (c1.view(np.uint64) % _U(SEEN)).astype(np.int64)
        same = self.there[at] & (self.c1[at] == c1) & (self.c2[at] == c2)
        after = same & ((self.d[at] < d) | ((self.d[at] == d) & (self.line[at] < line)))
        self.slices += 1
        if self.slices % 16 == 0:  # what was often met long ago makes room
            self.often[:] = False
        put = np.flatnonzero((same & ~after) | (~same & ~self.often[at]))
        self.often[at[same]] = True
        for held, new in ((self.c1, c1), (self.c2, c2), (self.d, d), (self.line, line)):
            held[at[put]] = new[put]  # of several for one place, the last in all four
        self.there[at[put]] = True
        return after


def line_sets(docs: DataFrame, levels: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each line with words: document, line, hash of the set, its size, parity and
    prefix; ``n`` is -1 for a line that repeats an earlier one of the same slice."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for b in slices(batches, "text"):
            x = Words(b.column("text")).lines()
            if not len(x.row):
                continue
            h, begin = x.sets(shared.value[(x.h % _U(SKETCH)).astype(np.int64)])
            lo, n = begin[:-1], np.diff(begin)
            c1 = np.add.reduceat(mix(h), lo).view(np.int64)
            c2 = np.add.reduceat(mix(h ^ _U(0xA5A5A5A5A5A5A5A5)), lo).view(np.int64)
            parity, (sign, wide) = _parity(h, begin), _signs(h, begin)
            d, th = (np.asarray(b.column(i))[x.row] for i in (0, 1))
            order = np.lexsort((th, x.number, d, c2, c1))
            same = np.r_[False, (c1[order][1:] == c1[order][:-1]) & (c2[order][1:] == c2[order][:-1])]
            first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            # a line at the very place of the first one is a repeated row, no later line
            here = (d[order] == d[first]) & (x.number[order] == x.number[first])
            keep, gone = order[~same], order[same & ~here]
            known = seen.earlier(c1[keep], c2[keep], d[keep], x.number[keep])
            keep, gone = keep[~known], np.r_[gone, keep[known]]
            size = n[keep]
            length = np.where(size < 4, 0, size - (4 * size + 4) // 5 + DEPTH)
            prefix = (h[_spans(lo[keep], length)] >> _U(16)).astype(np.uint32).view(np.int32)
            prefixes = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(prefix))
            both, none = np.r_[keep, gone], np.zeros(len(gone), np.int64)
            alone = _place(d[gone], th[gone] + x.number[gone]).view(np.int64)  # spreads them over the tasks
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[both]), pa.array(th[both]), pa.array(x.number[both].astype(np.int32)),
                 pa.array(np.r_[c1[keep], alone]), pa.array(np.r_[c2[keep], alone]),
                 pa.array(np.r_[size, np.full(len(gone), -1)].astype(np.int32)),
                 *(pa.array(np.r_[x[keep], none]) for x in (parity, sign, wide)),
                 pa.concat_arrays([prefixes, pa.nulls(len(gone), pa.list_(pa.int32()))])],
                names=["d", "th", "line", "c1", "c2", "n", "parity", "sign", "wide", "prefix"])

    return _rows(docs, id_col, text).mapInArrow(run, _LINE)


def _line_id() -> Column:
    """Line number and half of the parity in one number; with ``d`` it names a representative."""
    return F.shiftleft(F.col("line").cast("long"), 32).bitwiseOR(F.col("parity").bitwiseAND(F.lit(0xFFFFFFFF)))


# ------------------------------------------------------------------ candidates
def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits differ, of numbers that are not negative."""
    return np.bitwise_count(a ^ b).astype(np.int64)


def _wide_bits(s: np.ndarray, w: np.ndarray, s2: np.ndarray, w2: np.ndarray) -> np.ndarray:
    return _bits(w, w2) + _bits(s ^ w, s2 ^ w2)


def _admits(a: tuple, b: tuple) -> np.ndarray:
    """Length, positional and parity filter on rows: packed (key, size, place, parity), line id, sign and wide."""
    (ma, fa, ga, wa), (mb, fb, gb, wb) = a, b
    sa, sb = ma >> 20 & _SIZE_MAX, mb >> 20 & _SIZE_MAX
    pa_, pb = ma >> 10 & _PLACE_MAX, mb >> 10 & _PLACE_MAX
    large = (sa == _SIZE_MAX) | (sb == _SIZE_MAX)
    left = np.minimum(np.where(sa == _SIZE_MAX, 1 << 40, sa - pa_), np.where(sb == _SIZE_MAX, 1 << 40, sb - pb))
    total = sa + sb
    need = (4 * total + 8) // 9
    differ = np.maximum(_bits(ma & 0x3FF, mb & 0x3FF) + _bits(fa & 0xFFFFFFFF, fb & 0xFFFFFFFF),
                        np.where(np.minimum(sa, sb) >= WIDE, _wide_bits(ga, wa, gb, wb), _bits(ga, gb)))
    # sizes beyond the packed range only bound the other one from below
    return ((5 * np.minimum(sa, sb) >= 4 * np.maximum(sa, sb)) & (left + SHARED - 1 >= need)
            & ((differ <= total - 2 * need) | large))


def _blocks(size: np.ndarray, until: np.ndarray, sign: np.ndarray, wide: np.ndarray,
            first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of a group's rows, i one of ``first``, j after i and before ``until[i]``, whose signs may be those of
    similar lines.  As the rows lie by size, the sizes at the end of a block's rows and columns bound the bits that may
    differ."""
    for at in range(0, len(first), _BLOCK[0]):
        rows = first[at:at + _BLOCK[0]]
        stop, long = int(until[rows[-1]]), size[rows[0]] >= WIDE
        for begin in range(int(rows[0]) + 1, stop, _BLOCK[1]):
            cols = slice(begin, min(begin + _BLOCK[1], stop))
            if long:
                differ = np.bitwise_count(wide[rows, None] ^ wide[cols])
                differ += np.bitwise_count((sign[rows] ^ wide[rows])[:, None] ^ (sign[cols] ^ wide[cols]))
            else:
                differ = np.bitwise_count(sign[rows, None] ^ sign[cols])
            most = (size[rows[-1]] + size[cols.stop - 1]) // 9 if size[cols.stop - 1] < _SIZE_MAX else 128
            i, j = np.divmod(np.flatnonzero(differ <= min(most, 128)), cols.stop - begin)
            i, j = rows[i], j + begin
            keep = (i < j) & (j < until[i])
            yield i[keep], j[keep]


def _pair_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by packed (key, size, ...) -> pairs (later, earlier), and the rows of groups that
    are set aside (with ``m``, without an earlier line)."""
    held: list[np.ndarray] | None = None  # rows of the last key so far
    stars: list[np.ndarray] | None = None  # of a group that goes on beyond ``GROUP`` members

    def pairs(d, f, d2, f2):
        swap = (d < d2) | ((d == d2) & (f < f2))
        other = (d != d2) | (f != f2)
        cols = [np.where(swap, a, b)[other] for a, b in ((d2, d), (f2, f), (d, d2), (f, f2))]
        return pa.RecordBatch.from_arrays([pa.nulls(len(cols[0]), pa.int64()), *map(pa.array, cols)], names=["m", "d", "f", "ed", "ef"])

    def admitted(cols, i, j):
        return _admits(*(tuple(cols[c][at] for c in (0, 2, 3, 4)) for at in (i, j)))

    def earliest(cols):
        order = np.lexsort((cols[2], cols[1]))[:STARS]
        return [c[order] for c in cols]

    def aside(cols, stars):
        m, d, f, sign, wide = cols
        none = pa.nulls(len(m), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(d), pa.array(f), none, none], names=["m", "d", "f", "ed", "ef"])
        for sm, sd, sf, *signs in zip(*stars):
            at = np.flatnonzero(_admits((sm, sf, *signs), (m, f, sign, wide)))
            if len(at):
                yield pairs(d[at], f[at], np.full(len(at), sd), np.full(len(at), sf))

    def closed(cols):
        """Groups that are complete."""
        m, d, f, sign, wide = cols
        key, size = m >> 32, m >> 20 & _SIZE_MAX
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        count = np.diff(np.r_[start, len(key)])
        group = np.repeat(np.arange(len(start)), count)
        put_off = count > GROUP
        met = np.zeros(len(start), np.int64)
        left, right = [], []
        # sorted by size: those that are not too long for a member lie next to each other; it may match one of them
        # if the positional filter lets it match one of its own size
        until = np.searchsorted(group << 12 | size, group << 12 | np.minimum(5 * size // 4, _SIZE_MAX), "right")

        def add(i, j):
            ok = np.flatnonzero(admitted(cols, i, j))
            left.append(i[ok])
            right.append(j[ok])
            np.add(met, np.bincount(group[i[ok]], minlength=len(start)), out=met)

        early = (size - (m >> 10 & _PLACE_MAX) + SHARED - 1 >= (8 * size + 8) // 9) | (size == _SIZE_MAX)
        early = np.flatnonzero(early & ~put_off[group] & (until > np.arange(len(key)) + 1))
        few = (count <= FEW)[group[early]]
        at = early[few]
        near = until[at] - at - 1
        for some in _runs(near, _MEET):
            add(np.repeat(at[some], near[some]), _spans(at[some] + 1, near[some]))
        some, held_pairs, many = [], 0, early[~few]
        of = _starts(group[many]).tolist() if len(many) else []
        for begin, end in zip(of, [*of[1:], len(many)]):
            g = int(group[many[begin]])
            most = own = PAIRS * int(count[g])
            for i, j in _blocks(size, until, sign, wide, many[begin:end]):
                if len(i):
                    some.append((i, j))
                    held_pairs, own = held_pairs + len(i), own - len(i)
                if own < 0 or held_pairs > _MEET:
                    add(*map(np.concatenate, zip(*some)))
                    some, held_pairs, own = [], 0, most
                    if met[g] > most:
                        break
        if some:
            add(*map(np.concatenate, zip(*some)))
        put_off |= met > PAIRS * count
        if left:
            i, j = np.concatenate(left), np.concatenate(right)
            fine = np.flatnonzero(~put_off[group[i]])
            for at in range(0, len(fine), _CHUNK * 8):  # small batches, for this worker's and the executor's memory
                a, b = i[fine[at:at + _CHUNK * 8]], j[fine[at:at + _CHUNK * 8]]
                yield pairs(d[a], f[a], d[b], f[b])
        for g in np.flatnonzero(put_off).tolist():
            rows = [c[start[g]:start[g] + count[g]] for c in cols]
            yield from aside(rows, earliest(rows))

    def gathered():
        """Batches of some size, so that numpy works on many groups at once."""
        parts, n = [], 0
        for b in batches:
            columns = [np.asarray(b.column(i)) for i in range(5)]
            parts.append([*columns[:3], *(c.view(np.uint64) for c in columns[3:])])
            n += b.num_rows
            if n >= _GATHER:
                yield [np.concatenate(c) for c in zip(*parts)]
                parts, n = [], 0
        if n:
            yield [np.concatenate(c) for c in zip(*parts)]

    for cols in gathered():
        if stars is not None:
            more = int(np.searchsorted(cols[0] >> 32 != stars[0][0] >> 32, True))
            if more:
                yield from aside([c[:more] for c in cols], stars)
            cols = [c[more:] for c in cols]
            if not len(cols[0]):
                continue
            stars = None
        if held is not None:
            cols = [np.concatenate([a, c]) for a, c in zip(held, cols)]
        last = int(np.searchsorted(cols[0] >> 32 == cols[0][-1] >> 32, True))
        if last:
            yield from closed([c[:last] for c in cols])
        held = [c[last:] for c in cols]
        if len(held[0]) > GROUP:
            stars = earliest(held)
            yield from aside(held, stars)
            held = None
    if held is not None and len(held[0]):
        yield from closed(held)


def _met_under(prefix: str) -> Column:
    """The words of a prefix under which lines meet: any two similar ones share ``SHARED`` of them."""
    return F.slice(prefix, 1, F.greatest(F.size(prefix) - (DEPTH - SHARED), F.lit(0)))


def keyed(reps: DataFrame) -> DataFrame:
    """``m`` (prefix word, size, place and part of the parity in one number), ``d``, ``f``: a row for each
    prefix word of each representative, dealt by the word and sorted by ``m``, with its ``sign`` and ``wide``."""
    rows = reps.select("d", _line_id().alias("f"), "n", "parity", "sign", "wide", F.posexplode(_met_under("prefix")).alias("p", "key"))
    m = F.shiftleft(F.col("key").cast("long"), 32)
    m = m.bitwiseOR(F.shiftleft(F.least(F.col("n"), F.lit(_SIZE_MAX)).cast("long"), 20))
    m = m.bitwiseOR(F.shiftleft(F.least(F.col("p"), F.lit(_PLACE_MAX)).cast("long"), 10))
    m = m.bitwiseOR(F.shiftright("parity", 32))
    rows = rows.select(m.alias("m"), "d", "f", "sign", "wide")
    return rows.repartition(F.shiftright("m", 32)).sortWithinPartitions("m")


def candidates(reps: DataFrame) -> DataFrame:
    """``d``, ``f`` (a representative), ``ed``, ``ef`` (an earlier one that it may match), once for each
    shared prefix word; rows without the latter are members of large groups, with packed ``m``."""
    return keyed(reps).mapInArrow(_pair_groups, "m long, d long, f long, ed long, ef long")


def _runs(count: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of neighbours whose counts add up to about ``most``."""
    run = (np.cumsum(count) - count) // most
    bounds = np.flatnonzero(np.r_[True, run[1:] != run[:-1], True]) if len(run) else []
    yield from map(slice, bounds[:-1], bounds[1:])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])


_MEMBER = ("key", "next", "tile", "piece", "alone", "d", "f", "m", "n", "sign", "wide", "open")


class _Members:
    """Members of some whole groups, a row each, with the different words of their prefixes in one array by row and
    word: ``rw`` (both), ``word``, ``met`` (lines meet under it) and ``aside`` (its group is set aside), from ``begin``
    to ``end`` for a row."""

    def __init__(self, t: pa.Table):
        t = t.combine_chunks()
        one = {c: t.column(c).chunk(0) for c in t.column_names}
        for c in _MEMBER:
            v = one[c].to_numpy(zero_copy_only=False)
            setattr(self, c, v if v.dtype == bool else v.astype(np.int64))
        rows = np.arange(t.num_rows)
        self.parity = ((self.m & 0x3FF) << 32 | self.f & 0xFFFFFFFF).view(np.uint64)
        self.sign, self.wide = self.sign.view(np.uint64), self.wide.view(np.uint64)

        def flat(column):
            length = np.asarray(one[column].value_lengths()).astype(np.int64)
            return length, np.repeat(rows, length) << 32 | np.asarray(one[column].flatten()).astype(np.int64) + (1 << 31)

        self.length, rw = flat("prefix")
        met = _spans(np.zeros_like(self.length), self.length) < np.repeat(self.length - (DEPTH - SHARED), self.length)
        order = np.argsort(rw, kind="stable")
        order = order[_starts(rw[order])]
        self.rw, self.met = rw[order], met[order]
        self.word = (self.rw & 0xFFFFFFFF) - (1 << 31)
        self.aside = np.zeros(len(self.rw), bool)
        self.aside[np.searchsorted(self.rw, flat("keys")[1])] = True
        bounds = np.searchsorted(self.rw, np.r_[rows, len(rows)] << 32)
        self.begin, self.end = bounds[:-1], bounds[1:]
        owner = self.rw >> 32
        self.k0, self.n0 = (np.minimum.reduceat(np.where(x, self.word, 1 << 40), self.begin)
                            for x in (self.aside, self.met & (self.word != self.key[owner])))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[_Members]:
    parts, n, size = [], 0, 0
    for b in batches:
        parts, n, size = [*parts, b], n + b.num_rows, size + b.nbytes
        if n >= _GATHER // 2 or size >= 128 * _GATHER:
            t = pa.Table.from_batches(parts)
            last = int(_starts(*(t.column(c).to_numpy() for c in ("key", "next", "tile")))[-1])
            if last:
                yield _Members(t.slice(0, last))
                parts = t.slice(last).to_batches()
                n, size = t.num_rows - last, sum(p.nbytes for p in parts)
    if n:
        yield _Members(pa.Table.from_batches(parts))


def _split(g: _Members, rows: np.ndarray, group: np.ndarray, more: list[np.ndarray], pos: np.ndarray,
           limits: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Members (``rows``, by group and size), the starts of their groups and the words beside the group's ``key`` and
    ``next``.  A group that is too large goes on by one more of the words that two similar lines share: the least ones
    in order (after the place ``pos``), with enough left after them, if fewer pairs meet so: near copies share most of
    their words, and would meet again under each."""
    level = SHARED + 1 + len(more)
    start = _starts(group)
    count = np.diff(np.r_[start, len(rows)])
    if level > DEPTH:
        yield rows, start, more
        return
    least = more[-1] if more else np.full(len(rows), -1 << 40)
    gone = (g.key[rows] > least).astype(np.int64) + (g.next[rows] > least) + DEPTH - level
    further = np.maximum(g.end[rows] - 1 - pos - gone, 0)
    undecided = np.add.reduceat(g.open[rows].astype(np.int64), start)
    longer = np.add.reduceat(further, start)
    full = (count > limits[0]) & (undecided * count > limits[1] * longer)
    stay = ~np.repeat(full, count)
    if stay.any():
        yield rows[stay], _starts(group[stay]), [w[stay] for w in more]
    full = np.flatnonzero(full)
    for some in _runs(longer[full], _MEET):
        of = _spans(start[full[some]], count[full[some]])
        r = rows[of]
        span = g.end[r] - g.begin[r]
        at, own = _spans(g.begin[r], span), np.repeat(np.arange(len(of)), span)
        rest = (g.word[at] != g.key[r[own]]) & (g.word[at] != g.next[r[own]])
        at, own = at[rest], own[rest]
        left = np.cumsum(np.bincount(own, minlength=len(of)))[own] - np.arange(len(own)) - 1
        on = np.flatnonzero((left >= DEPTH - level) & (g.word[at] > least[of][own]))
        at, own = at[on], own[on]
        # members lie by size already, and a stable order keeps them so
        order = np.argsort(g.word[at], kind="stable")
        order = order[np.argsort(group[of][own[order]], kind="stable")]
        at, own = at[order], own[order]
        parent = np.repeat(np.arange(len(full[some])), count[full[some]])
        after = np.zeros(len(full[some]), np.int64)
        if len(at):
            sub = _starts(group[of][own], g.word[at])
            meet = np.add.reduceat(g.open[r[own]].astype(np.int64), sub) * np.diff(np.r_[sub, len(at)])
            np.add.at(after, parent[own[sub]], meet)
        fewer = after < (undecided * count)[full[some]]
        if not fewer.all():
            stay = of[~fewer[parent]]
            yield rows[stay], _starts(group[stay]), [w[stay] for w in more]
            on = fewer[parent[own]]
            at, own = at[on], own[on]
        if len(at):
            word, before = g.word[at], group[of][own]
            new = np.zeros(len(at), np.int64)
            new[_starts(before, word)] = 1
            yield from _split(g, r[own], np.cumsum(new), [*(w[of][own] for w in more), word], at, limits)


def _member_rows(g: _Members, rows: np.ndarray, start: np.ndarray, more: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    words = np.stack(more, 1).ravel() if more else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(more)), pa.array(words.astype(np.int32)))
    yield pa.RecordBatch.from_arrays([pa.array(g.key[rows]), pa.array(g.next[rows].astype(np.int32)), lists, pa.array(g.d[rows]),
                                      pa.array(g.f[rows])], names=["key", "next", "more", "d", "f"])


def _meet(g: _Members, rows: np.ndarray, start: np.ndarray, more: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Pairs of the open members of groups with earlier members under the length and parity filter (the positional one
    holds for the first ``SHARED`` shared words alone) and the bound by shared words, where they are kept."""
    n, parity = g.n[rows], g.parity[rows]
    count = np.diff(np.r_[start, len(rows)])
    group = np.repeat(np.arange(len(start)), count)
    at = np.flatnonzero(g.open[rows] & (count[group] > 1))
    sizes = group << 32 | n  # members lie by size: those from 4/5 to 5/4 of a member's are neighbours
    low = np.searchsorted(sizes, group[at] << 32 | (4 * n[at] + 4) // 5)
    near = np.searchsorted(sizes, group[at] << 32 | 5 * n[at] // 4, "right") - low
    most = np.minimum((n[at] + 5 * n[at] // 4) // 9, PARITY_BITS).astype(np.uint8)  # bits that may differ
    found = []
    for some in _runs(near, _MEET):
        j = _spans(low[some], near[some])
        differ = np.bitwise_count(np.repeat(parity[at[some]], near[some]) ^ parity[j])
        ok = np.flatnonzero(differ <= np.repeat(most[some], near[some]))
        first = np.repeat(at[some], near[some])[ok]
        a, b = rows[first], rows[j[ok]]
        total = g.n[a] + g.n[b]
        most_bits, long = total - 2 * ((4 * total + 8) // 9), np.minimum(g.n[a], g.n[b]) >= WIDE
        keep = differ[ok] <= most_bits
        keep[long] &= (_wide_bits(g.sign[a], g.wide[a], g.sign[b], g.wide[b]) <= most_bits)[long]
        keep &= (g.d[b] < g.d[a]) | ((g.d[b] == g.d[a]) & (g.f[b] < g.f[a]))
        keep &= g.alone[a] | (g.piece[a] != g.piece[b])
        # two of one least word share that one: told without looking at all words
        keep &= ((g.k0[a] != g.k0[b]) | (g.k0[a] == g.key[a])) & ((g.n0[a] != g.n0[b]) | (g.n0[a] == g.next[a]))
        found.append((a[keep] << 32 | b[keep], first[keep]))
    if not found:
        return
    pairs, of = (np.concatenate(c) for c in zip(*found))
    pairs, first = np.unique(pairs, return_index=True)
    more = [w[of[first]] for w in more]
    words = (g.end - g.begin)[pairs >> 32]
    for some in _runs(words, _MEET):
        a, b = pairs[some] >> 32, pairs[some] & 0xFFFFFFFF
        p, i = np.repeat(np.arange(len(a)), words[some]), _spans(g.begin[a], words[some])
        asked = b[p] << 32 | g.rw[i] & 0xFFFFFFFF
        j = np.minimum(np.searchsorted(g.rw, asked), len(g.rw) - 1)
        hit = g.rw[j] == asked
        p, i, j = p[hit], i[hit], j[hit]
        both, word, key = np.bincount(p, minlength=len(a)), g.word[i], g.key[a[p]]
        # a pair is kept under the least set-aside word that it shares, and the least next to it
        less = (g.aside[i] & g.aside[j] & (word < key)) | (g.met[i] & g.met[j] & (word != key) & (word < g.next[a[p]]))
        if more:  # and under the least ones beside both
            other = (word != key) & (word != g.next[a[p]]) & (word < more[-1][some][p])
            for w in more[:-1]:
                other &= word != w[some][p]
            less |= other
        beyond = np.maximum(g.n[a] - g.length[a], g.n[b] - g.length[b])
        keep = (both >= DEPTH) & (9 * (both + beyond) >= 4 * (g.n[a] + g.n[b])) & (np.bincount(p[less], minlength=len(a)) == 0)
        a, b = a[keep], b[keep]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (g.d[a], g.f[a], g.d[b], g.f[b])], names=["d", "f", "ed", "ef"])


def groups(aside: DataFrame, reps: DataFrame, decided: DataFrame, meet=_member_rows,
           schema: str = "key long, next int, more array<int>, d long, f long") -> DataFrame:
    """A row for each member of set-aside groups (word ``key``) and each further word ``next`` of its prefix, or what
    ``meet`` makes of them.  Groups under both that are too large are split by a third word, and by a fourth, in
    ``more``, in the task that holds them; groups that are too large for a task are dealt in tiles, one for any two
    of their pieces."""
    spark = reps.sparkSession
    aside = aside.select("m", "d", "f", F.shiftright("m", 32).alias("key"))
    keys = stored(spark, aside.groupBy("d", "f").agg(F.collect_set("key").alias("keys")), "line-groups")
    done = if_small(decided.select("d", "f", F.lit(True).alias("done")))
    some = reps.select("d", _line_id().alias("f"), "n", "sign", "wide", "prefix").join(if_small(keys), ["d", "f"]).join(done, ["d", "f"], "left")
    some = some.select("d", "f", "n", "sign", "wide", "prefix", "keys", F.col("done").isNull().alias("open"))
    further = F.array_except(_met_under("prefix"), F.array(F.col("key").cast("int")))
    members = aside.join(some, ["d", "f"]).select("*", F.explode(further).alias("next"))
    # under a further word that is set aside too and comes before this one, no pair would be kept
    members = members.where(~(F.array_contains("keys", F.col("next").cast("long")) & (F.col("next") < F.col("key"))))
    large = F.col("c") > SPREAD
    crowded = aside.groupBy("key").agg(F.count("*").alias("c")).where(large).select("key")
    crowded = stored(spark, crowded, "line-crowded")
    k, piece = F.lit(1), F.lit(0)
    if crowded.limit(1).count():
        sizes = members.join(if_small(crowded), "key", "left_semi").groupBy("key", "next").agg(F.count("*").alias("c")).where(large)
        members = members.join(if_small(stored(spark, sizes, "line-full-groups")), ["key", "next"], "left")
        k = F.coalesce(F.ceil(F.col("c") / SPREAD), F.lit(1)).cast("int")
        piece = F.pmod(F.xxhash64("d", "f"), k).cast("int")
    members = members.withColumns({"k": k, "piece": piece}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    tile = F.least("piece", "other") * F.col("k") + F.greatest("piece", "other")
    members = members.withColumns({"tile": tile, "alone": F.col("piece") == F.col("other")}).select(*_MEMBER, "prefix", "keys")
    limits = FULL, SPLIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _whole_groups(batches):
            new = np.zeros(len(g.d), np.int64)
            new[_starts(g.key, g.next, g.tile)] = 1
            group = np.cumsum(new)
            rows = np.lexsort((g.n, group))
            for part in _split(g, rows, group[rows], [], g.begin[rows] - 1, limits):
                yield from meet(g, *part)

    name = ["key", "next", "tile"]
    return members.repartition(*name).sortWithinPartitions(*name).mapInArrow(run, schema)


def open_pairs(aside: DataFrame, reps: DataFrame, decided: DataFrame) -> DataFrame:
    """``d``, ``f``, ``ed``, ``ef``: the members of set-aside groups that are still undecided, with all earlier
    members that they may match.  As two prefixes share ``SHARED`` words, a group is split by each
    further word of its members' prefixes before they meet, and again while it is too large, as whole prefixes share
    ``DEPTH``; a pair is kept under the least of such words, and the least ones next to it.  The words
    that the prefixes share, and those beyond the prefix that ends first, bound the overlap."""
    return groups(aside, reps, decided, _meet, "d long, f long, ed long, ef long")


# ------------------------------------------------------------------ verification
def _bitmap(ids: DataFrame) -> tuple[np.ndarray, int]:
    """Bits at the places of ``ids`` (d, f), and of their documents."""
    n = ids.count()
    bits = _BITS[0]
    while bits < min(16 * n, _BITS[1]):
        bits *= 2
    shift = 64 - bits.bit_length() + 1

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, f = (np.asarray(b.column(i)) for i in (0, 1))
            at = np.unique(np.r_[_place(d, f), _place(d, np.full_like(d, -1))] >> _U(shift))
            word = at >> _U(6)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
            value = np.bitwise_or.reduceat(_U(1) << (at & _U(63)), first) if len(word) else word
            yield pa.RecordBatch.from_arrays([pa.array(word[first].view(np.int64)), pa.array(value.view(np.int64))], names=["i", "b"])

    table = ids.mapInArrow(places, "i long, b long").groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
    bitmap = np.zeros(bits >> 6, np.int64)  # of bounded size, see _BITS
    bitmap[np.asarray(table.column("i"))] = np.asarray(table.column("b"))
    return bitmap.view(np.uint64), shift


def _there(bits: np.ndarray, shift: int, d: np.ndarray, f: np.ndarray) -> np.ndarray:
    at = _place(d, f) >> _U(shift)
    return (bits[at >> _U(6)] >> (at & _U(63))) & _U(1) > 0


def words_of(docs: DataFrame, ids: DataFrame, id_col: str, text: str) -> DataFrame:
    """``d``, ``f``, ``words`` (hashes) of the lines ``ids``, and of a few others.  Found through a bitmap, or, where
    that would be full, by documents dealt with the list of their own lines asked for."""
    spark = docs.sparkSession
    if 16 * ids.count() > _BITS[1]:
        return _words_by_document(docs, ids, id_col, text)
    bitmap, shift = _bitmap(ids)
    shared = spark.sparkContext.broadcast(bitmap)
    of = stored(spark, ids.select("d").distinct(), "line-documents")
    rows = _rows(docs, id_col, text)
    if of.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # else the bitmap alone tells them apart
        rows = rows.join(F.broadcast(of), "d", "left_semi").select("d", "th", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in slices(batches, "text"):
            d = np.asarray(b.column(0))
            b = b.filter(pa.array(_there(bits, shift, d, np.full_like(d, -1))))
            yield from _wanted_lines(b, lambda row, d, f: _there(bits, shift, d, f))

    return rows.mapInArrow(run, _WORDS)


_WORDS = "d long, f long, words array<long>"


def _wanted_lines(b: pa.RecordBatch, wanted) -> Iterator[pa.RecordBatch]:
    """``d``, ``f`` and the words of a batch's lines that ``wanted`` (of row, d and f) picks."""
    x = Words(b.column("text")).lines() if b.num_rows else None
    if x is None or not len(x.row):
        return
    h, begin = x.sets(np.zeros(len(x.h), np.uint8))
    d = np.asarray(b.column("d"))[x.row]
    f = x.number << 32 | _parity(h, begin) & 0xFFFFFFFF
    take = np.flatnonzero(wanted(x.row, d, f))
    n = np.diff(begin)[take]
    words = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)),
                                     pa.array(h[_spans(begin[take], n)].view(np.int64)))
    yield pa.RecordBatch.from_arrays([pa.array(d[take]), pa.array(f[take]), words], names=["d", "f", "words"])


def _words_by_document(docs: DataFrame, ids: DataFrame, id_col: str, text: str) -> DataFrame:
    """As ``words_of``, for any number of lines.  Rows that share an id share a list as well, so rows without an id,
    of which there may be many, are told through a bitmap of their lines instead."""
    none = -(1 << 63)
    asked = ids.where(F.col("d") != none).groupBy("d").agg(F.collect_list("f").alias("asked"))
    rows = _rows(docs, id_col, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            lists = b.column("asked")
            value, row = np.asarray(lists.flatten()), np.repeat(np.arange(b.num_rows), np.asarray(lists.value_lengths()))
            known, at = np.unique(value, return_inverse=True)
            pairs = row * len(known) + at

            def told(row, d, f):
                at = np.minimum(np.searchsorted(known, f), len(known) - 1)
                return (known[at] == f) & np.isin(row * len(known) + at, pairs)

            yield from _wanted_lines(b, told)

    found = rows.join(asked, "d").select("d", "text", "asked").mapInArrow(run, _WORDS)
    nameless = ids.where(F.col("d") == none)
    if not nameless.limit(1).count():
        return found
    bitmap, shift = _bitmap(nameless)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def through_bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield from _wanted_lines(b, lambda row, d, f: _there(shared.value, shift, d, f))

    return found.unionByName(rows.where(F.col("d") == none).select("d", "text").mapInArrow(through_bitmap, _WORDS))


def matched(docs: DataFrame, pairs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``d``, ``f`` of the lines of ``pairs`` (d, f, ed, ef) that have an earlier line of similarity 0.8
    or more."""
    spark = docs.sparkSession
    pairs = stored(spark, pairs, "line-pairs")
    ids = pairs.select("d", "f").unionByName(pairs.select(F.col("ed").alias("d"), F.col("ef").alias("f"))).distinct()
    words = words_of(docs, stored(spark, ids, "line-ids"), id_col, text).dropDuplicates(["d", "f"])
    a = words.select("d", "f", F.col("words").alias("a"))
    b = words.select(F.col("d").alias("ed"), F.col("f").alias("ef"), F.col("words").alias("b"))
    joined = pairs.select("d", "f", "ed", "ef").join(a, ["d", "f"]).join(b, ["ed", "ef"])
    both = F.size(F.array_intersect("a", "b"))
    return joined.where(5 * both >= 4 * (F.size("a") + F.size("b") - both)).select("d", "f").distinct()


# ------------------------------------------------------------------ operator
def removed_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``d``, ``th`` (text hash), ``lines`` (their numbers, from 0) of each document that loses lines."""
    spark = docs.sparkSession
    lines = line_sets(docs, word_levels(docs, text), id_col, text)
    w = Window.partitionBy("c1", "c2", "n").orderBy("d", "line", "th")
    lines = lines.withColumns({"row": F.row_number().over(w), "fd": F.first("d").over(w), "fl": F.first("line").over(w)})
    gone = (F.col("n") < 0) | (F.col("d") != F.col("fd")) | (F.col("line") != F.col("fl"))
    # rows of one place and set (texts that share an id) stand or fall with the first of them
    lines = lines.select("d", "th", "line", "n", "parity", "sign", "wide", F.when(~gone & (F.col("row") == 1), F.col("prefix")).alias("prefix"),
                         gone.alias("gone"))
    lines = stored(spark, lines, "line-sets")
    reps = lines.where("prefix is not null")

    found = stored(spark, candidates(reps), "line-candidates")
    pairs, aside = found.where("m is null").drop("m"), found.where("m is not null").select("m", "d", "f")
    pairs = pairs.groupBy("d", "f", "ed", "ef").agg(F.count("*").alias("n")).where(F.col("n") >= SHARED).drop("n")
    decided = stored(spark, matched(docs, pairs, id_col, text), "line-decided")
    if aside.limit(1).count():
        decided = decided.unionByName(matched(docs, open_pairs(aside, reps, decided), id_col, text))
    decided = if_small(stored(spark, decided.distinct(), "line-removed"))
    more = lines.where("not gone").withColumn("f", _line_id()).join(decided, ["d", "f"], "left_semi")
    out = lines.where("gone").select("d", "th", "line").unionByName(more.select("d", "th", "line"))
    return out.groupBy("d", "th").agg(F.collect_set("line").alias("lines"))


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removed lines cut out of their texts, as struct ``_row`` of all columns, with
    ``_lines`` (numbers of the removed ones, or null)."""
    spark = docs.sparkSession
    found = stored(spark, removed_lines(docs, id_col, text), "removed-lines")
    bitmap, shift = _bitmap(found.select("d", F.col("th").alias("f")))
    shared = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def touched(d: pa.Array, th: pa.Array) -> pa.Array:
        return pa.array(_there(shared.value, shift, np.asarray(d), np.asarray(th)))

    rows = packed(docs, d=_doc_key(id_col), th=text_hash(text)).withColumn("touched", touched("d", "th"))
    @F.arrow_udf("string")
    def cut(texts: pa.Array, lines: pa.Array) -> pa.Array:
        def one(t, gone):
            if gone is None or t is None:
                return t
            gone = set(gone)
            return "\n".join([x for i, x in enumerate(t.split("\n")) if i not in gone])

        return pa.array([one(t, g) for t, g in zip(texts.to_pylist(), lines.to_pylist())], pa.string())

    # Only documents that lose lines (and a few others) are shuffled.
    hit = rows.where("touched").drop("touched").join(found, ["d", "th"], "left")
    hit = hit.select("_row", F.col("lines").alias("_lines"), cut(F.col("_row")[text], "lines").alias("_text"))
    fields = {c: F.col("_row")[c] for c in docs.columns} | {text: F.col("_text")}
    if "n_chars" in fields and text != "n_chars":
        fields["n_chars"] = F.when(F.col("_lines").isNull(), F.col("_row")["n_chars"]).otherwise(
            F.char_length("_text").cast(docs.schema["n_chars"].dataType))
    hit = hit.select(F.struct(*[v.alias(c) for c, v in fields.items()]).alias("_row"), "_lines")
    return hit.unionByName(rows.where("not touched").select("_row", F.lit(None).cast("array<int>").alias("_lines")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with their columns and without later matching lines."""
    return unpacked(remove_lines(docs, id_col, text))


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (what is left), ``n_removed``, ``removed`` (numbers of the removed lines,
    comma-joined) for each row."""
    rows = remove_lines(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text).alias("text")))
    numbers = F.array_sort(F.coalesce("_lines", F.array().cast("array<int>")))
    return rows.select("_row.doc_id", "_row.text", numbers.alias("numbers")).select(
        "doc_id", "text", F.size("numbers").cast("long").alias("n_removed"),
        F.array_join(F.col("numbers").cast("array<string>"), ",").alias("removed"))
