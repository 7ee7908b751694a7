"""Importance resampling towards a target distribution.

Features are runs of one to ``RUN`` consecutive words, each hashed (CRC-32) into one of
``BUCKETS`` buckets.  A bucket's gain is the smoothed log ratio of its share in the
target to its share in the corpus; a document's weight is the mean gain of its features,
and its score adds Gumbel noise drawn from a hash of its id, so that the highest scores
are a sample without replacement in proportion to the weights.

1. One pass over each table counts its buckets in arrays, added up by Spark.
2. A second pass gathers each document's gains from one array (``BUCKETS`` numbers, sent
   with the tasks); the scores are written to the shared folder once.
3. The cutoff key is found by weighted median-of-medians selection.  Each round is one
   job: every task returns the medians of its keys (of at most ``GROUP`` at a time) below
   and above the pivot with their numbers; the driver takes the side that holds the
   cutoff and the median of its medians, weighted by their numbers, as the next pivot.
   Half of the groups have a median on either side of it, so a quarter of the keys goes
   each round.  When few enough are left, the keys that remain are written anew.
4. The keys up to the cutoff are range-partitioned, sorted and numbered.

The driver holds one row per group of keys and never the keys.  Keys are (score, id, hash
of the text, place in the stored table), all different, so the number drawn is exact.

Null texts have no features, weight 0, and can't be drawn, as they have too few words.
Ties go to the smaller id, then to the text's hash; rows that repeat both are drawn one by
one.  A null id comes after all others, and its noise is that of the text ``null``.
An empty corpus gives an empty result, an empty target gains by smoothing alone.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored, text_hash
from .words import LOWER, Texts

RUN = 2
BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 25
SEED = 7
#: Keys of a task whose median is taken at a time, and keys that the last round sorts.
GROUP = 1 << 20
FEW = 1 << 12

IS_WORD = bytes(1 if 48 <= i < 58 or 65 <= i < 91 or 97 <= i < 123 or i >= 128 else 0 for i in range(256))
#: Words up to this length are hashed together byte by byte, longer ones on their own.
LONG = 48


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


_TABLE = _crc_table()


def _goes_on(state: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of a byte string, continued over the words; ``state`` holds the sums so far."""
    size = end - start
    state = state.copy()
    for i in np.flatnonzero(size > LONG):
        state[i] = zlib.crc32(raw[start[i]:end[i]], int(state[i]))
    todo = np.flatnonzero(size <= LONG)
    todo = todo[np.argsort(-size[todo], kind="stable")]  # the longest first: each round works on a front part
    left, at, c = size[todo], start[todo], ~state[todo]
    n = len(todo)
    for k in range(int(left[0]) if n else 0):
        n = int(np.searchsorted(-left[:n], -k, "left"))
        c[:n] = _TABLE[(c[:n] ^ raw[at[:n] + k]) & 0xFF] ^ c[:n] >> 8
    state[todo] = ~c
    return state


def features(texts: pa.Array, run: int = RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each feature, its row, and the number of words of each row."""
    t = Texts(texts, IS_WORD)
    low = np.frombuffer(t.text.translate(LOWER), np.uint8)
    row = np.searchsorted(t.offsets, t.start, "right") - 1
    found, rows = [], []
    state = np.zeros(len(t.start), np.uint32)
    for k in range(run):
        n = len(t.start) - k
        if n <= 0:
            break
        if k:  # one word more, after a space
            state = ~state[:n]
            state = ~(_TABLE[(state ^ 0x20) & 0xFF] ^ state >> 8)
        state = _goes_on(state, low, t.start[k:], t.end[k:])
        inside = row[:n] == row[k:]
        found.append(state[inside].astype(np.int64) % buckets)
        rows.append(row[:n][inside])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    return np.concatenate(found), np.concatenate(rows), np.bincount(row, minlength=len(texts))


def bucket_counts(table: DataFrame, text: str = "text", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and its number ``n`` of features over all rows; buckets without any are left out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in slices(batches, "text"):
            total += np.bincount(features(b.column("text"), run, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = table.select(F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _array(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ((t + 1) / (T + B) : (s + 1) / (S + B))) for each bucket."""
    b, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    x = (target + 1).astype(float) * float(s + b) / ((corpus + 1).astype(float) * float(t + b))
    return np.array([math.floor(1000 * math.log(v)) for v in x], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text: str = "text", run: int = RUN) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every row, and ``_hash`` of its text."""
    kind, buckets = docs.schema[id_col].dataType.simpleString(), len(gain)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"), text_hash(text).alias("_hash"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            bucket, row, words = features(b.column("text"), run, buckets)
            n = np.bincount(row, minlength=b.num_rows)
            order = np.argsort(row, kind="stable")
            total = np.r_[0, np.cumsum(gain[bucket[order]])][np.r_[0, np.cumsum(n)]]
            weight = np.diff(total) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words), pa.array(n), pa.array(weight), b.column("_hash")],
                                             names=["doc_id", "n_words", "n_features", "weight", "_hash"])

    return rows.mapInArrow(score, f"doc_id {kind}, n_words long, n_features long, weight long, _hash long")


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` with ``score``: the weight plus Gumbel noise from a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


# ------------------------------------------------------------------ selection
KEY = ("_a", "_b", "_c", "_d")
_KEY_TYPE = ", ".join(f"{k} long" for k in KEY)


def _below(keys: list[np.ndarray], pivot: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Which keys come before ``pivot``, and which are equal to it."""
    less, same = np.zeros(len(keys[0]), bool), np.ones(len(keys[0]), bool)
    for k, p in zip(keys, pivot):
        less |= same & (k < p)
        same &= k == p
    return less, same


def _median(keys: list[np.ndarray]) -> tuple[list[int], int]:
    """The lower median of keys, and their number."""
    n = len(keys[0])
    at = np.lexsort(keys[::-1])[(n - 1) // 2]
    return [int(k[at]) for k in keys], n


def _round(keys: DataFrame, pivot: tuple | None) -> list:
    """(side, median, number) of each group of keys below (-1) and above (1) the pivot, and the
    number equal to it (0).  One row per group of a task, at most ``GROUP`` keys each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {-1: [], 1: []}
        size, equal, out = {-1: 0, 1: 0}, 0, []

        def close(side: int) -> None:
            if size[side]:
                m, n = _median([np.concatenate(x) for x in zip(*held[side])])
                out.append((side, *m, n))
                held[side], size[side] = [], 0

        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            less, same = _below(cols, pivot) if pivot else (np.zeros(b.num_rows, bool), np.zeros(b.num_rows, bool))
            equal += int(same.sum())
            for side, take in ((-1, less), (1, ~less & ~same)):
                if take.any():
                    held[side].append([c[take] for c in cols])
                    size[side] += int(take.sum())
                    if size[side] >= GROUP:
                        close(side)
        close(-1)
        close(1)
        if equal:
            out.append((0, *pivot, equal))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 6,
                                         names=["side", *KEY, "n"])

    return keys.mapInArrow(run, f"side long, {_KEY_TYPE}, n long").collect()  # a row per group of keys


def _weighted_median(groups: list[tuple[tuple, int]]) -> tuple:
    """The first median up to which half of all keys are in groups."""
    half, seen = (sum(n for _, n in groups) + 1) // 2, 0
    for m, n in sorted(groups):
        seen += n
        if seen >= half:
            return m
    raise ValueError("no keys")


def cutoff(spark: SparkSession, keys: DataFrame, rank: int) -> tuple | None:
    """The key that ``rank`` keys don't exceed, exactly; None if no key is asked for.  ``keys`` is
    stored and has the columns ``KEY``, each a long without nulls, all rows different."""
    if rank <= 0:
        return None
    everything = keys = keys.select(*KEY)
    scanned = left = None
    pivot, low, high, before = None, None, None, 0  # ``before``: keys up to ``low``
    while True:
        got = _round(keys, pivot)
        by = {side: [(tuple(r[k] for k in KEY), r["n"]) for r in got if r["side"] == side] for side in (-1, 0, 1)}
        n = {side: sum(x for _, x in groups) for side, groups in by.items()}
        if pivot is None:
            if rank > n[1]:
                raise ValueError(f"{rank} keys are asked for, {n[1]} are there")
            side, scanned = 1, n[1]
        elif rank <= before + n[-1]:
            side, high = -1, pivot
        elif rank <= before + n[-1] + n[0]:
            return pivot
        else:
            side, low, before = 1, pivot, before + n[-1] + n[0]
        left = n[side]
        pivot = _weighted_median(by[side])
        keys = _between(keys, low, high)
        if left <= FEW:
            rest = sorted(tuple(r) for r in keys.collect())  # at most FEW keys
            return rest[rank - before - 1]
        if left * 8 <= scanned:  # what is left is written anew, so that rounds read less and less
            keys, scanned = stored(spark, _between(everything, low, high), "selection"), left
            everything = keys


def _compare(key: tuple, op: str) -> str:
    """SQL that compares the key columns with ``key`` in order."""
    out = f"{KEY[-1]} {op} {key[-1]}"
    for k, v in list(zip(KEY, key))[-2::-1]:
        out = f"({k} {op[0]} {v} OR ({k} = {v} AND ({out})))"
    return out


def _between(keys: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
    if low is not None:
        keys = keys.where(f"_a >= {low[0]} AND " + _compare(low, ">"))
    if high is not None:
        keys = keys.where(f"_a <= {high[0]} AND " + _compare(high, "<"))
    return keys


def numbered(spark: SparkSession, rows: DataFrame, name: str = "rank") -> DataFrame:
    """``rows`` with their place, from 1, in the order of ``KEY``.  Range partitions are sorted on their
    own; a row per partition says how many rows are before it."""
    columns = rows.columns
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = rows.repartitionByRange(n, *KEY).sortWithinPartitions(*KEY)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            size = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(size, part, np.int64)), pa.array(np.arange(at, at + size))],
                                             names=[*columns, "_part", "_at"])
            at += size

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    sorted_rows = stored(spark, spread.mapInArrow(number, f"{kinds}, _part long, _at long"), "winners")
    sizes = {r["_part"]: r["n"] for r in sorted_rows.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # a row per partition
    starts, total = [], 0
    for p in sorted(sizes):
        starts.append((p, total))
        total += sizes[p]
    start = F.broadcast(spark.createDataFrame(starts, "_part long, _start long"))  # a row per partition
    return sorted_rows.join(start, "_part").select(*columns, (F.col("_start") + F.col("_at") + 1).alias(name))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, run: int = RUN,
             buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn) of every row.
    ``percent`` of the documents with ``min_words`` words or more are drawn."""
    spark = docs.sparkSession
    gain = gains(_array(bucket_counts(docs, text, run, buckets), buckets), _array(bucket_counts(target, target_text, run, buckets), buckets))
    rows = with_score(weighted(docs, gain, id_col, text, run), seed)
    last = F.lit(2**63 - 1)
    rows = stored(spark, rows.select(
        "doc_id", "n_words", "n_features", "weight", "score", (-F.col("score")).alias("_a"),
        F.coalesce(F.col("doc_id").cast("long"), last).alias("_b"), F.col("_hash").alias("_c"),
        F.monotonically_increasing_id().alias("_d")), "scores")
    able = rows.where(F.col("n_words") >= min_words)
    end = cutoff(spark, able, able.count() * percent // 100)
    out = ["doc_id", "n_features", "weight", "score"]
    if end is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    upto = F.expr(f"n_words >= {min_words} AND {_compare(end, '<=')}")
    drawn = numbered(spark, able.where(_compare(end, "<=")).select(*out, *KEY))
    return drawn.select(*out, "rank").unionByName(rows.where(~upto).select(*out, F.lit(None).cast("long").alias("rank")))
