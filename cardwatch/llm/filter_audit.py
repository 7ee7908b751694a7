"""Filter interaction audit: what each filter removes in every order of the filters.

A document's failures are a mask of ``FILTERS``.  With a matrix that has 0 where a mask
fails a filter and infinity elsewhere, and a matrix of each filter's position in each
order (the inverse of the order as a permutation), their product under minimum and
addition is the step at which an order removes a mask's documents.  One such product
for the 32 masks serves all documents: Spark counts documents by part and mask, and each
part's counts are scattered as weights to (order, step).

1. One pass measures each text on its own (words, distinct words, capitals, symbols) and
   takes a SHA-256 of it.
2. Copies: ids, labels and masks are counted by (digest, part, label) on the map side
   first, with the smallest id; the smallest id of each digest decides which rows are
   copies of one with a smaller id.  A text that a third of all rows share is so a few
   rows after the map side.
3. Counts by part and mask, at most 32 rows a part, then the matrices, part by part.

Null texts count as empty and are copies of one another; a null id is larger than none
and no id is larger than it, so such a row is never a copy and makes none.  Null and empty
``lang`` are one part.  A document has a label if any row of ``labels`` gives it; rows that
repeat an id each count.  An empty table gives no parts.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

#: In the order of the mask's bits.
FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COPY = 1 << FILTERS.index("E")

#: Bytes of a text whose words are looked at together.
_PIECE = 1 << 20
_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def _words(raw: bytes) -> tuple[int, int]:
    """Words, and distinct words; whole texts, a piece at a time that ends at white space."""
    if len(raw) <= _PIECE:
        w = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
        return len(w), len(set(w))
    n, seen, at = 0, set(), 0
    while at < len(raw):
        end = min(at + _PIECE, len(raw))
        while end < len(raw) and raw[end] not in _WHITE:
            end += 1
        w = raw[at:end].split()
        n += len(w)
        seen.update(w)
        at = end
    return n, len(seen)


def text_mask(raw: bytes, n_chars: int) -> int:
    """The failures of a text that it shows by itself (all but E)."""
    n, distinct = _words(raw)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return ((n < MIN_WORDS) | (100 * distinct < MIN_DISTINCT_PERCENT * n) << 1 | (100 * capitals > MAX_CAPITALS_PERCENT * n_chars) << 2
            | (len(raw) != len(raw.translate(None, SYMBOLS))) << 3)


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part``, ``mask``, and the documents that have both: all (``n``), good and toxic ones."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.col(text).cast("string").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            digest, mask = [], []
            for t in b.column("text").to_pylist():
                raw = (t or "").encode("utf-8", "surrogatepass")
                digest.append(hashlib.sha256(raw).digest())
                mask.append(text_mask(raw, len(t or "")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(digest, pa.binary()), pa.array(mask, pa.int32())],
                                             names=["doc_id", "part", "digest", "mask"])

    own = rows.mapInArrow(measure, f"doc_id {kind}, part string, digest binary, mask int")
    # rows that repeat an id and a text are one row with a count, so that the smallest id's rows can be told
    own = own.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    says = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    own = own.join(says, "doc_id", "left").select("doc_id", "part", "digest", "mask", "n", *[
        F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    groups = own.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    least = F.min("first").over(Window.partitionBy("digest"))  # a few rows a text: its parts and labels
    groups = groups.withColumn("single", F.when(F.col("first") == least, F.col("n_first")).otherwise(0) + F.col("n_null"))
    halves = F.array(F.struct(F.col("mask"), F.col("single").alias("n")),
                     F.struct((F.col("mask") + COPY).alias("mask"), (F.col("n") - F.col("single")).alias("n")))
    counted = groups.select("part", "good", "toxic", F.inline(halves)).where("n > 0")
    yes = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), yes("good"), yes("toxic"))


def removal_steps(filters: str = FILTERS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The orders, each filter's position in each of them (filter x order), and the step (from 0) at which
    each mask goes (mask x order; the number of filters: it stays)."""
    k = len(filters)
    orders = np.array(list(permutations(range(k))))
    position = np.argsort(orders, axis=1).T
    fails = np.arange(1 << k)[:, None] >> np.arange(k) & 1
    cost = np.where(fails, 0, k)  # k stands for infinity
    step = np.minimum((cost[:, :, None] + position[None]).min(axis=1), k)
    return ["".join(filters[i] for i in o) for o in orders], position, step


_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def interactions(weights: np.ndarray, filters: str = FILTERS) -> tuple[list[str], dict[str, np.ndarray]]:
    """Counts of one part by order and step; ``weights`` is 3 x masks: documents, good and toxic ones."""
    k = len(filters)
    names, position, step = removal_steps(filters)
    n_orders = len(names)
    cell = (np.arange(n_orders)[None] * (k + 1) + step).ravel()  # (order, step) of each mask

    def scattered(w: np.ndarray) -> np.ndarray:  # whole numbers, so no bincount with its doubles
        out = np.zeros(n_orders * (k + 1), np.int64)
        np.add.at(out, cell, np.repeat(w, n_orders))
        return out.reshape(n_orders, k + 1)[:, :k]

    removed = scattered(weights[0])
    at = np.argsort(position, axis=0).T  # the filter of each order's steps
    fails = np.arange(1 << k)[:, None] >> np.arange(k) & 1
    failing = (weights[0][:, None] * fails).sum(axis=0)
    shapley = np.zeros(k, np.int64)
    np.add.at(shapley, at.ravel(), removed.ravel())
    return names, {"kept": weights[0].sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": failing[at] - removed,
                   "unique_fails": weights[0][1 << at], "good_lost": scattered(weights[1]), "toxic_lost": scattered(weights[2]),
                   "shapley": shapley[at]}


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """A row per part, order and step."""
    size = 1 << len(FILTERS)
    cells = F.collect_list(F.struct("mask", "n", "good", "toxic"))  # at most 32 in a part
    parts = masks(docs, labels, id_col, text, part).groupBy("part").agg(cells.alias("cells"))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                w = np.zeros((3, size), np.int64)
                for c in r["cells"]:
                    w[:, c["mask"]] = c["n"], c["good"], c["toxic"]
                names, counts = interactions(w)
                k = len(FILTERS)
                cols = [pa.array([r["part"]] * len(names) * k), pa.array(np.repeat(names, k).tolist()),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(names)))]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(counts[c].ravel()) for c in _COLUMNS],
                                                 names=["part", "filter_order", "step", *_COLUMNS])

    return parts.mapInArrow(report, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COLUMNS))
