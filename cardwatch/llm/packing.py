"""Mixture-controlled packing of documents into token sequences.

Each source is a queue of its documents' tokens, one after the other.  Deficit round-robin
serves a queue a quantum of ``QUANTUM`` tokens at a time: the queue whose deficit (its
target share of all that was served, less what it was served itself) is largest comes
next, and what it wasn't served is carried on, over the ends of windows and partitions.
So every run of windows holds the sources in their target shares, to a quantum each, and
documents are cut only where a quantum or a window ends.  When a queue runs dry, its share
goes to the others in proportion.

What is served before any quantum follows from the totals alone (``Mixture.places``), so a
task that holds a stretch of a queue knows where each of its quanta goes without any other
task's work, in a time that doesn't depend on how much was served before.

1. Tasks tokenise whole texts and number the tokens of each source within the
   partition; the token ids are written to the shared folder once.
2. Token counts by source and partition are summed up; running sums over that small
   table give each stretch its place in its queue.
3. Tasks read the ids again and cut documents where quanta and windows end; pieces that
   come to lie next to each other are one.

All windows but the last are full.  The largest ``MAX_QUEUES - 1`` sources and all that
``targets`` names (at most ``MAX_TARGETS``, or it fails) have a queue of their own, others
share one, so the driver holds a bounded number of totals.

Null texts count as empty (one token, the end); null and empty sources are one source.
Repeated rows are packed as often as they occur.  Ties between deficits go to the
earlier queue (larger total, then name).  An empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import if_small, slices, stored

SEQUENCE = 2048
END_ID = 1
MAX_QUEUES = 256
MAX_TARGETS = 4096
#: Tokens that a queue is served at a time: a quarter of a window.
QUANTUM = SEQUENCE // 4
#: Buckets of the sources that share a queue; their places are summed bucket by bucket.
_BUCKETS = 1024
#: Chunks between white space, and pieces of them, that a task remembers before it starts anew.
_REMEMBERED = 600_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# The tokenizer's split into pieces, for the characters below, which lower case, composition
# and its letter classes leave as they are here.
_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_PLAIN = re.compile(r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")


def _byte_letters() -> dict[int, str]:
    """What byte-level tokenizers write for each plain character: a letter for each UTF-8 byte; printable
    bytes for themselves, the others counted up from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {b: chr(b) for b in own}
    letter |= {b: chr(0x100 + i) for i, b in enumerate(x for x in range(256) if x not in letter)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x21, 0x250)}


class TokenIds:
    """Ids of whole texts as bytes (``kind``: numpy type).  The tokenizer's rules never look across white space, so
    the ids of a chunk between spaces are kept and only new chunks are tokenised; a new chunk of plain
    characters is cut into pieces, whose ids are kept as well."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        letters, split = _byte_letters(), json.loads(whole.to_str()).get("pre_tokenizer") or {}
        # the short way holds for tokenizers with these rules alone
        known_rules = [x.get("pattern", {}).get("Regex") for x in split.get("pretokenizers", [])][:1] == [_RULES]
        self.kind = kind = np.dtype("<u2" if whole.get_vocab_size() <= 1 << 16 else "<u4")
        model = whole.model
        written = [i.to_bytes(kind.itemsize, "little") for i in range(whole.get_vocab_size())]

        class Pieces(dict):
            def __missing__(self, piece):
                letters_of = piece if piece.isascii() else piece.translate(letters)
                ids = self[piece] = b"".join([written[t.id] for t in model.tokenize(letters_of)])
                return ids

        pieces = Pieces()

        class Chunks(dict):
            def __missing__(self, chunk):
                plain = chunk.isascii() and chunk.isprintable() or _PLAIN.fullmatch(chunk)
                if known_rules and plain and "<|" not in chunk:
                    ids = b"".join(map(pieces.__getitem__, _PIECE.findall(chunk.lower())))
                else:
                    ids = np.array(whole.encode(chunk, add_special_tokens=False).ids, kind).tobytes()
                self[chunk] = ids
                return ids

        self.chunks, self.pieces = Chunks(), pieces
        self.end = np.array([END_ID], kind).tobytes()

    def __call__(self, text: str | None) -> bytes:
        for memory in (self.chunks, self.pieces):
            if len(memory) > _REMEMBERED:
                memory.clear()
        text = (text or "").replace("\n", " ")
        return b"".join(map(self.chunks.__getitem__, text.split(" "))) + self.end


# Fixed value: the split of the tokenizers that the short way is for.
_RULES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class Mixture:
    """Where the quanta of each queue lie among all tokens.

    Quantum ``j`` of a queue with target share ``g`` falls due at ``(j + 0.5) * quantum / g``;
    quanta are served in the order of that time, then queue, one after the other.  That is
    deficit round-robin: at any time a queue's deficit is its share of the time passed less
    the tokens it was served.
    """

    def __init__(self, totals: list[int], shares: list[float] | None = None, quantum: int = QUANTUM):
        self.totals, self.quantum = np.array(totals, np.int64), quantum
        self.rate = np.array(shares or totals, float) / quantum
        self.quanta = -(-self.totals // quantum)

    def places(self, queue: int, j: np.ndarray) -> np.ndarray:
        """Tokens that are served before quantum ``j`` of ``queue``; exact, by counting the quanta of each
        queue that come before it."""
        out = np.zeros(len(j), np.int64)
        due = (j + 0.5) / self.rate[queue]
        for k, (rate, quanta, total) in enumerate(zip(self.rate, self.quanta, self.totals)):
            if k == queue:
                n = j
            else:
                before = (lambda i: (i + 0.5) / rate <= due) if k < queue else (lambda i: (i + 0.5) / rate < due)
                n = np.clip(np.ceil(due * rate - 0.5), 0, quanta).astype(np.int64)
                for _ in range(2):  # the estimate is one off at most, where times are all but equal
                    n -= (n > 0) & ~before(n - 1)
                    n += (n < quanta) & before(n)
            out += np.minimum(n * self.quantum, total)
        return out


def tokenise(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``part``, ``before`` (tokens of that source earlier in the part), ``n``, ``wide``
    (bytes of an id), ``ids`` (little-endian)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                       F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, seen = TokenIds(path), TaskContext.get().partitionId(), {}
        for b in slices(batches, "text"):
            ids = [ids_of(t) for t in b.column("text").to_pylist()]
            wide = ids_of.kind.itemsize
            n, before = [len(x) // wide for x in ids], []
            for s, x in zip(b.column("source").to_pylist(), n):
                before.append(seen.get(s, 0))
                seen[s] = before[-1] + x
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), pa.array([part] * len(ids), pa.int32()), pa.array(before, pa.int64()),
                 pa.array(n, pa.int64()), pa.array([wide] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                names=["doc_id", "source", "part", "before", "n", "wide", "ids"])

    return rows.mapInArrow(run, f"doc_id {id_type}, source string, part int, before long, n long, wide int, ids binary")


def queue_totals(counts: DataFrame, most: int = MAX_QUEUES, named: Sequence[str] = ()) -> tuple[list[str | None], list[int]]:
    """Names and totals of the queues, largest first: the ``named`` sources and the largest others up to ``most`` - 1;
    the rest share the last, named None.  Brings at most ``most`` and ``named`` rows to the driver."""
    by = counts.groupBy("source").agg(F.sum("n").alias("n"))
    given = F.col("source").isin(list(named))
    top = by.orderBy(F.desc(given), F.desc("n"), "source").limit(max(most - 1, len(named))).collect()
    top = sorted(top, key=lambda r: (-r["n"], r["source"]))
    names, totals = [r["source"] for r in top], [r["n"] for r in top]
    rest = by.agg(F.sum("n").alias("n")).first()["n"]
    rest = (rest or 0) - sum(totals)
    if rest:
        names.append(None)
        totals.append(rest)
    return names, totals


def token_places(counts: DataFrame, names: list[str | None]) -> DataFrame:
    """``source``, ``part``, ``place``: tokens of the queue before those that a partition has of a source.  Sums run over
    the partitions of a source, and for the shared queue over the sources of a bucket and over the buckets."""
    before = lambda by, *order: Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = counts.select("source", "part", F.coalesce(F.sum("n").over(before("source", "part")), F.lit(0)).alias("_own"))
    shared = counts.where(~F.col("source").isin([x for x in names if x is not None])).groupBy("source").agg(F.sum("n").alias("n"))
    shared = shared.withColumn("_b", F.pmod(F.xxhash64("source"), F.lit(_BUCKETS)))
    buckets = shared.groupBy("_b").agg(F.sum("n").alias("n"))  # _BUCKETS rows at most
    buckets = buckets.select("_b", F.coalesce(F.sum("n").over(before(F.lit(0), "_b")), F.lit(0)).alias("_to"))
    shared = shared.select("source", "_b", F.coalesce(F.sum("n").over(before("_b", "source")), F.lit(0)).alias("_in")).join(F.broadcast(buckets), "_b")
    return own.join(shared, "source", "left").select("source", "part", (
        F.col("_own") + F.coalesce(F.col("_in") + F.col("_to"), F.lit(0))).alias("place"))


def pieces_of(queue: np.ndarray, at: np.ndarray, n: np.ndarray, mixture: Mixture, sequence: int) -> tuple[np.ndarray, ...]:
    """Row, tokens of the document before it, length, window and offset of each piece of documents
    whose ``n`` tokens begin at ``at`` of their queues."""
    q = mixture.quantum
    first = at // q
    many = (at + n - 1) // q - first + 1
    row = np.repeat(np.arange(len(at)), many)
    j = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[row]
    since = np.maximum(at[row], j * q)
    size = np.minimum((at + n)[row], (j + 1) * q) - since
    place = np.zeros(len(row), np.int64)
    for k in np.unique(queue):
        mine = np.flatnonzero(queue[row] == k)
        each, which = np.unique(j[mine], return_inverse=True)
        place[mine] = mixture.places(int(k), each)[which]
    place += since - j * q
    # cut at the ends of windows
    parts = (place + size - 1) // sequence - place // sequence + 1
    cut = np.repeat(np.arange(len(row)), parts)
    window = np.arange(len(cut)) - np.repeat(np.cumsum(parts) - parts, parts) + place[cut] // sequence
    begin = np.maximum(place[cut], window * sequence)
    end = np.minimum((place + size)[cut], (window + 1) * sequence)
    start = (since - at[row])[cut] + begin - place[cut]
    row = row[cut]
    # pieces of a document that lie next to each other in a window are one
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1]) | (begin[1:] != end[:-1])
    head = np.flatnonzero(new)
    length = np.add.reduceat(end - begin, head) if len(head) else end
    return row[head], start[head], length, window[head], begin[head] - window[head] * sequence


def pack(docs: DataFrame, targets: Mapping[str, float] | None = None, sequence: int = SEQUENCE, path: str | None = None,
         id_col: str = "doc_id", text: str = "text", source: str = "source", with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``source`` and
    ``ids`` (array<int>; left out without ``with_ids``) of each piece.  ``targets``: share of each source (default: its share of all
    tokens, so that all queues end together)."""
    spark = docs.sparkSession
    path = path or tokenizer_path()
    table = stored(spark, tokenise(docs, path, id_col, text, source), "token-ids")
    counts = stored(spark, table.groupBy("source", "part").agg(F.sum("n").alias("n")), "token-counts")
    if targets and len(targets) > MAX_TARGETS:
        raise ValueError(f"{len(targets)} targets; at most {MAX_TARGETS} sources can have a queue each")
    names, totals = queue_totals(counts, named=tuple(targets or ()))
    number = {s: i for i, s in enumerate(names)}
    shared_queue = len(names) - 1
    shares = None
    if targets:
        least = min(targets.values()) / 1000
        shares = [float(least if s is None else targets.get(s, least)) for s in names]
    rows = table.join(if_small(stored(spark, token_places(counts, names), "token-places")), ["source", "part"])
    rows = rows.select("doc_id", "source", (F.col("place") + F.col("before")).alias("at"), "n", "wide", "ids")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = Mixture(totals, shares, min(QUANTUM, max(1, sequence // 4)))
        for b in slices(batches, "ids"):
            sources, at, n, wide, raw = (b.column(i) for i in (1, 2, 3, 4, 5))
            queue = np.array([number.get(s, shared_queue) for s in sources.to_pylist()], np.int64)
            at, n = (x.to_numpy(zero_copy_only=False) for x in (at, n))
            take, start, length, window, offset = pieces_of(queue, at, n, mixture, sequence)
            ids = [np.frombuffer(x, f"<u{w}").astype("<u4") for x, w in zip(raw.to_pylist(), wide.to_pylist())]
            lists = [ids[r][a:a + k] for r, a, k in zip(take.tolist(), start.tolist(), length.tolist())]
            crc = np.fromiter((zlib.crc32(x) for x in lists), np.int64, len(lists))
            index, cols = pa.array(take, pa.int64()), (start, length, crc, n[take], window, offset)
            arrays = [b.column(0).take(index), b.column(1).take(index), *(pa.array(c, pa.int64()) for c in cols)]
            names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                flat = np.concatenate(lists).astype(np.int32) if lists else np.zeros(0, np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(run, f"doc_id {id_type}, source string, start long, length long, ids_crc32 long, doc_tokens long, "
                                "sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))
