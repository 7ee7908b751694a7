"""SimHash near-duplicates by Golay-code fuzzy hashing.

1. Each text gets a 64-bit fingerprint of its word shingles (Python inside Spark
   tasks, whole texts).  Distinct fingerprints go on; copies stay behind.
2. Every distinct fingerprint gives keys (``golay``): six home keys, and probe keys
   of the codewords near its segments.  Two fingerprints within four bits always
   share a probe key of the smaller and a home key of the larger.
3. Members of a home key within four bits of its smallest member are linked to it,
   which contracts large clusters of near copies at a cost in proportion to the keys.
4. Probe and home keys are joined, verified by the bit distance inside the join, and
   only links between different clusters of step 3 are kept.  Where one cluster
   holds several members of a home key, its own members do not meet each other: such
   a key is dealt in two, its main cluster and the rest, and members of the main
   cluster meet the rest alone.  No pair between different clusters is left out.
5. Components of all links, then the smallest ``doc_id`` of each.

Null texts count as empty; a text without words has fingerprint zero and is linked
like any other.  A null ``doc_id`` gets its component but names one only if the
component has no other.  Repeated rows give a row each.  An empty table gives an
empty result.  Extra columns are ignored by ``near_duplicates`` and kept by
``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golay
from .common import ensure_checkpoint_dir, if_small, packed, row_key, slices, stored, text_hash, unpacked
from .components import components

SHINGLE = 4
SEED = 42
MAX_BITS = golay.MAX_ERRORS
#: Home rows of one cluster in a key from which the key is dealt in two.
_MAIN_CLUSTER = 4


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_digest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest = xxhash.xxh64_digest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(),
                                                            ends[shingle - 1:].tolist())]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.frombuffer(b"".join(hashes[at:at + 8192]), np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``th`` (hash of the text), ``fp`` for each row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_hash(text).alias("th"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fp, pa.int64())],
                                             names=["doc_id", "th", "fp"])

    return rows.mapInArrow(run, f"doc_id {id_type}, th long, fp long")


def _keys(fps: DataFrame, keys_of) -> DataFrame:
    """``key`` beside the columns of ``fps`` (fp, and label if there is one)."""
    names = fps.columns
    # a fingerprint gives about 90 rows: as many tasks as shuffles have, not as few as so few bytes need
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                cols = [np.asarray(b.column(i)) for i in range(len(names))]
                rows, keys = keys_of(cols[0])
                yield pa.RecordBatch.from_arrays([*(pa.array(c[rows], pa.int64()) for c in cols), pa.array(keys, pa.int64())],
                                                 names=[*names, "key"])

    return fps.mapInArrow(run, ", ".join(f"{n} long" for n in (*names, "key")))


def _near(a: str, b: str, most: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= most


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links between distinct fingerprints (column ``fp``) that connect exactly what
    lies within ``max_bits`` of each other, step by step; ``a``, ``b``."""
    if max_bits > golay.MAX_ERRORS:
        raise ValueError(f"the segments' keys meet up to {golay.MAX_ERRORS} differing bits")
    ensure_checkpoint_dir(fps.sparkSession)
    home = _keys(fps, golay.home_keys)
    least = home.groupBy("key").agg(F.min("fp").alias("first"), F.count("*").alias("n")).where("n > 1")
    stars = (home.join(least, "key").where(F.col("fp") != F.col("first")).where(_near("fp", "first", max_bits))
             .select(F.col("fp").alias("a"), F.col("first").alias("b")).distinct().checkpoint())
    clusters = components(stars, "a", "b").checkpoint()
    labelled = fps.join(clusters, fps.fp == clusters.node, "left").select(
        "fp", F.coalesce("component", "fp").alias("label")).checkpoint()

    home = _keys(labelled, golay.home_keys)
    main = (home.groupBy("key", "label").agg(F.count("*").alias("n")).where(F.col("n") >= _MAIN_CLUSTER)
            .groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main")).checkpoint())
    main = if_small(main)
    # side 1 holds a key's main cluster, side 0 the rest (and everything of other keys)
    home = home.join(main, "key", "left").select(
        "key", F.when(F.col("label") == F.col("main"), 1).otherwise(0).alias("side"), F.col("fp").alias("b"),
        F.col("label").alias("b_label"))
    probe = _keys(labelled, golay.probe_keys).join(main, "key", "left")
    sides = (F.when(F.col("main").isNull() | (F.col("label") == F.col("main")), F.array(F.lit(0)))
             .otherwise(F.array(F.lit(0), F.lit(1))))
    probe = probe.select("key", F.explode(sides).alias("side"), F.col("fp").alias("a"), F.col("label").alias("a_label"))
    met = (F.col("a_label") != F.col("b_label")) & _near("a", "b", max_bits)
    cross = probe.join(home, (probe.key == home.key) & (probe.side == home.side) & met).select(
        F.col("a_label").alias("a"), F.col("b_label").alias("b"))
    return stars.unionByName(cross.distinct())


def _groups(fp: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, ``first`` (smallest ``doc_id`` with it), ``cluster`` and ``component_id`` for each fingerprint."""
    least = fp.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    comp = components(links(least.select("fp"), max_bits), "a", "b")
    named = least.join(comp, least.fp == comp.node, "left").select(
        least.fp.alias("fp"), F.coalesce("component", least.fp).alias("component"), "first")
    linked = named.where(F.col("component") != F.col("fp")).select("component").distinct()
    # Only components of several fingerprints need their smallest document looked up.
    several = named.join(linked, "component", "left_semi").checkpoint()
    of = several.groupBy("component").agg(F.min("first").alias("component_id"))
    of = several.join(of, "component")
    of = of.select("fp", "component", "component_id")
    return least.join(of, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("cluster"),
                                               F.coalesce("component_id", "first").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``th`` (hash of the text), ``fp`` (long), ``cluster`` (smallest linked
    fingerprint) and ``component_id`` for each row."""
    ensure_checkpoint_dir(docs.sparkSession)
    fp = fingerprints(docs, shingle, id_col, text).checkpoint()
    groups = _groups(fp, max_bits).drop("first")
    return fp.join(groups, "fp", "left").select("doc_id", "th", "fp", "cluster", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
               id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document names its group, one of each group, with all
    their columns.  Repeated rows of that document are one; a group without any
    ``doc_id`` keeps one row of it.

    Which documents stay is told by the groups' smallest ids, so rows of a fingerprint that
    many share don't meet in a join on it; whole rows are joined once, with the keys of those
    that stay, and only rows that repeat a key are brought together."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    fp = fingerprints(docs, shingle, id_col, text).checkpoint()
    names = _groups(fp, max_bits).where(F.col("first").eqNullSafe(F.col("component_id"))).select(
        F.col("fp").alias("of"), F.col("first").alias("name"), "cluster")
    found = fp.join(names, (fp.fp == F.col("of")) & fp.doc_id.eqNullSafe(F.col("name")))
    found = found.groupBy("cluster", "doc_id", "th").agg(F.count("*").alias("n"))
    keep = found.groupBy("cluster").agg(F.min_by(F.struct("doc_id", "n"), "th").alias("one"), F.min("th").alias("_th"))
    keep = keep.select(row_key("one.doc_id").alias("_key"), "_th", (F.col("one.n") > 1).alias("many"))
    keep = stored(spark, keep.groupBy("_key", "_th").agg(F.max("many").alias("many")), "kept-documents")
    rows = packed(docs, _key=row_key(id_col), _th=text_hash(text))
    out = unpacked(rows.join(if_small(keep.where("not many")), ["_key", "_th"], "left_semi"))
    many = keep.where("many")
    if many.limit(1).count():
        repeated = rows.join(if_small(many), ["_key", "_th"], "left_semi")
        out = out.unionByName(unpacked(repeated.groupBy("_key", "_th").agg(F.first("_row").alias("_row"))))
    return out
