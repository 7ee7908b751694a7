"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir


def _fingerprint(links: DataFrame):
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``links``.

    Alternates two steps until the links no longer change: every node hands its
    larger neighbours to the smallest one it knows (large star), then its smaller
    neighbours (small star).  Both are an aggregate and a join on the node, so a hub
    is pre-aggregated and AQE splits its rows; the number of rounds grows with the
    logarithm of the longest chain.  Each round is checkpointed to the shared folder.
    Null nodes and links of a node with itself are ignored.
    """
    ensure_checkpoint_dir(links.sparkSession)
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = _fingerprint(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        e = small.checkpoint()
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    return (e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
            .groupBy("node").agg(F.min("component").alias("component")))
