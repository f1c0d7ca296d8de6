"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle


def roots(edges: DataFrame, label: str = "components") -> DataFrame:
    """Columns ``node, root`` for every node of ``edges`` (columns ``a, b``): root is the smallest node reachable.

    Each step is a minimum per node and a join with it, both of which a hot
    node passes (partial aggregates; AQE splits the join). Every step is
    written to the shared folder, so a lost executor costs one step. The only
    values that reach the driver are a row count and a check sum per step.
    Null ends are dropped; an empty table gives an empty result.
    """
    linked = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, sign = _stored(linked, label)
    while True:
        current, now = _stored(_small_star(_large_star(current)), label)
        if now == sign:
            break
        sign = now
    # every edge now leads from a node straight to its root
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _stored(edges: DataFrame, label: str):
    edges = settle(edges, label)
    sign = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return edges, tuple(sign)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest neighbour of that node, itself included."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def roots_within(buckets: DataFrame, close, known: DataFrame | None = None, label: str = "components") -> DataFrame:
    """Columns ``node, root`` as if every pair of nodes that share a bucket were looked at by ``close``.

    ``buckets`` has ``bucket, node``, ``close`` keeps of a table ``a, b`` the pairs that are linked, ``known`` has
    edges that are given. First the members of a bucket are compared with one of them, then those that are
    still in different components with each other, so a bucket of copies costs as many pairs as it has members.
    """
    edges = known if known is not None else buckets.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    for star in (True, False):
        of = roots(edges, label)
        tagged = settle(
            buckets.join(of, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root")), f"{label}-tagged"
        )
        mixed = (
            tagged.groupBy("bucket")
            .agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(F.struct("root", "node")).alias("first"))
            .where("lo <> hi")
        )
        if star:
            pairs = tagged.join(mixed, "bucket").where("root <> lo").select(F.col("first.node").alias("a"), F.col("node").alias("b"))
        else:
            left = tagged.join(mixed.select("bucket"), "bucket")
            right = left.select("bucket", F.col("node").alias("b"), F.col("root").alias("b_root"))
            pairs = left.join(right, "bucket").where("root < b_root").select(F.col("node").alias("a"), "b")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = edges.unionByName(settle(close(settle(pairs, f"{label}-pairs")), f"{label}-close"))
    return roots(edges, label)
