"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """node, root of every node of ``links`` (a, b: bigint); root is the smallest node that it reaches.

    Alternates two steps until neither changes a link: every node hands its larger neighbours to the smallest of its
    neighbourhood, then every node hands itself and its smaller neighbours to the smallest one. The rounds grow with
    the logarithm of the longest chain. Each round is kept in the checkpoint folder, minima are combined before the
    shuffle, and the join against them is one that Spark can split where a node is hot. Loops and repeated links are
    ignored; an empty table has no nodes.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(ordered)
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = cut(_small_star(_large_star(edges)))
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("b", "b"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
