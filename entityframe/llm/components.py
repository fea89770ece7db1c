"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from entityframe.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of `edges` (a, b; whole numbers).

    Alternates large-star and small-star steps: every node points its larger, then its
    smaller neighbours at the smallest node it knows, until each component is one star.  The
    number of edges never grows, minima are taken before the shuffle, and each round is
    written to the shared folder.
    """
    now = stage(_oriented(edges.select("a", "b")), "edges")
    seen = _mark(now)
    while seen[0]:
        now = stage(_small_star(_large_star(now)), "edges")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node."""
    pair = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pair.distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.filter("v > u").join(least, "u")
    return _oriented(larger.select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(smaller.unionByName(least.select("a", F.col("m").alias("b"))))
