"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.session import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` (a, b) is connected with.

    Every step is a grouped minimum and a join, written to the shared folder; nothing is
    collected but the number of changes. Nodes without an edge have no row.
    """
    pairs = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
    current = staged(pairs.filter("a <> b").distinct(), "edges")
    mark = _mark(current)
    while mark[0]:
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(low, "a")
        small = near.select("a", F.col("m").alias("b")).unionByName(
            near.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        current = staged(small.distinct(), "edges")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free digest of an edge table: equal when a step changed nothing."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())
