"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import one_row, staged, unstage


def _print(edges: DataFrame) -> tuple:
    return tuple(one_row(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))))


def _least(edges: DataFrame, name: str) -> DataFrame:
    """Smallest neighbour per node.  Written out, so that the join with the links has a plain
    exchange on both sides and a hub's links can be split between tasks."""
    return staged(edges.groupBy("u").agg(F.min("v").alias("m")), name)


def components(links: DataFrame) -> DataFrame:
    """``links``: long columns a, b.  Returns (node, component): every linked node with the
    smallest node that it reaches.

    Each round hangs larger neighbours on the smallest one (large star), then smaller neighbours
    on the smallest (small star); rounds repeat until the links stay the same, which takes a
    logarithmic number of them.  Links stay in Spark tables; the driver sees a count and a hash
    sum.  Null ends and self links are dropped; no links give an empty table.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("a is not null and b is not null and a <> b").distinct(), "links")
    seen = _print(edges)
    while seen[0]:
        both = edges.union(edges.select("v", "u"))
        least = _least(both, "large")
        large = staged(both.where("v > u").join(least, "u")
                       .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "links")
        least2 = _least(large, "small")
        pairs = large.join(least2, "u")
        small = staged(pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .union(least2.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _print(small)
        for old in (edges, least, large, least2):
            unstage(old)
        edges = small
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
