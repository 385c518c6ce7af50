"""Connected components by alternating large-star and small-star rounds over an edge table.

Every round groups and joins edges; no neighbourhood is collected, so a node with very many neighbours only makes
its join key large, which adaptive execution splits.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (a, b) with a > b."""
    if large:  # neighbours in both directions; larger ones move to the smallest
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # smaller neighbours and the node itself move to the smallest
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
    return moved.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, comp) for each node of ``edges`` (a, b); comp is the smallest node reached.  Self edges and repeats are harmless."""
    now = scratch.write(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-0"
    )
    mark = _mark(now)
    for i in count(1):  # each round that changes anything brings nodes nearer to their smallest one, so it settles
        after = scratch.write(_star(_star(now, large=True), large=False), f"{label}-{i}")
        scratch.drop(f"{label}-{i - 1}")
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
            )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
