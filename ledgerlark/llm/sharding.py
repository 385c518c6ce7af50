"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2**RING_BITS cells.  Every shard owns ``vnodes`` points on it; a cell belongs to the first point
at or after it.  A shard takes its own keys in ring order up to its capacity; keys beyond that continue
clockwise to the next shard with room.  With ``epsilon`` 0 the capacities add up to the number of rows, so the
shards' counts are at most one apart.

What is placed are counts per cell (at most 2**RING_BITS numbers, whatever the input), which is all that
reaches the driver.  Each row then finds its place from its rank within its cell.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch

RING_BITS = 14
VNODES = 64
#: Copies of one row that a task writes at a time.
PORTION = 10_000


def ring_points(n_shards: int, vnodes: int = VNODES) -> list[tuple[int, int, int]]:
    """Sorted (cell, tie break, shard); one more shard only adds points."""
    points = []
    for shard in range(n_shards):
        for v in range(vnodes):
            h = int.from_bytes(hashlib.md5(f"shard {shard} point {v}".encode()).digest()[:8], "big")
            points.append((h >> (64 - RING_BITS), h, shard))
    return sorted(points)


def place(cell_counts: dict[int, int], n_shards: int, epsilon: float = 0.0, vnodes: int = VNODES) -> list[tuple[int, int, int, int, int]]:
    """Portions (cell, lo, hi, shard, base): rows of rank lo..hi-1 of the cell take slots base.. of the shard."""
    total = sum(cell_counts.values())
    if epsilon > 0:
        room = [-int(-total * (1 + epsilon) // n_shards)] * n_shards
    else:
        room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    points = ring_points(n_shards, vnodes)
    cells_of_points = [p[0] for p in points]
    used = [0] * n_shards
    portions, left = [], []
    for cell in sorted(cell_counts):  # own keys first
        at = bisect_left(cells_of_points, cell) % len(points)
        shard, n = points[at][2], cell_counts[cell]
        take = min(n, room[shard] - used[shard])
        if take:
            portions.append((cell, 0, take, shard, used[shard]))
            used[shard] += take
        if take < n:
            left.append((cell, at, take, n))
    for cell, at, lo, n in left:  # then what a full shard passes on
        while lo < n:
            shard = points[at][2]
            if take := min(n - lo, room[shard] - used[shard]):
                portions.append((cell, lo, lo + take, shard, used[shard]))
                used[shard] += take
                lo += take
            at = (at + 1) % len(points)
    return portions


def assign_shards(docs: DataFrame, n_shards: int, epsilon: float = 0.0, vnodes: int = VNODES) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of ``docs`` (doc_id, text, any other columns unused).

    size: UTF-8 bytes of the text plus 8.  A null text has no bytes (crc 0).  The ring position comes from doc_id,
    or from the text where doc_id is null.  Repeated rows are counted once per row: they pass the shuffles as one
    row with a count and are written in portions of consecutive ranks by many tasks, so a row repeated for a third of the table makes no
    heavy group.  Ties are ordered by (doc_id, crc, size).  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(body) + F.lit(8)).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    place_of = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text_crc32", "size"))
    keys = scratch.write(
        rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")).withColumn("h", place_of)
        .withColumn("cell", F.shiftrightunsigned("h", 64 - RING_BITS).cast("int")),
        "keys",
    )
    counts = {r["cell"]: r["n"] for r in keys.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        place(counts, n_shards, epsilon, vnodes), "cell int, lo long, hi long, shard int, base long"
    )
    in_cell = Window.partitionBy("cell").orderBy("h", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    ranges = keys.withColumn("end", F.sum("n").over(in_cell)).withColumn("begin", F.col("end") - F.col("n"))
    # the plan has at most 2**RING_BITS rows plus one for each split portion
    meets = (F.col("begin") < F.col("hi")) & (F.col("end") > F.col("lo"))
    met = ranges.join(F.broadcast(plan), (ranges["cell"] == plan["cell"]) & meets).select(
        "doc_id", "size", "text_crc32", "h", "shard", (F.col("base") - F.col("lo")).alias("shift"),
        F.greatest("begin", "lo").alias("begin"), F.least("end", "hi").alias("end"),
    )
    # a row repeated very often is dealt in portions to many tasks, and no array holds more than one portion
    portion = F.explode(F.sequence(F.col("begin"), F.col("end") - 1, F.lit(PORTION).cast("long")))
    dealt = met.withColumn("first", portion).repartition("h", "first")
    rank = F.explode(F.sequence("first", F.least(F.col("first") + PORTION, "end") - 1))
    return dealt.withColumn("rank", rank).select("doc_id", "size", "text_crc32", "shard", (F.col("shift") + F.col("rank")).alias("slot"))
