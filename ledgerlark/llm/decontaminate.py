"""Benchmark decontamination: item-sized windows, SimHash, multi-index Hamming blocks, exact weighted-shingle similarity.

* Windows.  A window has as many words as a benchmark item and is laid where it shares a five-word shingle with an
  item of that size, at the item's own alignment (kept inside the text).  A window without a shared
  shingle has similarity 0, so none that could be reported is left out.
* Fingerprints.  A window's 64-bit SimHash is taken over its words, each as often as it occurs.
* Search.  The 64 bits are cut into 4 blocks of 16.  Of two fingerprints within 4 m + 3 bits, one block differs in m bits at
  most.  So an item is listed under every value within m bits of each of its blocks, a window under its own four values, and
  joining on (size, block, value) finds every item of the size within the radius.
* Verification.  Shingles weigh as often as they occur; similarity is the sum of the smaller weights over the sum
  of the larger ones, computed exactly, and has to reach the threshold.

Windows beyond the radius are not reported, whatever their similarity; README gives the measured recall.
Words are maximal runs of letters and digits in lower case, so punctuation and case do not hide a copy.
Everything is DataFrame expressions; texts stay in the scan, only windows with a shared shingle leave it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch, with_row_key

SHINGLE = 5
SIMILARITY = 0.8
BLOCK_BITS = 16
BLOCKS = 64 // BLOCK_BITS
#: Bits in which an item's listed block values may differ from its own (2,517 values a block).
BLOCK_RADIUS = 4
#: All fingerprints within this distance are found.
RADIUS = BLOCKS * BLOCK_RADIUS + BLOCKS - 1
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _shingle(array: str, at: Column) -> Column:
    return F.xxhash64(*[F.get(array, at + j) for j in range(SHINGLE)])


def _shingles(array: str) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(array) - SHINGLE), lambda i: _shingle(array, i))


def with_fingerprint(df: DataFrame, array: str) -> DataFrame:
    """Append ``fp``: bit b is set when more than half of the words' hashes have it set."""
    hashed = df.withColumn("_h", F.transform(array, lambda w: F.xxhash64(w)))
    set_ = lambda b: 2 * F.size(F.filter("_h", lambda h: F.getbit(h, b) == 1)) > F.size("_h")
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(set_(b), F.lit(1)).otherwise(F.lit(0)))
    powers = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    fp = F.aggregate(F.zip_with(bits, powers, lambda on, p: F.when(on == 1, p).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    return hashed.withColumn("fp", fp).drop("_h")


def _blocks(df: DataFrame) -> DataFrame:
    """One row per block of the fingerprint: (..., block, value)."""
    value = [F.shiftrightunsigned("fp", BLOCK_BITS * j).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for j in range(BLOCKS)]
    return df.select("*", F.posexplode(F.array(*value)).alias("block", "value"))


def _neighbours(df: DataFrame) -> DataFrame:
    """Each block row once for every value within ``BLOCK_RADIUS`` bits of its own."""
    flips = df.sparkSession.range(1 << BLOCK_BITS).where(F.bit_count("id") <= BLOCK_RADIUS).agg(F.collect_list("id")).scalar()
    return df.withColumn("_flip", flips).withColumn("_flip", F.explode("_flip")).withColumn("value", F.col("value").bitwiseXOR(F.col("_flip"))).drop("_flip")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a written table if it is small enough; else both sides are shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def find_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start_word, similarity, distance, _rk1, _rk2): the best window per document and item.

    ``docs``: doc_id, text; ``benchmark``: item_id, text; other columns are not read.  Only contaminated documents
    come back.  Items of fewer than five words cannot be told from ordinary text and match nothing; null and empty
    texts match nothing.  Of equally similar windows the first counts.  Repeated rows are reported once (they
    share a row key); repeated items once per item_id.  An empty table on either side gives an empty result; a very long
    text gives one row per window that shares a shingle, and no other row leaves its scan.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    items = scratch.write(
        with_fingerprint(
            benchmark.select("item_id", words(F.col("text")).alias("item")).where(F.size("item") >= SHINGLE).distinct()
            .select("*", F.size("item").alias("w"), _shingles("item").alias("item_shingles")),
            "item",
        ),
        "items",
    )
    seeds = scratch.write(items.select("w", F.posexplode("item_shingles").alias("q", "h")).distinct(), "seeds")

    keyed = with_row_key(docs.select("doc_id", "text"), "doc_id", "text").select("doc_id", "_rk1", "_rk2", words(F.col("text")).alias("ws"))
    at = keyed.where(F.size("ws") >= SHINGLE).select("*", F.explode(F.sequence(F.lit(0), F.size("ws") - SHINGLE)).alias("p"))
    met = at.withColumn("h", _shingle("ws", F.col("p"))).join(_small(seeds), "h")
    start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.size("ws") - F.col("w")))
    placed = met.select("doc_id", "_rk1", "_rk2", "w", start.alias("start"), "ws").select(
        "doc_id", "_rk1", "_rk2", "w", "start", F.slice("ws", F.col("start") + 1, F.col("w")).alias("window")
    )
    windows = scratch.write(placed.distinct(), "windows")

    marked = _blocks(with_fingerprint(windows, "window").select("doc_id", "_rk1", "_rk2", "w", "start", "fp"))
    listed = _neighbours(_blocks(items.select("item_id", "w", "fp").distinct())).withColumnRenamed("fp", "item_fp")
    index = scratch.write(listed, "index")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = (
        marked.join(_small(index), ["w", "block", "value"]).withColumn("distance", distance).where(F.col("distance") <= RADIUS)
        .select("doc_id", "_rk1", "_rk2", "w", "start", "item_id", "distance").distinct()
    )
    at_window = ["_rk1", "_rk2", "w", "start"]
    sides = (
        near.join(windows.drop("doc_id"), at_window)
        .join(_small(items.select("item_id", "w", "item_shingles").distinct()), ["item_id", "w"], "inner")
        .withColumn("window_shingles", F.when(F.size("window") >= SHINGLE, _shingles("window")).otherwise(F.array().cast("array<bigint>")))
    )
    one = lambda a, b: lambda h: F.struct(h.alias("h"), F.lit(a).alias("a"), F.lit(b).alias("b"))
    both = F.concat(F.transform("window_shingles", one(1, 0)), F.transform("item_shingles", one(0, 1)))
    pair = ["doc_id", "_rk1", "_rk2", "start", "item_id", "distance"]
    weights = sides.select(*pair, F.explode(both).alias("s")).groupBy(*pair, "s.h").agg(F.sum("s.a").alias("a"), F.sum("s.b").alias("b"))
    alike = weights.groupBy(*pair).agg((F.sum(F.least("a", "b")) / F.sum(F.greatest("a", "b"))).alias("similarity"))
    best = F.max_by(F.struct("start", "similarity", "distance"), F.struct("similarity", (-F.col("start")).alias("first")))
    return (
        alike.where(F.col("similarity") >= similarity).groupBy("doc_id", "_rk1", "_rk2", "item_id").agg(best.alias("best"))
        .select("doc_id", "item_id", F.col("best.start").alias("start_word"), "best.similarity", "best.distance", "_rk1", "_rk2")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item.

    All columns stay, also such that clash with names used here.  Rows without text stay, repeated rows go or stay together, and an empty
    benchmark leaves everything.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    keys = scratch.write(find_contamination(docs, benchmark, similarity).select("_rk1", "_rk2").distinct(), "rows")
    return with_row_key(docs, "doc_id", "text").join(_small(keys), ["_rk1", "_rk2"], "left_anti").select(*docs.columns)
