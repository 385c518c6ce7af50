"""Order-dependent operators that stay distributed when one group holds most of the rows.

The usual window (`row_number() over (partition by key ...)`) sorts a whole group in one task.  The
forms here shrink the data with a map-side combine first, so that what reaches a window is bounded by
a value domain or a bucket count and not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET_DIGITS = 4  # hex digits of a hash used as bucket: at most 65,536 buckets per group


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL being equal to NULL; the right side's keys are dropped."""
    there = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in keys:
        same = same & left[c].eqNullSafe(there[f"_r_{c}"])
    return left.join(there, same, how).drop(*[f"_r_{c}" for c in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, remaining columns as final tie-break.

    The minimum of a struct combines map-side, so copies of one hot key collapse before the shuffle.
    """
    lead = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    if not lead and not rest:
        return df.dropDuplicates(list(keys))
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*lead, *rest)).alias("_first"))
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns])
    )


def mark_smallest(
    df: DataFrame,
    groups: Sequence[str],
    hash_col: str,
    quota: Callable[[Column], Column],
    ties: Sequence[str] = (),
    out: str = "is_chosen",
) -> DataFrame:
    """Marks exactly ``quota(n)`` rows of each group (n = its row count): those with the smallest hash.

    Works on a histogram of hash prefixes, at most 65,536 buckets per group: buckets below the quota
    are taken whole and only rows that share a bucket are ranked against each other.  The hash must
    come from a key that is unique within the group.
    """
    tagged = df.withColumn("_bucket", F.substring(hash_col, 1, _BUCKET_DIGITS))
    running = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    buckets = (
        tagged.groupBy(*groups, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .select(*groups, "_bucket", (quota(F.sum("_n").over(whole)) - F.col("_before")).alias("_open"))
    )
    in_bucket = Window.partitionBy(*groups, "_bucket").orderBy(hash_col, *ties)
    return join_null_safe(tagged, buckets, [*groups, "_bucket"]).select(
        *df.columns, (F.row_number().over(in_bucket) <= F.col("_open")).alias(out)
    )


def smallest_by_hash(
    df: DataFrame, groups: Sequence[str], hash_col: str, quota: Callable[[Column], Column], ties: Sequence[str] = ()
) -> DataFrame:
    """The rows that ``mark_smallest`` marks."""
    return mark_smallest(df, groups, hash_col, quota, ties, "_chosen").filter("_chosen").drop("_chosen")


def auc_by_group(df: DataFrame, groups: Sequence[str], score: str, label: str, buckets: int = 256) -> DataFrame:
    """Area under the ROC curve per group, ties counted half; NULL when a class is missing.

    Rows collapse to one per distinct score.  Negatives below a score = negatives in lower score
    buckets (a prefix sum over at most ``buckets`` + 1 rows) + negatives below it in its own bucket.
    Bucket edges are quantiles of the group's distinct scores, so scores that pile up are spread too.
    """
    hist = (
        df.groupBy(*groups, F.col(score).alias("_s"))
        .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"), F.count("*").alias("_n"))
        .withColumn("_neg", F.col("_n") - F.col("_pos"))
    )
    cuts = F.percentile_approx("_s", [i / buckets for i in range(1, buckets)], 10 * buckets)
    edges = hist.groupBy(*groups).agg(cuts.alias("_edges"))
    hist = join_null_safe(hist, edges, groups) if groups else hist.withColumn("_edges", edges.select("_edges").scalar())
    hist = hist.withColumn("_b", F.size(F.filter("_edges", lambda e: e <= F.col("_s")))).drop("_edges")
    below_bucket = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hist.groupBy(*groups, "_b")
        .agg(F.sum("_neg").alias("_bneg"))
        .select(*groups, "_b", F.coalesce(F.sum("_bneg").over(below_bucket), F.lit(0)).alias("_off"))
    )
    below = Window.partitionBy(*groups, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.withColumn("_in", F.coalesce(F.sum("_neg").over(below), F.lit(0)))
    ranked = join_null_safe(ranked, offsets, [*groups, "_b"])
    wins = F.col("_pos").cast("double") * (F.col("_off") + F.col("_in") + F.col("_neg") / 2)
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return ranked.groupBy(*groups).agg(F.when(pairs > 0, F.sum(wins) / pairs).alias("auc_roc"))
