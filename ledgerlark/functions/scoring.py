"""Scalar rules of the scoring step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RISK_THRESHOLD = 75


def risk_score(raw: Column) -> Column:
    """Decision value in about [-1, 1] to 0..100, truncated; low (anomalous) values score high."""
    return F.least(F.greatest((-raw + 1) / 2 * 100, F.lit(0.0)), F.lit(100.0)).cast("int")


def is_flagged(risk: Column, threshold: int = RISK_THRESHOLD) -> Column:
    return risk >= threshold


def with_deciles(df: DataFrame, score: str, out: str = "risk_decile", bins: int = 10) -> DataFrame:
    """Quantile bin 1..bins of an integer score; bins with equal edges merge, a constant score has none.

    The edges come from the histogram of the score (at most 101 rows) as a scalar subquery.  A value
    belongs to the first bin whose upper edge it does not exceed.
    """
    edges = (
        df.groupBy(F.col(score).alias("v"))
        .agg(F.count("*").alias("n"))
        .agg(F.percentile("v", [i / bins for i in range(bins + 1)], F.col("n")).alias("e"))
        .select(F.array_distinct(F.transform("e", lambda x: F.round(x, 9))).alias("e"))
        .scalar()
    )
    below = F.size(F.filter("_edges", lambda e: e < F.col(score)))
    tagged = df.withColumn("_edges", edges)
    return tagged.withColumn(out, F.when(F.size("_edges") > 1, F.greatest(F.lit(1), below))).drop("_edges")


def metrics(df: DataFrame, risk: str = "risk_score", threshold: int = RISK_THRESHOLD) -> DataFrame:
    """Mean risk, share at or above the threshold, rows."""
    return df.agg(
        F.avg(risk).alias("avg_anomaly_score"),
        F.avg(F.when(is_flagged(F.col(risk), threshold), 1.0).otherwise(0.0)).alias("pct_flagged"),
        F.count("*").alias("training_rows"),
    )


def spread_comparison(scores: DataFrame, new: str, current: str, min_gain: float = 0.01) -> DataFrame:
    """Population standard deviation of both models' raw scores, the gain, and whether it is enough."""
    spreads = scores.agg(F.stddev_pop(new).alias("new_spread"), F.stddev_pop(current).alias("current_spread"))
    gain = F.coalesce(F.col("new_spread") - F.col("current_spread"), F.lit(0.0))
    return spreads.withColumn("improvement", gain).withColumn("promote", F.col("improvement") >= min_gain)
