"""Batch scoring output: one row per provider-year of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.scoring import RISK_THRESHOLD, is_flagged, risk_score, with_deciles
from ledgerlark.operators.forest import ForestModel, scaled_inputs, score_column
from ledgerlark.session import materialise


def score_rows(scored: DataFrame, run_id: int, batch_id: int, threshold: int = RISK_THRESHOLD) -> DataFrame:
    """From features plus a ``raw`` decision value to the score table layout."""
    rated = with_deciles(scored.withColumn("risk_score", risk_score(F.col("raw"))), "risk_score")
    return rated.select(
        "at_physn_npi",
        F.lit(run_id).alias("scoring_run_id"),
        "period_year",
        F.lit(batch_id).alias("batch_id"),
        F.col("raw").alias("isolation_forest_score"),
        "risk_score",
        "risk_decile",
        is_flagged(F.col("risk_score"), threshold).alias("is_flagged"),
        F.col("total_carrier_claims").alias("total_claims"),
        F.col("distinct_beneficiaries").alias("distinct_benes"),
        "avg_submitted_to_allowed_ratio",
        "duplicate_rate",
        "pct_weekend_claims",
    )


def with_decision(features: DataFrame, model: ForestModel, out: str = "raw") -> DataFrame:
    """Decision value: score minus offset; negative means anomalous."""
    score = score_column(features.sparkSession, model, scaled_inputs(model))
    return features.withColumn(out, score - F.lit(model.offset))


def score_batch(
    features: DataFrame, model: ForestModel, run_id: int, batch_id: int, threshold: int = RISK_THRESHOLD
) -> DataFrame:
    """Scores for the features computed in one batch.

    Decisions are written once: the decile edges and the result both read them.
    """
    rows = features.filter(F.col("batch_id") == batch_id)
    return score_rows(materialise(with_decision(rows, model), "decisions"), run_id, batch_id, threshold)
