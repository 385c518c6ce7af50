"""State and report queries over the registry, the run log and the score tables.

State is derived from append-only events.  "Latest" is a maximum over a struct, which combines
map-side; no window ever holds all events of one model type or run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORE_FIELDS = (
    "at_physn_npi", "period_year", "risk_score", "risk_decile", "total_claims", "distinct_benes",
    "avg_submitted_to_allowed_ratio", "duplicate_rate", "pct_weekend_claims",
)


# --- model registry ------------------------------------------------------------------------------


def registry_state(models: DataFrame, promotions: DataFrame) -> DataFrame:
    """Registered models with ``is_active``, ``promoted_at`` and ``notes``.

    models: model_id, model_type, notes and further columns.  promotions: model_id, model_type,
    promoted_at, seq, notes.  The newest promotion of a type wins; a promotion without notes keeps
    the notes there were.
    """
    when = (F.col("promoted_at"), F.col("seq"))
    newest = (
        promotions.groupBy("model_type")
        .agg(F.max(F.struct(*when, "model_id")).alias("_last"))
        .select("model_type", F.col("_last.model_id").alias("_active_id"))
    )
    own = promotions.groupBy("model_id").agg(
        F.max("promoted_at").alias("promoted_at"),
        F.max(F.when(F.col("notes").isNotNull(), F.struct(*when, "notes"))).alias("_noted"),
    )
    return (
        models.join(own, "model_id", "left")
        .join(newest, "model_type", "left")
        .select(
            *[c for c in models.columns if c != "notes"],
            F.coalesce(F.col("_noted.notes"), F.col("notes")).alias("notes"),
            "promoted_at",
            F.coalesce(F.col("model_id") == F.col("_active_id"), F.lit(False)).alias("is_active"),
        )
    )


def active_models(registry: DataFrame, model_type: str | None = None) -> DataFrame:
    """Active model per type: id and path."""
    rows = registry.filter("is_active")
    if model_type is not None:
        rows = rows.filter(F.col("model_type") == model_type)
    return rows.select("model_type", "model_id", "model_version", "model_path")


def model_versions(registry: DataFrame, model_type: str | None = None) -> DataFrame:
    """All versions, newest training first."""
    rows = registry if model_type is None else registry.filter(F.col("model_type") == model_type)
    return rows.orderBy(F.desc("trained_at"), F.desc("model_id"))


# --- run log -------------------------------------------------------------------------------------


def run_state(events: DataFrame) -> DataFrame:
    """Start and last event per run.  events: run_id, event_at, seq, status, model_id, batch_id,
    carrier_claims_processed, outpatient_claims_processed, error_message."""
    rest = [c for c in events.columns if c not in ("run_id", "event_at", "seq")]
    last = events.groupBy("run_id").agg(F.min("event_at").alias("started_at"), F.max(F.struct("event_at", "seq", *rest)).alias("_e"))
    done = F.col("_e.status") != "running"
    return last.select(
        "run_id",
        "started_at",
        F.when(done, F.col("_e.event_at")).alias("completed_at"),
        *[F.col(f"_e.{c}").alias(c) for c in rest if c != "error_message"],
        F.when(F.col("_e.status") == "failed", F.col("_e.error_message")).alias("error_message"),
    )


def run_counts(scores: DataFrame) -> DataFrame:
    """Distinct providers scored and rows flagged per run."""
    return scores.groupBy(F.col("scoring_run_id").alias("run_id")).agg(
        F.count_distinct("at_physn_npi").alias("providers_scored"),
        F.count_if(F.col("is_flagged")).alias("providers_flagged"),
    )


def run_log(events: DataFrame, scores: DataFrame) -> DataFrame:
    counts = ("providers_scored", "providers_flagged")
    joined = run_state(events).join(run_counts(scores), "run_id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def overview(runs: DataFrame, scores: DataFrame, registry: DataFrame) -> DataFrame:
    """Successful runs: claims, providers, at-risk proxy (1000 x ratio over flagged rows), model.

    Scores are folded to one row per run before the join.
    """
    ratio = F.col("avg_submitted_to_allowed_ratio").cast("decimal(12,4)")
    risk = scores.groupBy(F.col("scoring_run_id").alias("run_id")).agg(
        F.round(F.sum(F.when(F.col("is_flagged"), ratio * 1000).otherwise(0)), 2).alias("at_risk_score_proxy")
    )
    models = registry.select("model_id", "model_version", "model_type")
    claims = F.coalesce("carrier_claims_processed", F.lit(0)) + F.coalesce("outpatient_claims_processed", F.lit(0))
    return (
        runs.filter(F.col("status") == "success")
        .join(risk, "run_id", "left")
        .join(models, "model_id", "left")
        .select(
            "run_id",
            F.col("completed_at").alias("run_date"),
            claims.alias("total_claims_processed"),
            "providers_scored",
            "providers_flagged",
            F.coalesce("at_risk_score_proxy", F.lit(0)).cast("double").alias("at_risk_score_proxy"),
            "model_version",
            "model_type",
        )
        .orderBy(F.desc("run_date"), F.desc("run_id"))
    )


# --- dashboard pages -----------------------------------------------------------------------------


def _between(c: str, start: str | None, end: str | None) -> Column:
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(c) >= F.lit(start).cast("timestamp"))
    if end is not None:
        cond = cond & (F.col(c) < F.lit(end).cast("timestamp"))
    return cond


def totals(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.sum("carrier_claims_processed").alias("claims_processed"), F.sum("providers_flagged").alias("providers_flagged")
    )


def trends(runs: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Per completion day: claims processed and providers flagged, in an optional date range."""
    done = runs.filter(F.col("completed_at").isNotNull() & _between("completed_at", start, end))
    return done.groupBy(F.to_date("completed_at").alias("run_day")).agg(
        F.sum("carrier_claims_processed").alias("claims_processed"),
        F.sum("providers_flagged").alias("providers_flagged"),
        F.count("*").alias("runs"),
    )


def filter_scores(
    scores: DataFrame,
    flagged: bool | None = None,
    deciles: tuple[int, int] | None = None,
    year: int | None = None,
) -> DataFrame:
    """The ranking page's filters."""
    if flagged is not None:
        scores = scores.filter(F.col("is_flagged") == flagged)
    if deciles is not None:
        scores = scores.filter(F.col("risk_decile").between(*deciles))
    if year is not None:
        scores = scores.filter(F.col("period_year") == year)
    return scores


def decile_histogram(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_decile").agg(F.count("*").alias("providers"))


def top_flagged(scores: DataFrame, n: int = 10) -> DataFrame:
    """The n riskiest flagged rows, ties by provider and year."""
    rows = filter_scores(scores, flagged=True)
    reasons = [c for c in rows.columns if c.startswith("top_reason_")]
    return rows.orderBy(F.desc("risk_score"), "at_physn_npi", "period_year").limit(n).select(*SCORE_FIELDS, *reasons)


def provider_explanation(attributions: DataFrame, provider: str) -> DataFrame:
    """One provider's attribution rows, largest first."""
    return attributions.filter(F.col("at_physn_npi") == provider).orderBy(
        F.desc(F.abs("shap_value")), "feature_name"
    )


def health(runs: DataFrame) -> DataFrame:
    """Last success and runs by state."""
    ok = F.col("status") == "success"
    return runs.agg(
        F.max(F.when(ok, F.col("completed_at"))).alias("last_success"),
        F.count_if(ok).alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.count_if(F.col("status") == "running").alias("running_runs"),
    )
