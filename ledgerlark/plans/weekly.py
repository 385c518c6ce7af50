"""Weekly scoring: next batch, feature refresh, scores, explanations, run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.scoring import RISK_THRESHOLD
from ledgerlark.operators import attribution as at
from ledgerlark.operators import increments as inc
from ledgerlark.operators.features import dated_between
from ledgerlark.operators.forest import ForestModel
from ledgerlark.operators.scores import score_batch
from ledgerlark.plans.retrain import active_model, first_model
from ledgerlark.session import materialise, temporary_tables
from ledgerlark.sources import tables
from ledgerlark.sources.claim_state import PROVIDER_BUCKET
from ledgerlark.sources.warehouse import POSITIONS, RUN_EVENTS, Warehouse

FEATURE_KEYS = ["at_physn_npi", "period_year"]
SCORE_KEYS = ["at_physn_npi", "period_year", "scoring_run_id"]


def refresh_features(wh: Warehouse, batch_id: int, start: str | None = None, end: str | None = None) -> None:
    """Recompute the providers active in (start, end] from their full history and replace their rows.

    The history comes from the stored cells of their buckets, the window from the claims of its years; only the features of
    these buckets are rewritten.  Without a window all providers are computed.
    """
    state = wh.claim_state()
    claims = wh.carrier() if start is None and end is None else dated_between(wh.carrier(), start, end)
    active = state.active(claims)
    buckets = [b for (b,) in tables.values_of(active, [PROVIDER_BUCKET])]
    rows = state.features(active, wh.beneficiaries(), wh.outpatient(buckets), batch_id)
    tables.replace_rows(rows, wh.path("provider_features"), FEATURE_KEYS, ["period_year", PROVIDER_BUCKET])


def explain(wh: Warehouse, scores: DataFrame, model: ForestModel, run_id: int) -> DataFrame:
    """Writes the attribution rows of the flagged providers; returns the scores with their reasons."""
    rows = at.flagged_inputs(scores, wh.features(), run_id)
    ranked = materialise(
        at.ranked_contributions(
            rows.withColumn("contribution", at.shapley_column(wh.spark, model)), "contribution", SCORE_KEYS
        ),
        "attributions",
    )
    tables.append(at.attribution_rows(ranked, SCORE_KEYS), wh.path("shap_values"), ["scoring_run_id"])
    return at.attach_reasons(scores, at.top_reasons(ranked, SCORE_KEYS), SCORE_KEYS)


def run_weekly(
    wh: Warehouse, batch_size: int = inc.BATCH_SIZE, threshold: int = RISK_THRESHOLD, now: datetime | None = None
) -> dict | None:
    """One scoring run.  Returns its summary, or None when there are no new claims.

    The position moves only after the scores are written, so a failed run is simply run again.
    """
    now = now or datetime.now()
    position, last_batch = wh.position()
    window = inc.window_of_days(wh.claim_state().days.read(upto=wh.last_ingest()), position, batch_size, last_batch).first()
    if window is None:
        return None
    events = wh.state("run_events", RUN_EVENTS)
    run_id = int(events.agg(F.coalesce(F.max("run_id"), F.lit(0)).alias("m")).first()["m"]) + 1
    batch_id, end = int(window["batch_id"]), str(window["batch_end"])

    def event(seq: int, status: str, model_id=None, claims=None, error=None) -> None:
        wh.add_state("run_events", RUN_EVENTS, (run_id, now, seq, status, model_id, batch_id, claims, 0, error))

    event(0, "running")
    try:
        with temporary_tables(wh.spark):
            refresh_features(wh, batch_id, position, end)
            model_id, model = active_model(wh) or first_model(wh, now)
            scores = materialise(score_batch(wh.features(), model, run_id, batch_id, threshold), "scores")
            with_reasons = explain(wh, scores, model, run_id)
            tables.append(with_reasons, wh.path("provider_risk_scores"), ["scoring_run_id"])
        wh.add_state("positions", POSITIONS, ("carrier", window["batch_end"], batch_id))
    except Exception as exc:
        event(1, "failed", error=str(exc))
        raise
    event(1, "success", model_id, int(window["claims"]))
    return {"run_id": run_id, "batch_id": batch_id, "claims": int(window["claims"]), "position": end}
