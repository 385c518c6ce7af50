"""Monthly retraining: snapshot, train, compare with the active model, promote or keep."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerlark.functions.scoring import metrics, risk_score, spread_comparison
from ledgerlark.operators import forest, reports
from ledgerlark.operators.scores import with_decision
from ledgerlark.schema import PROVIDER_FEATURES
from ledgerlark.sources import versions
from ledgerlark.sources.tables import table_exists
from ledgerlark.sources.warehouse import MODELS, PROMOTIONS, Warehouse

KEYS = ["at_physn_npi", "period_year"]
MODEL_TYPE = "isolation_forest"
MIN_GAIN = 0.01


def registry(wh: Warehouse):
    return reports.registry_state(wh.state("models", MODELS), wh.state("promotions", PROMOTIONS))


def active_model(wh: Warehouse, model_type: str = MODEL_TYPE) -> tuple[int, forest.ForestModel] | None:
    """Active model, or None when there is none or its tables are gone."""
    row = reports.active_models(registry(wh), model_type).first()
    if row is None or not table_exists(wh.spark, f"{row['model_path']}/meta"):
        return None
    return int(row["model_id"]), forest.load_model(wh.spark, row["model_path"])


def train_model(wh: Warehouse, now: datetime, contamination: float = 0.05, trees: int = 200) -> tuple[int, forest.ForestModel]:
    """Train on a snapshot of all features and register the model, not yet active."""
    taken = versions.publish(wh.features(), wh.path("training_features"))
    snapshot = versions.read(wh.spark, wh.path("training_features"), PROVIDER_FEATURES, taken)  # stays as it is while features change
    model = forest.train(snapshot, KEYS, contamination, trees)
    known = wh.state("models", MODELS)
    model_id = int(known.agg(F.coalesce(F.max("model_id"), F.lit(0)).alias("m")).first()["m"]) + 1
    path = wh.path(f"model_files/{MODEL_TYPE}_{model_id}")
    forest.save_model(wh.spark, model, path)
    risk = with_decision(snapshot, model).select(risk_score(F.col("raw")).alias("risk_score"))
    summary = metrics(risk).first()
    wh.add_state(
        "models",
        MODELS,
        (
            model_id, MODEL_TYPE, now.strftime("if_%Y%m%d"), now, int(summary["training_rows"]), trees, contamination,
            float(summary["avg_anomaly_score"]), None, None, None, None, path, None,
        ),
    )
    return model_id, model


def promote(wh: Warehouse, model_id: int, now: datetime, notes: str | None = None, model_type: str = MODEL_TYPE) -> None:
    seq = wh.state("promotions", PROMOTIONS).count() + 1
    wh.add_state("promotions", PROMOTIONS, (model_id, model_type, now, seq, notes))


def first_model(wh: Warehouse, now: datetime) -> tuple[int, forest.ForestModel]:
    """Without an active model the first run trains one; it is registered and active like any other."""
    model_id, model = train_model(wh, now)
    promote(wh, model_id, now, "first model")
    return model_id, model


def compare(wh: Warehouse, new: forest.ForestModel, current: forest.ForestModel, min_gain: float = MIN_GAIN) -> tuple[float, bool]:
    """Gain in the spread of raw scores over all features, and whether it is enough."""
    both = with_decision(with_decision(wh.features(), new, "new_raw"), current, "current_raw")
    row = spread_comparison(both, "new_raw", "current_raw", min_gain).first()
    return float(row["improvement"]), bool(row["promote"])


def run_retraining(wh: Warehouse, now: datetime | None = None, contamination: float = 0.05, trees: int = 200) -> dict:
    """Trains a model and promotes it if there is none yet or it separates better."""
    now = now or datetime.now()
    current = active_model(wh)
    model_id, model = train_model(wh, now, contamination, trees)
    if current is None:
        promote(wh, model_id, now, "first model")
        return {"model_id": model_id, "promoted": True, "reason": "first_model"}
    gain, better = compare(wh, model, current[1])
    reason = f"{'improvement' if better else 'no_improvement'}_{gain:.4f}"
    if better:
        promote(wh, model_id, now, f"Promoted on {now.date()}. Reason: {reason}")
    return {"model_id": model_id, "promoted": better, "reason": reason}
