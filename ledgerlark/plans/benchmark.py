"""Supervised benchmark: inject scenarios, train on them, evaluate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators import inject, supervised
from ledgerlark.session import materialise
from ledgerlark.sources import versions
from ledgerlark.sources.warehouse import Warehouse

LABELLED = "injected_labeled_features"
MODEL = "model_files/supervised"


def run_injections(wh: Warehouse, seed: int = 42, max_claims: int | None = None) -> dict:
    """Writes the labelled feature table; returns its label rate."""
    features = wh.features()
    if features.isEmpty():
        raise ValueError("the feature table is empty: run the backfill and a scoring run first")
    rows = inject.all_scenarios(wh.carrier(), features, seed, max_claims=max_claims)
    versions.publish(rows, wh.path(LABELLED), ["scenario"])
    return inject.label_rate(labelled(wh)).first().asDict()


def labelled(wh: Warehouse) -> DataFrame:
    """The labelled features of the last complete injection."""
    now = versions.current(wh.spark, wh.path(LABELLED))
    if now is None:
        raise FileNotFoundError(f"{wh.path(LABELLED)}: inject the scenarios first")
    return wh.spark.read.parquet(versions.location(wh.path(LABELLED), now[0]))


def train_and_evaluate(
    wh: Warehouse, test_size: float = 0.20, params: dict | None = None, group_by_provider: bool = False
) -> dict:
    """Split, boosted trees, metrics overall and by scenario, five most important features."""
    unique = supervised.one_year_per_scenario(labelled(wh))
    rows = materialise(supervised.split(unique, test_size, group_by_provider=group_by_provider), "split")
    model = supervised.train(rows, params)
    supervised.save_model(wh.spark, model, wh.path(MODEL))
    predictions = materialise(supervised.predict(model, rows.filter("is_test")), "predictions")
    return {
        "overall": supervised.overall_metrics(predictions).first().asDict(),
        "scenarios": {r["scenario"]: r.asDict() for r in supervised.metrics_by_scenario(predictions).collect()},
        "report": {r["name"]: r.asDict() for r in supervised.report(predictions).collect()},
        "top_features": [tuple(r) for r in supervised.importances(wh.spark, model, top=5).collect()],
    }


def score(wh: Warehouse, rows: DataFrame) -> DataFrame:
    """Probability of an anomaly for labelled or new rows, by the stored model."""
    for c, kind in (("scenario", "string"), ("label", "int")):
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast(kind))
    return supervised.predict(supervised.load_model(wh.spark, wh.path(MODEL)), rows)
