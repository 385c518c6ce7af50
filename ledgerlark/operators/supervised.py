"""Supervised benchmark on the labelled scenarios: split, boosted trees, metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.features import PROVIDER
from ledgerlark.operators.inject import keyed_hash
from ledgerlark.operators.ranking import auc_by_group, first_per_key, join_null_safe, mark_smallest
from ledgerlark.operators.scaling import model_matrix, scaler_rows, scaler_table, standardise
from ledgerlark.schema import MODEL_FEATURES
from ledgerlark.session import ensure_checkpoint_dir, materialise, scratch_path
from ledgerlark.sources import versions

# Parameters of the boosted classifier.
BOOSTING = {
    "maxIter": 300,
    "maxDepth": 6,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 5,
    "seed": 42,
}
POSITIVE_WEIGHT = 10.0


def one_year_per_scenario(labelled: DataFrame) -> DataFrame:
    """One row per (provider, scenario): the earliest year."""
    return first_per_key(labelled, [PROVIDER, "scenario"], ["period_year"])


def split(labelled: DataFrame, test_size: float = 0.20, seed: int = 42, group_by_provider: bool = False) -> DataFrame:
    """Adds ``is_test``: the given share of each label, by hash rank.

    ``group_by_provider`` keeps all scenario copies of a provider on one side; a provider then counts
    with its highest label.
    """

    def quota(n):
        return F.floor(n * F.lit(test_size) + F.lit(0.5))

    if not group_by_provider:
        rows = labelled.withColumn("_h", keyed_hash(seed, "split", PROVIDER, "scenario"))
        return mark_smallest(rows, ["label"], "_h", quota, [PROVIDER, "scenario"], "is_test").drop("_h")
    providers = (
        labelled.groupBy(PROVIDER).agg(F.max("label").alias("label")).withColumn("_h", keyed_hash(seed, "split", PROVIDER))
    )
    marked = mark_smallest(providers, ["label"], "_h", quota, [PROVIDER], "is_test")
    return labelled.join(marked.select(PROVIDER, "is_test"), PROVIDER)


NODES = T.StructType(
    [
        T.StructField("tree_id", T.IntegerType()),
        T.StructField("weight", T.DoubleType()),  # of the tree
        T.StructField("node_id", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),  # -1 marks a leaf
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("gain", T.DoubleType()),  # impurity that the split removes, times the weight of its rows
    ]
)
SCALER = "feature string, mean double, scale double"
MAX_NODES = 5_000_000  # broadcast bound: about 200 MB of node arrays


def node_table(model: GBTClassificationModel, spark: SparkSession) -> DataFrame:
    """The trees as rows, read from the model's own tables."""
    path = scratch_path(spark, "boosted-model")
    model.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("treeID"), F.col("_3").alias("weight"))
    node = F.col("nodeData")
    leaf = node["leftChild"] < 0
    rows = spark.read.parquet(f"{path}/data").join(F.broadcast(weights), "treeID")  # one row per tree
    return rows.select(
        F.col("treeID").alias("tree_id"),
        "weight",
        node["id"].alias("node_id"),
        F.when(leaf, -1).otherwise(node["split"]["featureIndex"]).alias("feature"),
        F.when(leaf, 0.0).otherwise(F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(leaf, node["id"]).otherwise(node["leftChild"]).alias("left"),
        F.when(leaf, node["id"]).otherwise(node["rightChild"]).alias("right"),
        node["prediction"].alias("value"),
        F.when(leaf, 0.0).otherwise(node["gain"] * F.get(node["impurityStats"], F.lit(0))).alias("gain"),
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in NODES.fields])


@dataclass
class BoostedModel:
    """Boosted trees as flat arrays (nodes of all trees) with the scaler of their training rows."""

    roots: np.ndarray
    weight: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    tree: np.ndarray
    mean: dict[str, float]
    scale: dict[str, float]

    @classmethod
    def from_tables(cls, nodes: DataFrame, scaler: DataFrame) -> BoostedModel:
        if (n := nodes.count()) > MAX_NODES:
            raise ValueError(f"{n} nodes, more than {MAX_NODES}; use fewer or smaller trees")
        pdf = nodes.toPandas().sort_values(["tree_id", "node_id"], kind="stable").reset_index(drop=True)
        first = pdf["tree_id"].ne(pdf["tree_id"].shift()).to_numpy()
        roots = np.flatnonzero(first)
        tree = np.cumsum(first) - 1
        # Node ids of a tree need not be gapless: find each child by its place in the sorted table.
        place = {(t, i): k for k, (t, i) in enumerate(zip(pdf["tree_id"].tolist(), pdf["node_id"].tolist(), strict=True))}
        child = lambda side: np.array([place[t, i] for t, i in zip(pdf["tree_id"].tolist(), pdf[side].tolist(), strict=True)], dtype=np.int64)
        stats = scaler_rows(scaler)
        return cls(
            roots, pdf["weight"].to_numpy(float)[roots], pdf["feature"].to_numpy(np.int64), pdf["threshold"].to_numpy(float),
            child("left"), child("right"), pdf["value"].to_numpy(float), pdf["gain"].to_numpy(float), tree,
            {k: float(v["mean"]) for k, v in stats.items()}, {k: float(v["scale"]) for k, v in stats.items()},
        )

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """(nodes, scaler)."""
        base = self.roots[self.tree]
        nodes = pd.DataFrame(
            {
                "tree_id": self.tree.astype("int32"), "weight": self.weight[self.tree], "node_id": (np.arange(len(self.tree)) - base).astype("int32"),
                "feature": self.feature.astype("int32"), "threshold": self.threshold, "left": (self.left - base).astype("int32"),
                "right": (self.right - base).astype("int32"), "value": self.value, "gain": self.gain,
            }
        )
        scaler = [(c, self.mean[c], self.scale[c]) for c in MODEL_FEATURES]
        return spark.createDataFrame(nodes, NODES), spark.createDataFrame(scaler, SCALER)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees' values; all trees descend together."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row, split = np.arange(len(x))[:, None], np.maximum(self.feature, 0)
        while (inner := self.feature[at] >= 0).any():
            goes_left = x[row, split[at]] <= self.threshold[at]
            at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
        return self.value[at] @ self.weight

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of label 1: the logistic link of the boosted loss."""
        return 1.0 / (1.0 + np.exp(-2.0 * self.margin(x)))

    def importances(self) -> np.ndarray:
        """Share of each input in the impurity that all splits remove."""
        inner = self.feature >= 0
        total = np.bincount(self.feature[inner], self.gain[inner], len(MODEL_FEATURES))
        return total / total.sum() if total.sum() > 0 else total


def save_model(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """Two small tables, each with a pointer to its current version."""
    nodes, scaler = model.tables(spark)
    versions.publish(nodes, f"{path}/nodes")
    versions.publish(scaler, f"{path}/scaler")


def load_model(spark: SparkSession, path: str) -> BoostedModel:
    scaler = spark.createDataFrame([], SCALER).schema
    return BoostedModel.from_tables(versions.read(spark, f"{path}/nodes", NODES), versions.read(spark, f"{path}/scaler", scaler))


def fit(
    rows: DataFrame, params: dict | None = None, positive_weight: float = POSITIVE_WEIGHT
) -> tuple[GBTClassificationModel, DataFrame]:
    """Spark's boosted trees on the rows not held out, and the scaler of these rows."""
    ensure_checkpoint_dir(rows.sparkSession)
    matrix = model_matrix(rows.filter(~F.col("is_test")))
    scaler = materialise(scaler_table(matrix), "scaler")
    data = _vectors(standardise(matrix, scaler)).withColumn(
        "weight", F.when(F.col("label") == 1, positive_weight).otherwise(1.0)
    )
    booster = GBTClassifier(labelCol="label", featuresCol="inputs", weightCol="weight", **{**BOOSTING, **(params or {})})
    return booster.fit(data), scaler


def train(rows: DataFrame, params: dict | None = None, positive_weight: float = POSITIVE_WEIGHT) -> BoostedModel:
    """Boosted trees on the rows not held out, with the scaler of these rows."""
    model, scaler = fit(rows, params, positive_weight)
    return BoostedModel.from_tables(node_table(model, rows.sparkSession), scaler)


def _vectors(matrix: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="inputs").transform(matrix)


def predict(model: BoostedModel, rows: DataFrame) -> DataFrame:
    """(provider, scenario, label, prob).  The model is broadcast; only its inputs cross to Python, as Arrow batches."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def probability(*cols: pd.Series) -> pd.Series:
        return pd.Series(shared.value.probability(np.column_stack([c.to_numpy(dtype=float) for c in cols])))

    inputs = [(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(model.mean[c])) / F.lit(model.scale[c]) for c in MODEL_FEATURES]
    return rows.select(PROVIDER, "scenario", "label", probability(*inputs).alias("prob"))


def confusion(predictions: DataFrame, groups: Sequence[str] = (), cut: float = 0.5) -> DataFrame:
    """tp, fp, fn, tn at the cut."""
    said, true = F.col("prob") >= cut, F.col("label") == 1
    return predictions.groupBy(*groups).agg(
        F.count_if(said & true).alias("tp"),
        F.count_if(said & ~true).alias("fp"),
        F.count_if(~said & true).alias("fn"),
        F.count_if(~said & ~true).alias("tn"),
    )


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_metrics(predictions: DataFrame, groups: Sequence[str] = (), cut: float = 0.5) -> DataFrame:
    """Confusion counts with precision, recall and F1; a zero denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        confusion(predictions, groups, cut)
        .withColumn("precision", _ratio(tp, tp + fp))
        .withColumn("recall", _ratio(tp, tp + fn))
        .withColumn("f1", _ratio(2 * tp, 2 * tp + fp + fn))
    )


def report(predictions: DataFrame, cut: float = 0.5) -> DataFrame:
    """Per class and averaged (macro, weighted) precision, recall, F1 and support."""
    c = confusion(predictions, (), cut)
    classes = F.array(
        F.struct(F.lit("Clean").alias("name"), F.col("tn").alias("hit"), F.col("fn").alias("over"), F.col("fp").alias("miss")),
        F.struct(F.lit("Anomaly").alias("name"), F.col("tp").alias("hit"), F.col("fp").alias("over"), F.col("fn").alias("miss")),
    )
    rows = c.select(F.inline(classes)).select(
        "name",
        _ratio(F.col("hit"), F.col("hit") + F.col("over")).alias("precision"),
        _ratio(F.col("hit"), F.col("hit") + F.col("miss")).alias("recall"),
        _ratio(2 * F.col("hit"), 2 * F.col("hit") + F.col("over") + F.col("miss")).alias("f1"),
        (F.col("hit") + F.col("miss")).alias("support"),
    )
    names = ("precision", "recall", "f1")
    n = F.sum("support")
    macro = rows.agg(*[F.avg(x).alias(x) for x in names], n.alias("support")).withColumn("name", F.lit("macro avg"))
    weighted = rows.agg(
        *[F.when(n > 0, F.sum(F.col(x) * F.col("support")) / n).otherwise(0.0).alias(x) for x in names], n.alias("support")
    ).withColumn("name", F.lit("weighted avg"))
    return rows.unionByName(macro).unionByName(weighted)


def metrics_by_scenario(predictions: DataFrame, cut: float = 0.5) -> DataFrame:
    """Rows, anomalies, precision, recall, F1 and AUC per scenario; AUC is NULL with one class only."""
    base = class_metrics(predictions, ["scenario"], cut).withColumns(
        {
            "test_rows": F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"),
            "anomalies": F.col("tp") + F.col("fn"),
        }
    )
    auc = auc_by_group(predictions, ["scenario"], "prob", "label")
    return join_null_safe(base, auc, ["scenario"], "left").select(
        "scenario", "test_rows", "anomalies", "precision", "recall", "f1", "auc_roc"
    )


def overall_metrics(predictions: DataFrame, cut: float = 0.5) -> DataFrame:
    base = class_metrics(predictions, (), cut)
    auc = auc_by_group(predictions, [], "prob", "label").select("auc_roc").scalar()
    return base.select(auc.alias("auc_roc"), "precision", "recall", "f1", "tp", "fp", "fn", "tn")


def importances(spark: SparkSession, model: BoostedModel, top: int | None = None) -> DataFrame:
    """(feature, importance), largest first; one row per model input."""
    values = [(f, float(v)) for f, v in zip(MODEL_FEATURES, model.importances(), strict=True)]
    ordered = spark.createDataFrame(values, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return ordered if top is None else ordered.limit(top)
