"""Isolation forest over standardised features (Liu, Ting and Zhou 2008).

Spark draws and shuffles the per-tree samples, one group per tree; a tree is grown from at most
``sample_size`` rows.  The trained model is a node table, bounded by trees x 2 x sample_size rows, which
is what makes it safe to broadcast for scoring.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.scaling import model_matrix, scaler_rows, scaler_table, standardise
from ledgerlark.schema import MODEL_FEATURES
from ledgerlark.sources.tables import full_refresh

SAMPLE_SIZE = 256
MAX_NODES = 5_000_000  # broadcast bound: about 200 MB of node arrays

NODE_TABLE = T.StructType(
    [
        T.StructField("tree_id", T.IntegerType()),
        T.StructField("node_id", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),  # -1 marks a leaf
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("depth", T.IntegerType()),
    ]
)


def mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


# --- training ------------------------------------------------------------------------------------


def tree_samples(matrix: DataFrame, keys: list[str], trees: int, sample_size: int, seed: int) -> DataFrame:
    """(tree_id, draw, x): for each tree the rows with the smallest keyed hash, without replacement.

    A hash threshold first keeps about four times the sample, so that the ranking per tree sees a
    bounded number of rows whatever the size of the table.
    """
    total = matrix.count()
    share = 1.0 if total == 0 else min(1.0, 4.0 * sample_size / total)

    def draw(tree: Column) -> Column:
        return F.xxhash64(*keys, F.lit(seed), tree)

    limit = F.lit(2**63 - 1 if share >= 1.0 else int((share - 0.5) * 2.0**64)).cast("bigint")
    picked = matrix.select(
        *keys,
        F.array(*MODEL_FEATURES).alias("x"),
        F.explode(F.filter(F.sequence(F.lit(1), F.lit(trees)), lambda t: draw(t) <= limit)).alias("tree_id"),
    ).withColumn("draw", draw(F.col("tree_id")))
    order = Window.partitionBy("tree_id").orderBy("draw", *keys)
    return (
        picked.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= sample_size).select("tree_id", "draw", "x")
    )


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> pd.DataFrame:
    """Random splits until a node is a single point, constant, or at the depth limit."""
    rows: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        members, depth, parent, side = todo.pop()
        node = len(rows)
        rows.append([node, -1, 0.0, node, node, len(members), depth])
        if parent >= 0:
            rows[parent][3 + side] = node
        if depth >= max_depth or len(members) <= 1:
            continue
        sub = x[members]
        low, high = sub.min(axis=0), sub.max(axis=0)
        choices = np.flatnonzero(high > low)
        if len(choices) == 0:
            continue
        f = int(rng.choice(choices))
        cut = float(rng.uniform(low[f], high[f]))
        goes_left = sub[:, f] <= cut
        if goes_left.all():  # the draw can hit the upper end through rounding
            cut = float(low[f])
            goes_left = sub[:, f] <= cut
        rows[node][1], rows[node][2] = f, cut
        todo.append((members[~goes_left], depth + 1, node, 1))
        todo.append((members[goes_left], depth + 1, node, 0))
    return pd.DataFrame(rows, columns=["node_id", "feature", "threshold", "left", "right", "n", "depth"])


def train_nodes(
    scaled: DataFrame, keys: list[str], trees: int = 200, sample_size: int = SAMPLE_SIZE, seed: int = 42
) -> DataFrame:
    """Node table of the forest.  A tree's depth is bounded by the size of its sample."""
    if 2 * trees * sample_size > MAX_NODES:
        raise ValueError(f"trees x 2 x sample_size exceeds {MAX_NODES} nodes; lower one of them")

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree_id"].iloc[0])
        group = group.sort_values("draw", kind="stable")
        depth = max(1, math.ceil(math.log2(max(len(group), 2))))
        nodes = grow_tree(np.stack(group["x"].to_numpy()), np.random.default_rng([seed, tree]), depth)
        nodes.insert(0, "tree_id", tree)
        return nodes

    return tree_samples(scaled, keys, trees, sample_size, seed).groupBy("tree_id").applyInPandas(grow, NODE_TABLE)


# --- model ---------------------------------------------------------------------------------------


@dataclass
class ForestModel:
    """Trained forest as flat arrays: nodes of all trees, scaler and offset."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    n: np.ndarray
    depth: np.ndarray
    mean: dict[str, float]
    scale: dict[str, float]
    offset: float = 0.0
    info: dict = field(default_factory=dict)

    @classmethod
    def from_tables(cls, nodes: DataFrame, scaler: DataFrame, offset: float = 0.0, info: dict | None = None):
        """Collect the node and scaler tables.  Their size is fixed by the model's parameters, which training checks."""
        pdf = nodes.toPandas()
        pdf = pdf.sort_values(["tree_id", "node_id"], kind="stable").reset_index(drop=True)
        is_root = pdf["node_id"].to_numpy() == 0
        roots = np.flatnonzero(is_root)
        base = roots[np.cumsum(is_root) - 1]
        stats = scaler_rows(scaler)
        return cls(
            roots=roots,
            feature=pdf["feature"].to_numpy(dtype=np.int64),
            threshold=pdf["threshold"].to_numpy(dtype=float),
            left=pdf["left"].to_numpy(dtype=np.int64) + base,
            right=pdf["right"].to_numpy(dtype=np.int64) + base,
            n=pdf["n"].to_numpy(dtype=float),
            depth=pdf["depth"].to_numpy(dtype=float),
            mean={k: float(v["mean"]) for k, v in stats.items()},
            scale={k: float(v["scale"]) for k, v in stats.items()},
            offset=offset,
            info=info or {},
        )

    @property
    def sample_size(self) -> float:
        return float(self.n[self.roots].mean())

    def leaf_values(self) -> np.ndarray:
        return self.depth + mean_path(self.n)

    def path_length(self, x: np.ndarray) -> np.ndarray:
        """Mean path length over the trees; all trees descend together."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        split = np.maximum(self.feature, 0)
        for _ in range(int(self.depth.max())):
            goes_left = x[row, split[at]] <= self.threshold[at]
            at = np.where(self.feature[at] < 0, at, np.where(goes_left, self.left[at], self.right[at]))
        return self.leaf_values()[at].mean(axis=1)

    def score_samples(self, x: np.ndarray) -> np.ndarray:
        """Negated anomaly score in [-1, 0)."""
        return -np.power(2.0, -self.path_length(x) / max(float(mean_path(self.sample_size)), 1e-12))

    def standardised(self, features: DataFrame) -> DataFrame:
        matrix = model_matrix(features)
        return matrix.withColumns({c: (F.col(c) - self.mean[c]) / self.scale[c] for c in MODEL_FEATURES})


def score_column(spark: SparkSession, model: ForestModel, standardised_cols: list[Column]) -> Column:
    """Raw score of standardised inputs.  Only the model inputs cross to Python, as Arrow batches."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(*cols: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score_samples(np.column_stack([c.to_numpy(dtype=float) for c in cols])))

    return score(*standardised_cols)


def scaled_inputs(model: ForestModel) -> list[Column]:
    """Standardised model inputs as expressions over the raw feature columns."""
    return [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(model.mean[c])) / F.lit(model.scale[c])
        for c in MODEL_FEATURES
    ]


def train(
    features: DataFrame,
    keys: list[str],
    contamination: float = 0.05,
    trees: int = 200,
    sample_size: int = SAMPLE_SIZE,
    seed: int = 42,
) -> ForestModel:
    """Scaler, forest, and the offset: the contamination quantile of the training scores.

    The quantile is taken over a histogram of scores at six decimals, their stored precision, so it
    never gathers the scores themselves.
    """
    spark = features.sparkSession
    matrix = model_matrix(features).select(*keys, *MODEL_FEATURES)
    scaler = scaler_table(matrix)
    nodes = train_nodes(standardise(matrix, scaler), keys, trees, sample_size, seed)
    model = ForestModel.from_tables(
        nodes, scaler, info={"n_estimators": trees, "contamination": contamination, "seed": seed}
    )
    if len(model.roots) == 0:
        raise ValueError("training data is empty")
    row = (
        matrix.select(F.round(score_column(spark, model, scaled_inputs(model)), 6).alias("s"))
        .groupBy("s")
        .agg(F.count("*").alias("n"))
        .agg(F.percentile("s", contamination, F.col("n")).alias("offset"), F.sum("n").alias("rows"))
        .first()
    )
    model.offset = float(row["offset"])
    model.info["training_rows"] = int(row["rows"])
    return model


_META = "n_estimators int, contamination double, seed int, training_rows bigint, offset double"


def save_model(spark: SparkSession, model: ForestModel, path: str) -> None:
    """Three small tables: nodes, scaler, meta."""
    base = model.roots[np.cumsum(np.isin(np.arange(len(model.n)), model.roots)) - 1]
    nodes = pd.DataFrame(
        {
            "tree_id": np.searchsorted(model.roots, np.arange(len(model.n)), side="right").astype("int32"),
            "node_id": (np.arange(len(model.n)) - base).astype("int32"),
            "feature": model.feature.astype("int32"),
            "threshold": model.threshold,
            "left": (model.left - base).astype("int32"),
            "right": (model.right - base).astype("int32"),
            "n": model.n.astype("int64"),
            "depth": model.depth.astype("int32"),
        }
    )
    full_refresh(spark.createDataFrame(nodes, NODE_TABLE), f"{path}/nodes")
    scaler = [(c, model.mean[c], model.scale[c]) for c in MODEL_FEATURES]
    full_refresh(spark.createDataFrame(scaler, "feature string, mean double, scale double"), f"{path}/scaler")
    i = model.info
    meta = [(i["n_estimators"], i["contamination"], i["seed"], i["training_rows"], model.offset)]
    full_refresh(spark.createDataFrame(meta, _META), f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> ForestModel:
    meta = spark.read.parquet(f"{path}/meta").first().asDict()
    offset = meta.pop("offset")
    return ForestModel.from_tables(
        spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/scaler"), offset, meta
    )
