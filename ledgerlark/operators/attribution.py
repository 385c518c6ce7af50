"""Per-feature attribution of forest scores: exact path-dependent tree Shapley values.

For one leaf with value v, let feature j on its path have the share z_j of training rows that the path
keeps at j's splits, and o_j = 1 if the row itself passes them, else 0.  The Shapley value of j is

    v (o_j - z_j) * integral over q in [0, 1] of  prod_{k != j} (z_k (1 - q) + o_k q)  dq

The integrand is a polynomial whose degree is below the number of features on the path, so a
Gauss-Legendre rule of half that many points is exact.

The row enters by the bits o_k only, and leaves of one small subtree share most of them: the bits of the features on the
path to the subtree and the outcomes of the tests inside it.  So the tree is walked once for all rows, one comparison a node,
which leaves each row with a bit pattern per subtree; the subtree's attributions are tabled once per pattern and
looked up.  Values refer to the mean path length; a short path means high risk, so the reported
attribution is the negative.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.reasons import reason_text
from ledgerlark.operators.forest import ForestModel, scaled_inputs
from ledgerlark.schema import MODEL_FEATURES

#: Bits of a tabled pattern.  Leaves with more features on their path are computed for the patterns that rows have.
TABLE_BITS = 8
#: Kept tables, in numbers (8 bytes each); what does not fit is built again for every batch of rows.
TABLE_ROOM = 4_000_000
_PATTERNS_AT_ONCE = 4096


@dataclass
class Subtree:
    """Leaves that share a bit pattern: per leaf its value and, per feature on its path, kept share and the bits it has to pass."""

    root: int
    bits: int
    leaves: list[tuple[float, dict[int, tuple[float, list[tuple[int, bool]]]]]]

    def table(self, patterns: np.ndarray) -> tuple[list[int], np.ndarray]:
        """(features, attributions) with one row per feature and one column per pattern."""
        features = sorted({f for _, path in self.leaves for f in path})
        row = {f: i for i, f in enumerate(features)}
        out = np.zeros((len(features), len(patterns)))
        for value, path in self.leaves:
            if not path:
                continue
            points, weights = np.polynomial.legendre.leggauss((len(path) + 1) // 2)
            points, weights = (points + 1) / 2, weights / 2
            kept = np.array([z for z, _ in path.values()])[:, None]
            passes = np.ones((len(path), len(patterns)))
            for i, (_, needed) in enumerate(path.values()):
                for bit, wanted in needed:
                    passes[i] *= (patterns >> bit & 1) == wanted
            factor = kept[..., None] * (1 - points) + passes[..., None] * points
            integral = (factor.prod(axis=0) / factor) @ weights
            out[[row[f] for f in path]] += value * (passes - kept) * integral
        return features, out


@dataclass
class LeafPaths:
    """The forest's trees, cut into subtrees of few bits."""

    model: ForestModel
    features: int
    subtrees: dict[int, Subtree]
    base: float
    tables: dict[int, tuple[list[int], np.ndarray]] = field(default_factory=dict)
    room: int = TABLE_ROOM

    @classmethod
    def of(cls, model: ForestModel, features: int) -> LeafPaths:
        tests = np.zeros(len(model.feature), dtype=np.int64)  # below and at each node; children follow their parents
        for node in range(len(tests) - 1, -1, -1):
            if model.feature[node] >= 0:
                tests[node] = 1 + tests[model.left[node]] + tests[model.right[node]]
        values = model.leaf_values() / len(model.roots)
        subtrees, base = {}, 0.0

        def collect(node: int, bits: dict[int, int]) -> Subtree:
            made = Subtree(node, len(bits), [])
            todo = [(node, {f: (z, [(bit, True)]) for f, (bit, z) in bits.items()})]
            while todo:
                at, path = todo.pop()
                f = int(model.feature[at])
                if f < 0:
                    made.leaves.append((float(values[at]), path))
                    continue
                bit, made.bits = made.bits, made.bits + 1
                z, needed = path.get(f, (1.0, []))
                for child, wanted in ((int(model.right[at]), False), (int(model.left[at]), True)):
                    todo.append((child, {**path, f: (z * float(model.n[child] / model.n[at]), [*needed, (bit, wanted)])}))
            return made

        for root in model.roots:
            todo = [(int(root), {})]
            while todo:
                node, bits = todo.pop()
                f = int(model.feature[node])
                if f < 0 or len(bits) + tests[node] <= TABLE_BITS:
                    subtrees[node] = made = collect(node, bits)
                    base += sum(v * float(np.prod([z for z, _ in path.values()])) for v, path in made.leaves)
                    continue
                bit, z = bits.get(f, (len(bits), 1.0))
                for child in (int(model.right[node]), int(model.left[node])):
                    todo.append((child, {**bits, f: (bit, z * float(model.n[child] / model.n[node]))}))
        return cls(model, features, subtrees, base)

    def expected(self) -> float:
        """Mean path length of the training sample: the base all attributions start from."""
        return self.base

    def _patterns(self, x: np.ndarray) -> Iterator[tuple[Subtree, np.ndarray]]:
        """Each subtree with the pattern of every row (``x``: one row per feature)."""
        m = self.model
        for root in m.roots:
            todo = [(int(root), np.zeros(x.shape[1], dtype=np.uint32), {})]
            while todo:
                node, pattern, bits = todo.pop()
                if (tree := self.subtrees.get(node)) is not None:
                    inside, bit = [node], len(bits)
                    while inside:  # in the order in which the bits were given
                        at = inside.pop()
                        if (f := int(m.feature[at])) >= 0:
                            pattern = pattern | (x[f] <= m.threshold[at]).astype(np.uint32) << np.uint32(bit)
                            bit += 1
                            inside += [int(m.right[at]), int(m.left[at])]
                    yield tree, pattern
                    continue
                f = int(m.feature[node])
                left = x[f] <= m.threshold[node]
                known = f in bits
                bit = np.uint32(bits.get(f, len(bits)))
                bits = {**bits, f: int(bit)}
                for child, goes in ((int(m.right[node]), ~left), (int(m.left[node]), left)):
                    if known:
                        own = pattern & ~((~goes).astype(np.uint32) << bit)
                    else:
                        own = pattern | goes.astype(np.uint32) << bit
                    todo.append((child, own, bits))

    def with_tables(self) -> LeafPaths:
        """Build the tables beforehand, up to their bound, so that they are sent once instead of built by every task."""
        for tree in self.subtrees.values():
            if self.room > 0 and tree.bits <= TABLE_BITS and tree.root not in self.tables:
                self._table(tree)
        return self

    def _table(self, tree: Subtree) -> tuple[list[int], np.ndarray]:
        if (entry := self.tables.get(tree.root)) is None:
            entry = tree.table(np.arange(1 << tree.bits, dtype=np.uint32))
            if entry[1].size <= self.room:
                self.room -= entry[1].size
                self.tables[tree.root] = entry
        return entry

    def shapley(self, x: np.ndarray) -> np.ndarray:
        """(rows, features) attributions of the mean path length."""
        out = np.zeros((self.features, len(x)))
        for tree, pattern in self._patterns(np.ascontiguousarray(x.T)):
            if tree.bits <= TABLE_BITS:
                features, values = self._table(tree)
                at = pattern.astype(np.intp)
                for f, v in zip(features, values, strict=True):
                    out[f] += v[at]
                continue
            distinct, at = np.unique(pattern, return_inverse=True)
            for start in range(0, len(distinct), _PATTERNS_AT_ONCE):
                features, values = tree.table(distinct[start : start + _PATTERNS_AT_ONCE])
                mine = np.flatnonzero((at >= start) & (at < start + _PATTERNS_AT_ONCE))
                for f, v in zip(features, values, strict=True):
                    out[f, mine] += v[at[mine] - start]
        return out.T


def shapley_column(spark: SparkSession, model: ForestModel) -> Column:
    """Array of risk attributions, in model feature order, from the raw feature columns."""
    shared = spark.sparkContext.broadcast(LeafPaths.of(model, len(MODEL_FEATURES)).with_tables())

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def shap(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        return pd.Series(list(-shared.value.shapley(x)))

    return shap(*scaled_inputs(model))


def flagged_inputs(scores: DataFrame, features: DataFrame, run_id: int) -> DataFrame:
    """Flagged rows of one run with their feature values of the same year."""
    flagged = scores.filter((F.col("scoring_run_id") == run_id) & F.col("is_flagged")).select(
        "at_physn_npi", "period_year", "scoring_run_id"
    )
    inputs = features.select(
        "at_physn_npi", "period_year", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in MODEL_FEATURES]
    )
    return flagged.join(inputs, ["at_physn_npi", "period_year"], "left").fillna(0.0, MODEL_FEATURES)


def ranked_contributions(rows: DataFrame, contributions: str, keys: list[str]) -> DataFrame:
    """Adds ``ranked``: array of (feature_name, shap_value, feature_value), largest size first.

    Ranking happens inside the row, so it costs no shuffle.  Ties go by feature name.
    """
    items = F.arrays_zip(
        F.array(*[F.lit(c) for c in MODEL_FEATURES]).alias("name"),
        F.col(contributions).alias("shap"),
        F.array(*MODEL_FEATURES).alias("value"),
    )
    keyed = F.transform(
        items,
        lambda i: F.struct(
            (-F.abs(i["shap"])).alias("order"),
            i["name"].alias("feature_name"),
            i["shap"].alias("shap_value"),
            i["value"].alias("feature_value"),
        ),
    )
    return rows.select(*keys, F.array_sort(keyed).alias("ranked"))


def attribution_rows(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """Long form: one row per feature with its rank."""
    return ranked.select(*keys, F.posexplode("ranked").alias("_p", "_c")).select(
        *keys, "_c.feature_name", "_c.shap_value", "_c.feature_value", (F.col("_p") + 1).alias("feature_rank")
    )


def top_reasons(ranked: DataFrame, keys: list[str], top: int = 3) -> DataFrame:
    """top_reason_1..n per row."""

    def text(i: int) -> Column:
        c = F.get("ranked", F.lit(i))
        return reason_text(c["feature_name"], c["shap_value"], c["feature_value"]).alias(f"top_reason_{i + 1}")

    return ranked.select(*keys, *[text(i) for i in range(top)])


def attach_reasons(scores: DataFrame, reasons: DataFrame, keys: list[str]) -> DataFrame:
    """Scores with the reason columns filled where there are any."""
    names = [c for c in reasons.columns if c not in keys]
    base = scores.drop(*names)
    return base.join(reasons, keys, "left")
