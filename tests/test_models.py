"""Isolation forest, attributions, scenarios and the supervised benchmark."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.functions.reasons import REASON_TEMPLATES, reason_text
from ledgerlark.operators import attribution, forest, inject, supervised
from ledgerlark.operators.scaling import model_matrix, scaler_table, standardise
from ledgerlark.schema import MODEL_FEATURES

KEYS = ["at_physn_npi", "period_year"]


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        x = rng.normal(size=len(MODEL_FEATURES)) + (6.0 if i < 8 else 0.0)
        x[2] = math.nan if i % 10 == 0 else x[2]
        rows.append((f"P{i:03d}", 2008, 1, *[None if math.isnan(v) else float(v) for v in x]))
    cols = ", ".join(f"{c} double" for c in MODEL_FEATURES)
    df = spark.createDataFrame(rows, f"at_physn_npi string, period_year int, batch_id int, {cols}")
    return df.withColumn("avg_submitted_charge", F.lit(10.0)).persist()


@pytest.fixture(scope="module")
def model(spark, features):
    return forest.train(features, KEYS, trees=30, sample_size=64)


def test_scaler_equals_numpy(spark, features):
    matrix = model_matrix(features)
    x = np.array(matrix.select(*MODEL_FEATURES).collect(), dtype=float)
    scaler = {r.feature: (r["mean"], r.scale) for r in scaler_table(matrix).collect()}
    for j, c in enumerate(MODEL_FEATURES):
        assert scaler[c] == (pytest.approx(x[:, j].mean(), abs=1e-9), pytest.approx(x[:, j].std(), abs=1e-9))
    constant = matrix.withColumn(MODEL_FEATURES[0], F.lit(3.0))
    assert {r.feature: r.scale for r in scaler_table(constant).collect()}[MODEL_FEATURES[0]] == 1.0
    z = standardise(matrix, scaler_table(matrix)).agg(F.avg(MODEL_FEATURES[1]), F.stddev_pop(MODEL_FEATURES[1])).first()
    assert (z[0], z[1]) == (pytest.approx(0, abs=1e-9), pytest.approx(1))


def test_tree_shapes(spark, features):
    nodes = forest.train_nodes(model_matrix(features), KEYS, trees=10, sample_size=64).toPandas()
    assert nodes["tree_id"].nunique() == 10 and nodes["depth"].max() <= 6
    for _, tree in nodes.groupby("tree_id"):
        assert tree.loc[tree.node_id == 0, "n"].item() == 64
        leaves = tree[tree.feature < 0]
        assert leaves["n"].sum() == 64 and (leaves["n"] > 0).all()
        inner = tree[tree.feature >= 0].set_index("node_id")
        sizes = tree.set_index("node_id")["n"]
        assert all(sizes[r.left] + sizes[r.right] == r.n for r in inner.itertuples())


def test_training_does_not_depend_on_partitioning(spark, features):
    one = forest.train_nodes(model_matrix(features).repartition(1), KEYS, trees=5, sample_size=32)
    many = forest.train_nodes(model_matrix(features).repartition(9), KEYS, trees=5, sample_size=32)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_scores(spark, features, model, tmp_path):
    score = forest.score_column(spark, model, forest.scaled_inputs(model))
    rows = features.select("at_physn_npi", score.alias("s")).toPandas()
    assert ((rows.s >= -1) & (rows.s < 0)).all()
    assert set(rows.nsmallest(8, "s").at_physn_npi) == {f"P{i:03d}" for i in range(8)}
    assert model.offset == pytest.approx(np.percentile(rows.s, 5), abs=2e-6)
    forest.save_model(spark, model, str(tmp_path / "m"))
    again = forest.load_model(spark, str(tmp_path / "m"))
    x = np.random.default_rng(1).normal(size=(50, len(MODEL_FEATURES)))
    assert np.allclose(again.score_samples(x), model.score_samples(x)) and again.offset == model.offset


def _brute_shapley(model, x, width):
    """Shapley values of the path-dependent expectation, by enumerating feature subsets."""
    values = model.leaf_values() / len(model.roots)

    def expect(node, known):
        f = model.feature[node]
        if f < 0:
            return values[node]
        left, right = model.left[node], model.right[node]
        if f in known:
            return expect(left if x[f] <= model.threshold[node] else right, known)
        return (model.n[left] * expect(left, known) + model.n[right] * expect(right, known)) / model.n[node]

    def v(known):
        return sum(expect(r, known) for r in model.roots)

    out = np.zeros(width)
    for f in range(width):
        others = [g for g in range(width) if g != f]
        for k in range(width):
            w = math.factorial(k) * math.factorial(width - k - 1) / math.factorial(width)
            for s in itertools.combinations(others, k):
                out[f] += w * (v({*s, f}) - v(set(s)))
    return out


def _random_forest(rng, width, trees, sample, depth):
    parts = []
    for tree in range(trees):
        nodes = forest.grow_tree(rng.normal(size=(sample, width)), np.random.default_rng(tree), depth)
        base = sum(len(p) for p in parts)
        nodes["left"] += base
        nodes["right"] += base
        parts.append(nodes)
    import pandas as pd

    roots = np.cumsum([0] + [len(p) for p in parts[:-1]])
    pdf = pd.concat(parts, ignore_index=True)
    return forest.ForestModel(
        roots, *(pdf[c].to_numpy() for c in ("feature", "threshold", "left", "right")), pdf["n"].to_numpy(float), pdf["depth"].to_numpy(float), {}, {}
    )


@pytest.mark.parametrize("bits,room", [(8, 10**6), (8, 0), (3, 10**6), (0, 10**6)])
def test_shapley_values_equal_the_definition(monkeypatch, bits, room):
    monkeypatch.setattr(attribution, "TABLE_BITS", bits)
    monkeypatch.setattr(attribution, "_PATTERNS_AT_ONCE", 2)
    rng = np.random.default_rng(3)
    width = 4
    m = _random_forest(rng, width, 3, 40, 5)
    x = rng.normal(size=(5, width))
    paths = attribution.LeafPaths.of(m, width)
    paths.room = room
    assert (paths.shapley(x) == paths.shapley(x)).all()  # tables built, then read
    got = paths.shapley(x)
    for i in range(len(x)):
        assert np.allclose(got[i], _brute_shapley(m, x[i], width))
    assert np.allclose(got.sum(axis=1) + paths.expected(), m.path_length(x))


def _leaf_by_leaf(model, x, width):
    """The formula as it stands: every leaf, every row, by quadrature with points to spare."""
    values = model.leaf_values() / len(model.roots)
    points, weights = np.polynomial.legendre.leggauss(width + 2)
    points, weights = (points + 1) / 2, weights / 2
    out = np.zeros((len(x), width))
    for root in model.roots:
        todo = [(int(root), {})]
        while todo:
            node, path = todo.pop()
            f = int(model.feature[node])
            if f >= 0:
                z, o = path.get(f, (1.0, np.ones(len(x), dtype=bool)))
                for child, passes in ((model.left[node], x[:, f] <= model.threshold[node]), (model.right[node], x[:, f] > model.threshold[node])):
                    todo.append((int(child), {**path, f: (z * model.n[child] / model.n[node], o & passes)}))
                continue
            for j, (z, o) in path.items():
                rest = np.ones((len(x), len(points)))
                for k, (zk, ok) in path.items():
                    if k != j:
                        rest *= zk * (1 - points) + ok[:, None] * points
                out[:, j] += values[node] * (o - z) * (rest @ weights)
    return out


@pytest.mark.parametrize("width,sample,depth", [(18, 256, 8), (18, 2000, 14), (3, 256, 8), (1, 16, 4)])
def test_shapley_values_of_a_forest_equal_the_formula(width, sample, depth):
    rng = np.random.default_rng(width + depth)
    m = _random_forest(rng, width, 4, sample, depth)
    x = rng.normal(size=(70, width))
    assert np.abs(attribution.LeafPaths.of(m, width).shapley(x) - _leaf_by_leaf(m, x, width)).max() < 1e-9
    assert attribution.LeafPaths.of(m, width).shapley(x[:0]).shape == (0, width)


def test_attributions_add_up(spark, features, model):
    rows = features.select(*KEYS, attribution.shapley_column(spark, model).alias("phi"), *[c.alias(f"z{i}") for i, c in enumerate(forest.scaled_inputs(model))]).limit(40).collect()
    base = attribution.LeafPaths.of(model, len(MODEL_FEATURES)).expected()
    x = np.array([[r[f"z{i}"] for i in range(len(MODEL_FEATURES))] for r in rows])
    assert np.allclose([base - sum(r.phi) for r in rows], model.path_length(x))


def test_ranked_rows_and_reasons(spark, features):
    flagged = features.filter("at_physn_npi = 'P001'").fillna(0.0)
    contributions = F.array(*[F.lit(float((-1) ** i * (i % 5))) for i in range(len(MODEL_FEATURES))])
    ranked = attribution.ranked_contributions(flagged.withColumn("c", contributions), "c", KEYS)
    rows = attribution.attribution_rows(ranked, KEYS).orderBy("feature_rank").collect()
    assert [r.feature_rank for r in rows] == list(range(1, 19))
    assert [abs(r.shap_value) for r in rows] == sorted((abs(r.shap_value) for r in rows), reverse=True)
    reasons = attribution.top_reasons(ranked, KEYS).first()
    assert all(reasons[f"top_reason_{i}"] for i in (1, 2, 3))


@pytest.mark.parametrize("value", [0.0, 3.14159, 12.3456, 0.98765, 0.125, 0.625, 0.005, 2.25, -2.25, 2.675, 0.5, 1.5, -0.04, 1234567.5])
def test_reason_texts_equal_python_formatting(spark, value):
    df = spark.createDataFrame([(f, 1.0, value) for f in [*REASON_TEMPLATES, "other"]], "f string, c double, v double")
    for r in df.select("f", reason_text(F.col("f"), F.col("c"), F.col("v")).alias("t")).collect():
        template = REASON_TEMPLATES.get(r.f, f"Feature '{r.f}' value {{value:.4f}} ({{direction}} expected)")
        assert r.t == template.format(value=value, direction="above")


def _claims(spark, n=40):
    return spark.range(400 * 3).select(
        F.concat(F.lit("c"), "id").alias("clm_id"),
        F.format_string("P%03d", F.col("id") % 400).alias("at_physn_npi"),
        F.lit("b").alias("desynpuf_id"),
        F.date_add(F.lit("2008-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("clm_from_dt"),
        F.lit(100).cast("decimal(14,2)").alias("submitted_charge_amt"),
        F.lit(100).cast("decimal(14,2)").alias("allowed_amt"),
        F.lit("0.5").cast("decimal(18,4)").alias("submitted_to_allowed_ratio"),
        F.when(F.col("id") % 2 == 0, "99213").otherwise("X").alias("primary_hcpcs_cd"),
    )


def test_scenarios(spark, features):
    rows = inject.all_scenarios(_claims(spark), features).persist()
    counts = {r.scenario: (r.n, r.hit) for r in rows.groupBy("scenario").agg(F.count("*").alias("n"), F.sum("label").alias("hit")).collect()}
    assert counts == {"upcoding": (400, 16), "phantom_billing": (400, 12), "duplicate_submission": (400, 12)}
    up = rows.filter("scenario = 'upcoding'")
    hit = up.filter("label = 1").agg(F.min("avg_submitted_charge"), F.max("avg_submitted_charge")).first()
    assert 100 <= hit[0] <= hit[1] <= 140
    assert up.filter("label = 0 AND avg_submitted_charge <> 10").isEmpty()
    before = {r.at_physn_npi: r for r in features.collect()}
    for r in rows.filter("label = 1 AND scenario <> 'upcoding'").collect():
        old = before[r.at_physn_npi]
        col = "near_duplicate_count" if r.scenario == "phantom_billing" else "exact_duplicate_count"
        assert r[col] == pytest.approx(old[col] + 1)
        assert r.duplicate_rate == pytest.approx((old[col] + 1) / max(old.total_carrier_claims + 1, 1))
    targets = inject.target_providers(features, "phantom_billing", 0.03)
    moved = inject.phantom_claims(_claims(spark), targets).join(_claims(spark).select("clm_id", F.col("clm_from_dt").alias("d")), "clm_id")
    assert moved.count() == 12 and moved.filter(~F.date_diff("clm_from_dt", "d").between(1, 5)).isEmpty()


def test_split_and_boosting(spark, features, tmp_path):
    rows = inject.all_scenarios(_claims(spark), features)
    unique = supervised.one_year_per_scenario(rows)
    marked = supervised.split(unique).persist()
    by_label = {r.label: (r.n, r.t) for r in marked.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert by_label == {0: (1160, 232), 1: (40, 8)}
    grouped = supervised.split(unique, group_by_provider=True)
    assert grouped.groupBy("at_physn_npi").agg(F.count_distinct("is_test").alias("n")).filter("n > 1").isEmpty()
    params = {"maxIter": 4, "maxDepth": 4}
    fitted, scaler = supervised.fit(marked, params)
    model = supervised.BoostedModel.from_tables(supervised.node_table(fitted, spark), scaler)
    assert len(model.roots) == 4 and model.weight.tolist() == list(fitted.treeWeights)
    held_out = marked.filter("is_test")
    out = {(r.at_physn_npi, r.scenario): r.prob for r in supervised.predict(model, held_out).collect()}
    whole = fitted.transform(supervised._vectors(supervised.standardise(supervised.model_matrix(held_out), scaler)))
    own = {(r.at_physn_npi, r.scenario): float(r.probability[1]) for r in whole.select("at_physn_npi", "scenario", "probability").collect()}
    assert len(out) == 240 and out.keys() == own.keys() and max(abs(out[k] - own[k]) for k in own) < 1e-9
    assert np.abs(model.importances() - fitted.featureImportances.toArray()).max() < 1e-9
    assert len({round(p, 6) for p in out.values()}) > 1
    supervised.save_model(spark, model, str(tmp_path / "boosted"))
    again = supervised.load_model(spark, str(tmp_path / "boosted"))
    x = np.random.default_rng(2).normal(size=(40, len(MODEL_FEATURES)))
    assert np.array_equal(again.probability(x), model.probability(x)) and again.mean == model.mean and again.scale == model.scale
    assert supervised.importances(spark, again, top=5).count() == 5


def test_metrics_with_empty_classes(spark):
    df = spark.createDataFrame([("s", 0, 0.1), ("s", 0, 0.2), ("t", 1, 0.9), ("t", 0, 0.9)], "scenario string, label int, prob double")
    got = {r.scenario: r for r in supervised.metrics_by_scenario(df).collect()}
    assert (got["s"].precision, got["s"].recall, got["s"].f1, got["s"].auc_roc) == (0.0, 0.0, 0.0, None)
    assert (got["t"].precision, got["t"].recall, got["t"].auc_roc) == (0.5, 1.0, 0.5)
