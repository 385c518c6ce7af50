"""Registered queries for scaling, scoring, the forest and its explanation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.checks import feature_checks as fc
from ledgerlark.checks.support import once_per_session, snap, snap_all, sql_snap
from ledgerlark.functions import scoring as sc
from ledgerlark.functions.reasons import REASON_TEMPLATES
from ledgerlark.operators import attribution as at
from ledgerlark.operators import forest, scaling, scores
from ledgerlark.operators.features import provider_year_features
from ledgerlark.operators.reports import provider_explanation
from ledgerlark.schema import MODEL_FEATURES
from ledgerlark.sources import sample_views as views

KEYS = ["at_physn_npi", "period_year"]
THRESHOLD = 60
_MODELS: dict[tuple[str, str], forest.ForestModel] = {}


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of the sample claims."""

    def build() -> DataFrame:
        return snap_all(
            provider_year_features(
                views.claim_table(spark, sf_dir), views.bene(spark, sf_dir), views.outpatient(spark, sf_dir), batch_id=1
            )
        )

    return once_per_session(spark, sf_dir, "features", build)


def model(spark: SparkSession, sf_dir: str) -> forest.ForestModel:
    """Forest of the feature table, kept for the session: a few megabytes of node arrays."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = forest.train(feature_table(spark, sf_dir), KEYS)
    return _MODELS[key]


def train_snapshot(spark, sf_dir):
    return feature_table(spark, sf_dir)


def model_matrix(spark, sf_dir):
    return scaling.model_matrix(feature_table(spark, sf_dir), batch_id=1).select(*KEYS, *MODEL_FEATURES)


def model_scale(spark, sf_dir):
    return snap_all(scaling.scaler_table(scaling.model_matrix(feature_table(spark, sf_dir))))


def _with_raw(spark, sf_dir) -> DataFrame:
    """Feature rows with a stand-in decision value that SQL can compute too."""
    return feature_table(spark, sf_dir).withColumn(
        "raw", F.lit(1.2) - F.lit(4.0) * F.col("top_hcpcs_code_share") - F.lit(2.0) * F.col("pct_weekend_claims")
    )


def score_normalise(spark, sf_dir):
    rows = _with_raw(spark, sf_dir).withColumn("risk_score", sc.risk_score(F.col("raw")))
    return rows.select(*KEYS, "risk_score", sc.is_flagged(F.col("risk_score"), THRESHOLD).alias("is_flagged"))


def _score_table(spark, sf_dir):
    return scores.score_rows(_with_raw(spark, sf_dir), run_id=1, batch_id=1, threshold=THRESHOLD)


def score_decile(spark, sf_dir):
    return snap_all(_score_table(spark, sf_dir))


def score_metrics(spark, sf_dir):
    return snap_all(sc.metrics(_score_table(spark, sf_dir), threshold=THRESHOLD))


def model_compare(spark, sf_dir):
    rows = _with_raw(spark, sf_dir).withColumn("current_raw", F.col("raw") * 0.9 + F.col("duplicate_rate"))
    return snap_all(sc.spread_comparison(rows, "raw", "current_raw"))


def forest_nodes(spark, sf_dir):
    matrix = scaling.model_matrix(feature_table(spark, sf_dir)).select(*KEYS, *MODEL_FEATURES)
    return forest.train_nodes(scaling.standardise(matrix, scaling.scaler_table(matrix)), KEYS)


def if_train_nodes(spark, sf_dir):
    """Per tree of the grown forest: rows at the root and over the leaves, and whether depth and node count fit."""
    leaf = F.col("feature") < 0
    rows = F.max(F.when(F.col("node_id") == 0, F.col("n")))
    return forest_nodes(spark, sf_dir).groupBy("tree_id").agg(
        rows.alias("root_rows"),
        F.sum(F.when(leaf, F.col("n"))).alias("leaf_rows"),
        (F.max("depth") <= F.ceil(F.log2(F.greatest(rows, F.lit(2)).cast("double")))).alias("depth_fits"),
        (F.count("*") == 2 * F.count_if(leaf) - 1).alias("is_binary"),
    )


def forest_scores(spark, sf_dir, threshold=51):
    return scores.score_batch(feature_table(spark, sf_dir), model(spark, sf_dir), 1, 1, threshold=threshold)


def if_score(spark, sf_dir):
    """Per provider-year scored by the forest: whether score, risk, flag and decile hold together."""
    raw, risk = F.col("isolation_forest_score"), F.col("risk_score")
    again = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(100.0), (1 - raw) / 2 * 100)))
    return forest_scores(spark, sf_dir).select(
        *KEYS,
        ((raw > -1) & (raw < 1)).alias("score_in_range"),
        (risk == again).alias("risk_follows_score"),
        (F.col("is_flagged") == (risk >= 51)).alias("flag_follows_risk"),
        F.col("risk_decile").between(1, 10).alias("decile_in_range"),
    )


def _explained(spark, sf_dir, scored):
    m = model(spark, sf_dir)
    rows = at.flagged_inputs(scored, feature_table(spark, sf_dir), 1)
    return rows.withColumn("contribution", at.shapley_column(spark, m))


def forest_attributions(spark, sf_dir, threshold=51):
    """Attributions of every provider-year the forest flags."""
    keys = [*KEYS, "scoring_run_id"]
    rows = _explained(spark, sf_dir, forest_scores(spark, sf_dir, threshold))
    return at.attribution_rows(at.ranked_contributions(rows, "contribution", keys), keys)


def explain_shapley(spark, sf_dir):
    """Per provider-year (all are explained): attributions, and whether they add up to base minus path length.

    The path length is taken from the forest's score: score = -2 ** (-path / mean path of the sample).
    """
    m = model(spark, sf_dir)
    base = at.LeafPaths.of(m, len(MODEL_FEATURES)).expected()
    unit = float(forest.mean_path(m.sample_size))
    sums = forest_attributions(spark, sf_dir, threshold=0).groupBy(*KEYS).agg(
        F.count("*").alias("attributions"), F.max("feature_rank").alias("last_rank"), F.sum("shap_value").alias("total")
    )
    raw = forest_scores(spark, sf_dir, threshold=0).select(*KEYS, "isolation_forest_score")
    path = -F.log2(-(F.col("isolation_forest_score") + F.lit(m.offset))) * F.lit(unit)
    return sums.join(raw, KEYS).select(*KEYS, "attributions", "last_rank", (F.abs(F.lit(base) - path - F.col("total")) < 1e-6).alias("adds_up"))


def rpt_provider_explain(spark, sf_dir):
    """Drill-through page of the first flagged provider, on the stand-in attributions."""
    rows = at.attribution_rows(_ranked(spark, sf_dir), [*KEYS, "scoring_run_id"])
    first = _score_table(spark, sf_dir).filter("is_flagged").agg(F.min("at_physn_npi").alias("p")).first()["p"]
    return provider_explanation(rows, first or "")


def _ranked(spark, sf_dir):
    """Flagged rows with standard scores standing in for attributions, so that SQL can follow."""
    features = feature_table(spark, sf_dir)
    scaler = scaling.scaler_table(scaling.model_matrix(features))
    rows = at.flagged_inputs(_score_table(spark, sf_dir), features, 1)
    z = scaling.standardise(rows, scaler)
    z = z.select(*KEYS, F.array(*[snap(c) for c in MODEL_FEATURES]).alias("contribution"))
    return at.ranked_contributions(rows.join(z, KEYS), "contribution", [*KEYS, "scoring_run_id"])


def explain_topk(spark, sf_dir):
    return at.attribution_rows(_ranked(spark, sf_dir), [*KEYS, "scoring_run_id"])


def explain_reason_text(spark, sf_dir):
    reasons = at.top_reasons(_ranked(spark, sf_dir), [*KEYS, "scoring_run_id"])
    out = at.attach_reasons(_score_table(spark, sf_dir), reasons, [*KEYS, "scoring_run_id"])
    return out.select(*KEYS, "scoring_run_id", "risk_score", "is_flagged", "top_reason_1", "top_reason_2", "top_reason_3")


QUERIES = {
    f.__name__: f
    for f in (
        train_snapshot,
        model_matrix,
        model_scale,
        score_normalise,
        score_decile,
        score_metrics,
        model_compare,
        if_train_nodes,
        if_score,
        explain_shapley,
        rpt_provider_explain,
        explain_topk,
        explain_reason_text,
    )
}

FEATURES = f"{fc.features_cte()}, batch AS (SELECT *, CAST(1 AS INT) AS batch_id FROM features)"
_K = "at_physn_npi, period_year"
_RAW = "1.2::DOUBLE - 4.0::DOUBLE * top_hcpcs_code_share - 2.0::DOUBLE * pct_weekend_claims"
_RISK = "CAST(trunc(least(greatest((-raw + 1) / 2 * 100, 0.0::DOUBLE), 100.0::DOUBLE)) AS INT)"

SCORED = f"""{FEATURES},
with_raw AS (SELECT *, {_RAW} AS raw FROM batch),
rated AS (SELECT *, {_RISK} AS risk_score FROM with_raw),
edges AS (SELECT list_sort(list_distinct(list_transform(quantile_cont(risk_score, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]), lambda x: round(x, 9)))) AS e FROM rated),
scored AS (SELECT *, risk_score >= {THRESHOLD} AS is_flagged, CAST(1 AS INT) AS scoring_run_id,
                  CAST(CASE WHEN len(e) > 1 THEN greatest(1, len(list_filter(e, lambda x: x < risk_score))) END AS INT) AS risk_decile
           FROM rated, edges)"""

SCORE_TABLE = f"""score_table AS (SELECT at_physn_npi, scoring_run_id, period_year, batch_id, {sql_snap('raw')} AS isolation_forest_score,
  risk_score, risk_decile, is_flagged, total_carrier_claims AS total_claims, distinct_beneficiaries AS distinct_benes,
  {sql_snap('avg_submitted_to_allowed_ratio')} AS avg_submitted_to_allowed_ratio, {sql_snap('duplicate_rate')} AS duplicate_rate,
  {sql_snap('pct_weekend_claims')} AS pct_weekend_claims FROM scored)"""

_STATS = ", ".join(
    f"avg(coalesce({c}, 0)) AS m_{c}, CASE WHEN stddev_pop(coalesce({c}, 0)) > 0 THEN stddev_pop(coalesce({c}, 0)) ELSE 1 END AS s_{c}"
    for c in MODEL_FEATURES
)
_LONG = " UNION ALL ".join(
    f"SELECT {_K}, scoring_run_id, '{c}' AS feature_name, {sql_snap(f'(coalesce({c}, 0) - m_{c}) / s_{c}')} AS shap_value,"
    f" CAST(coalesce({c}, 0) AS DOUBLE) AS feature_value FROM scored, stats WHERE is_flagged"
    for c in MODEL_FEATURES
)
_RANKED = f"""stats AS (SELECT {_STATS} FROM batch), long AS ({_LONG}),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY {_K} ORDER BY abs(shap_value) DESC, feature_name) AS INT) AS feature_rank FROM long)"""


def _reason_sql() -> str:
    def piece(template: str) -> str:
        sql = "'" + template.replace("'", "''") + "'"
        sql = sql.replace("{direction}", "' || CASE WHEN shap_value > 0 THEN 'above' ELSE 'below' END || '")
        for spec in (":.0f", ":.1f", ":.2f", ":.3f", ":+.1f"):
            sql = sql.replace("{value%s}" % spec, f"' || printf('%{spec[1:]}', feature_value) || '")
        for spec in (":.0%", ":.2%"):
            sql = sql.replace("{value%s}" % spec, f"' || printf('%{spec[1:-1]}f', feature_value * 100) || '%")
        return sql

    return "CASE feature_name " + " ".join(f"WHEN '{f}' THEN {piece(t)}" for f, t in REASON_TEMPLATES.items()) + " END"


ORACLE = {
    "train_snapshot": f"WITH {FEATURES} SELECT * FROM batch",
    "model_matrix": f"WITH {FEATURES} SELECT {_K}, "
    + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in MODEL_FEATURES)
    + " FROM batch WHERE batch_id = 1",
    "model_scale": f"WITH {FEATURES} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {sql_snap(f'avg(coalesce({c}, 0))')} AS mean,"
        f" {sql_snap(f'CASE WHEN stddev_pop(coalesce({c}, 0)) > 0 THEN stddev_pop(coalesce({c}, 0)) ELSE 1 END')} AS scale FROM batch"
        for c in MODEL_FEATURES
    ),
    "score_normalise": f"WITH {SCORED} SELECT {_K}, risk_score, is_flagged FROM scored",
    "score_decile": f"WITH {SCORED}, {SCORE_TABLE} SELECT * FROM score_table",
    "score_metrics": f"WITH {SCORED} SELECT {sql_snap('avg(risk_score)')} AS avg_anomaly_score,"
    f" {sql_snap('avg(CAST(is_flagged AS INT))')} AS pct_flagged, count(*) AS training_rows FROM scored",
    "model_compare": f"WITH {SCORED}, two AS (SELECT stddev_pop(raw) AS n, stddev_pop(raw * 0.9::DOUBLE + duplicate_rate) AS c FROM scored)"
    f" SELECT {sql_snap('n')} AS new_spread, {sql_snap('c')} AS current_spread, {sql_snap('n - c')} AS improvement, n - c >= 0.01 AS promote FROM two",
    "if_train_nodes": f"WITH {FEATURES}, k AS (SELECT least(256, count(*)) AS n FROM batch) SELECT CAST(tree AS INT) AS tree_id, CAST(n AS BIGINT) AS root_rows,"
    " CAST(n AS BIGINT) AS leaf_rows, true AS depth_fits, true AS is_binary FROM k, range(1, 201) AS t(tree)",
    "if_score": f"WITH {FEATURES} SELECT {_K}, true AS score_in_range, true AS risk_follows_score, true AS flag_follows_risk, true AS decile_in_range FROM batch",
    "explain_shapley": f"WITH {FEATURES} SELECT {_K}, CAST({len(MODEL_FEATURES)} AS BIGINT) AS attributions, CAST({len(MODEL_FEATURES)} AS INT) AS last_rank, true AS adds_up FROM batch",
    "rpt_provider_explain": f"WITH {SCORED}, {_RANKED} SELECT * FROM ranked WHERE at_physn_npi = (SELECT min(at_physn_npi) FROM scored WHERE is_flagged)",
    "explain_topk": f"WITH {SCORED}, {_RANKED} SELECT * FROM ranked",
    "explain_reason_text": f"WITH {SCORED}, {_RANKED}, texts AS (SELECT *, {_reason_sql()} AS reason FROM ranked)"
    f" SELECT {_K}, scoring_run_id, risk_score, is_flagged,"
    + ", ".join(
        f" (SELECT max(reason) FROM texts t WHERE t.at_physn_npi = s.at_physn_npi AND t.period_year = s.period_year AND feature_rank = {i}) AS top_reason_{i}"
        for i in (1, 2, 3)
    )
    + " FROM scored s",
}
