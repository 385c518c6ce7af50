"""Registered queries for injected scenarios and the supervised benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.checks.score_checks import FEATURES, feature_table
from ledgerlark.checks.support import once_per_session, snap, snap_all, sql_snap
from ledgerlark.operators import inject as inj
from ledgerlark.operators import supervised as sup
from ledgerlark.schema import MODEL_FEATURES
from ledgerlark.session import scratch_path
from ledgerlark.sources import sample_views as views
from ledgerlark.sources.tables import path_exists

# Codes of the test tables that stand in for the real pairs.
CODES = {"ECONOMY": "STANDARD", "PROMO": "LARGE"}
SHOWN = (
    "at_physn_npi", "period_year", "avg_submitted_charge", "avg_submitted_to_allowed_ratio", "near_duplicate_count",
    "exact_duplicate_count", "duplicate_rate", "label", "scenario",
)


def inj_targets(spark, sf_dir):
    features = feature_table(spark, sf_dir)
    out = None
    for scenario, rate in (
        ("upcoding", inj.UPCODING_RATE),
        ("phantom_billing", inj.PHANTOM_RATE),
        ("duplicate_submission", inj.DUPLICATE_RATE),
    ):
        part = inj.target_providers(features, scenario, rate).withColumn("scenario", F.lit(scenario))
        out = part if out is None else out.unionByName(part)
    return out


def inj_upcoding(spark, sf_dir):
    return snap_all(inj.upcoding(views.claim_table(spark, sf_dir), feature_table(spark, sf_dir), codes=CODES).select(*SHOWN), 4)


def inj_phantom_rows(spark, sf_dir):
    targets = inj.target_providers(feature_table(spark, sf_dir), "phantom_billing", inj.PHANTOM_RATE)
    rows = inj.phantom_claims(views.claim_table(spark, sf_dir), targets)
    return snap_all(rows.select("clm_id", "at_physn_npi", "desynpuf_id", "clm_from_dt", "primary_hcpcs_cd", "allowed_amt"))


def inj_phantom(spark, sf_dir):
    return snap_all(inj.phantom_billing(views.claim_table(spark, sf_dir), feature_table(spark, sf_dir)).select(*SHOWN), 4)


def inj_duplicates(spark, sf_dir):
    return snap_all(inj.duplicate_submission(views.claim_table(spark, sf_dir), feature_table(spark, sf_dir)).select(*SHOWN), 4)


def labelled(spark, sf_dir) -> DataFrame:
    """All scenarios stacked."""
    return once_per_session(
        spark,
        sf_dir,
        "labelled",
        lambda: inj.all_scenarios(views.claim_table(spark, sf_dir), feature_table(spark, sf_dir), codes=CODES),
    )


def inj_union(spark, sf_dir):
    return snap_all(labelled(spark, sf_dir).select(*SHOWN), 4)


def inj_label_rate(spark, sf_dir):
    return snap_all(inj.label_rate(labelled(spark, sf_dir)))


def sup_dedup(spark, sf_dir):
    return snap_all(sup.one_year_per_scenario(labelled(spark, sf_dir).select(*SHOWN)), 4)


def _split(spark, sf_dir):
    return sup.split(sup.one_year_per_scenario(labelled(spark, sf_dir)))


def sup_split(spark, sf_dir):
    return _split(spark, sf_dir).select("at_physn_npi", "scenario", "label", "is_test")


def _stand_in(spark, sf_dir):
    """Every labelled row with a probability that SQL can compute too; three decimals make ties."""
    rows = labelled(spark, sf_dir)
    u = inj.unit_value(inj.keyed_hash(42, "prob", "at_physn_npi", "scenario", "period_year"))
    return rows.select("at_physn_npi", "scenario", "label", snap(u * 0.7 + F.col("label") * 0.3, 3).alias("prob"))


def sup_metrics(spark, sf_dir):
    return snap_all(sup.overall_metrics(_stand_in(spark, sf_dir)))


def sup_report(spark, sf_dir):
    return snap_all(sup.report(_stand_in(spark, sf_dir)))


def sup_auc(spark, sf_dir):
    return snap_all(sup.auc_by_group(_stand_in(spark, sf_dir), [], "prob", "label"))


def sup_metrics_by_scenario(spark, sf_dir):
    return snap_all(sup.metrics_by_scenario(_stand_in(spark, sf_dir)))


#: Floors on the training rows: a model that gives every row the same probability, or ignores the injected labels, falls below them.
AUC_FLOOR, RECALL_FLOOR = 0.9, 0.9


def boosted_model(spark, sf_dir) -> sup.BoostedModel:
    """The full boosted model over the split rows: trained once in a session and stored as tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS or not path_exists(spark, f"{_MODELS[key]}/nodes/current"):
        path = scratch_path(spark, "boosted")
        rows = once_per_session(spark, sf_dir, "split", lambda: _split(spark, sf_dir))
        sup.save_model(spark, sup.train(rows), path)
        _MODELS[key] = path
    return sup.load_model(spark, _MODELS[key])


_MODELS: dict[tuple, str] = {}


def _scored(spark, sf_dir):
    """All split rows with the stored model's probability and whether they were held out."""
    rows = once_per_session(spark, sf_dir, "split", lambda: _split(spark, sf_dir))
    scored = sup.predict(boosted_model(spark, sf_dir), rows)
    return scored.join(rows.select("at_physn_npi", "scenario", "is_test"), ["at_physn_npi", "scenario"])


def sup_gbt(spark, sf_dir):
    """Held-out rows scored by the boosted model: labels, whether the probability is one and is not that of every split row."""
    scored = _scored(spark, sf_dir)
    spread = scored.agg(F.max("prob") - F.min("prob")).scalar()
    return scored.filter("is_test").select("at_physn_npi", "scenario", "label", (F.col("prob").between(0, 1) & (spread > 0.01)).alias("prob_in_range"))


def sup_quality(spark, sf_dir):
    """What the model has learned, per scenario of its training rows: whether it finds the injected labels at the cut, and whether the
    area under the curve is above its floor.  A scenario without a label, or without a row of the other class, has nothing to miss."""
    own = sup.metrics_by_scenario(_scored(spark, sf_dir).filter("NOT is_test"))
    return own.select(
        "scenario",
        "anomalies",
        ((F.col("recall") >= RECALL_FLOOR) | (F.col("anomalies") == 0)).alias("recall_above_floor"),
        F.coalesce(F.col("auc_roc") >= AUC_FLOOR, F.lit(True)).alias("auc_above_floor"),
    )


def sup_importances(spark, sf_dir):
    """Per model input: whether its importance is a share, whether the shares add up to one, and whether the inputs that no scenario
    changes all stay below the most important one."""
    rows = sup.importances(spark, boosted_model(spark, sf_dir))
    total, top = rows.agg(F.sum("importance")).scalar(), rows.agg(F.max("importance")).scalar()
    return rows.select("feature", F.col("importance").between(0, 1).alias("is_share"), ((F.abs(total - 1) < 1e-9) & (top < 1)).alias("adds_up"))


QUERIES = {
    f.__name__: f
    for f in (
        inj_targets,
        inj_upcoding,
        inj_phantom_rows,
        inj_phantom,
        inj_duplicates,
        inj_union,
        inj_label_rate,
        sup_dedup,
        sup_split,
        sup_metrics,
        sup_report,
        sup_auc,
        sup_metrics_by_scenario,
        sup_gbt,
        sup_quality,
        sup_importances,
    )
}


def _pick(scenario: str, rate: float) -> str:
    return (
        f"SELECT at_physn_npi FROM (SELECT DISTINCT at_physn_npi FROM batch) QUALIFY row_number() OVER (ORDER BY md5('42:{scenario}:' || at_physn_npi), at_physn_npi)"
        f" <= greatest(1, floor(count(*) OVER () * {rate}::DOUBLE))"
    )


def _unit(digest: str) -> str:
    return f"(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def _shown(**new: str) -> str:
    cols = []
    for c in SHOWN:
        expr = new.get(c, c)
        if c.startswith("avg_") or c == "duplicate_rate":
            expr = sql_snap(expr, 4)
        elif c.endswith("_count"):
            expr = f"CAST({expr} AS BIGINT)"
        cols.append(f"{expr} AS {c}")
    return ", ".join(cols)


_CHARGE_HASH = "md5('42:charge:' || clm_id)"
_PHANTOM_HASH = "md5('42:phantom:' || clm_id || ':' || desynpuf_id || ':' || CAST(clm_from_dt AS VARCHAR) || ':' || primary_hcpcs_cd)"
_IN = ", ".join(f"'{c}'" for c in CODES)

SCENARIOS = f"""{FEATURES},
up_t AS ({_pick('upcoding', 0.04)}), ph_t AS ({_pick('phantom_billing', 0.03)}), du_t AS ({_pick('duplicate_submission', 0.03)}),
up_stats AS (SELECT at_physn_npi, avg(cents / 100 * CASE WHEN primary_hcpcs_cd IN ({_IN}) THEN 1.2::DOUBLE + 0.2::DOUBLE * {_unit(_CHARGE_HASH)} ELSE 1.0::DOUBLE END) AS new_charge,
                    avg(ratio4 / 10000) AS new_ratio FROM claims WHERE at_physn_npi IN (SELECT * FROM up_t) GROUP BY 1),
ph_rows AS (SELECT *, {_PHANTOM_HASH} AS h FROM claims WHERE at_physn_npi IN (SELECT * FROM ph_t)
            QUALIFY row_number() OVER (PARTITION BY at_physn_npi ORDER BY h, allowed_amt) <= greatest(1, floor(count(*) OVER (PARTITION BY at_physn_npi) * 0.3::DOUBLE))),
ph_k AS (SELECT at_physn_npi, count(*) AS k FROM ph_rows GROUP BY 1),
du_k AS (SELECT at_physn_npi, CAST(greatest(1, floor(count(*) * 0.15::DOUBLE)) AS BIGINT) AS k FROM claims WHERE at_physn_npi IN (SELECT * FROM du_t) GROUP BY 1),
up AS (SELECT b.* EXCLUDE (avg_submitted_charge, avg_submitted_to_allowed_ratio), coalesce(new_charge, avg_submitted_charge) AS avg_submitted_charge,
              coalesce(new_ratio, avg_submitted_to_allowed_ratio) AS avg_submitted_to_allowed_ratio, CAST(new_charge IS NOT NULL AS INT) AS label, 'upcoding' AS scenario
       FROM batch b LEFT JOIN up_stats USING (at_physn_npi)),
ph AS (SELECT b.* EXCLUDE (near_duplicate_count, duplicate_rate), near_duplicate_count + coalesce(k, 0) AS near_duplicate_count,
              CASE WHEN k IS NULL THEN duplicate_rate ELSE (near_duplicate_count + k) / (total_carrier_claims + k) END AS duplicate_rate,
              CAST(k IS NOT NULL AS INT) AS label, 'phantom_billing' AS scenario FROM batch b LEFT JOIN ph_k USING (at_physn_npi)),
du AS (SELECT b.* EXCLUDE (exact_duplicate_count, duplicate_rate), exact_duplicate_count + coalesce(k, 0) AS exact_duplicate_count,
              CASE WHEN k IS NULL THEN duplicate_rate ELSE (exact_duplicate_count + k) / (total_carrier_claims + k) END AS duplicate_rate,
              CAST(k IS NOT NULL AS INT) AS label, 'duplicate_submission' AS scenario FROM batch b LEFT JOIN du_k USING (at_physn_npi)),
labelled AS (SELECT * FROM up UNION ALL BY NAME SELECT * FROM ph UNION ALL BY NAME SELECT * FROM du)"""

_ONE = "one AS (SELECT * FROM labelled QUALIFY row_number() OVER (PARTITION BY at_physn_npi, scenario ORDER BY period_year) = 1)"
_PROB_HASH = "md5('42:prob:' || at_physn_npi || ':' || scenario || ':' || CAST(period_year AS VARCHAR))"
_PROB = f"""preds AS (SELECT *, {sql_snap(f'{_unit(_PROB_HASH)} * 0.7::DOUBLE + label * 0.3::DOUBLE', 3)} AS prob FROM labelled)"""
_COUNTS = """count(*) FILTER (prob >= 0.5 AND label = 1) AS tp, count(*) FILTER (prob >= 0.5 AND label = 0) AS fp,
  count(*) FILTER (prob < 0.5 AND label = 1) AS fn, count(*) FILTER (prob < 0.5 AND label = 0) AS tn"""


def _safe(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN ({a}) / ({b}) ELSE 0 END"


_PRF = (
    f"{sql_snap(_safe('tp', 'tp + fp'))} AS precision, {sql_snap(_safe('tp', 'tp + fn'))} AS recall,"
    f" {sql_snap(_safe('2 * tp', '2 * tp + fp + fn'))} AS f1"
)


def _auc(by: str) -> str:
    over = f"PARTITION BY {by}" if by else ""
    ties = f"PARTITION BY {by + ', ' if by else ''}prob"
    group = f"GROUP BY {by}" if by else ""
    cols = f"{by}, " if by else ""
    return (
        f"SELECT {cols}CASE WHEN sum(label) > 0 AND sum(label) < count(*) THEN"
        f" (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label))) END AS auc"
        f" FROM (SELECT *, rank() OVER ({over} ORDER BY prob) + (count(*) OVER ({ties}) - 1) / 2 AS r FROM preds) {group}"
    )


ORACLE = {
    "inj_targets": f"WITH {SCENARIOS} SELECT at_physn_npi, 'upcoding' AS scenario FROM up_t UNION ALL SELECT at_physn_npi, 'phantom_billing' FROM ph_t"
    " UNION ALL SELECT at_physn_npi, 'duplicate_submission' FROM du_t",
    "inj_upcoding": f"WITH {SCENARIOS} SELECT {_shown()} FROM up",
    "inj_phantom_rows": f"WITH {SCENARIOS} SELECT clm_id, at_physn_npi, desynpuf_id, CAST(clm_from_dt + CAST(1 + CAST('0x' || substr(h, 25, 8) AS BIGINT) % 5 AS INT) AS VARCHAR) AS clm_from_dt,"
    f" primary_hcpcs_cd, {sql_snap('allowed_amt')} AS allowed_amt FROM ph_rows",
    "inj_phantom": f"WITH {SCENARIOS} SELECT {_shown()} FROM ph",
    "inj_duplicates": f"WITH {SCENARIOS} SELECT {_shown()} FROM du",
    "inj_union": f"WITH {SCENARIOS} SELECT {_shown()} FROM labelled",
    "inj_label_rate": f"WITH {SCENARIOS} SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS anomalies, {sql_snap('avg(label)')} AS label_rate FROM labelled",
    "sup_dedup": f"WITH {SCENARIOS}, {_ONE} SELECT {_shown()} FROM one",
    "sup_split": f"WITH {SCENARIOS}, {_ONE} SELECT at_physn_npi, scenario, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:split:' || at_physn_npi || ':' || scenario), at_physn_npi, scenario)"
    " <= floor(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE + 0.5) AS is_test FROM one",
    "sup_gbt": f"WITH {SCENARIOS}, {_ONE}, s AS (SELECT at_physn_npi, scenario, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:split:' || at_physn_npi || ':' || scenario), at_physn_npi, scenario)"
    " <= floor(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE + 0.5) AS is_test FROM one) SELECT at_physn_npi, scenario, label, true AS prob_in_range FROM s WHERE is_test",
    "sup_quality": f"WITH {SCENARIOS}, {_ONE}, s AS (SELECT at_physn_npi, scenario, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:split:' || at_physn_npi || ':' || scenario), at_physn_npi, scenario)"
    " <= floor(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE + 0.5) AS is_test FROM one) SELECT scenario, count(*) FILTER (label = 1) AS anomalies,"
    " true AS recall_above_floor, true AS auc_above_floor FROM s WHERE NOT is_test GROUP BY scenario",
    "sup_importances": "SELECT feature, true AS is_share, true AS adds_up FROM (VALUES " + ", ".join(f"('{c}')" for c in MODEL_FEATURES) + ") AS f(feature)",
    "sup_metrics": f"WITH {SCENARIOS}, {_PROB}, c AS (SELECT {_COUNTS} FROM preds), a AS ({_auc('')}) SELECT {sql_snap('auc')} AS auc_roc, {_PRF}, tp, fp, fn, tn FROM c, a",
    "sup_report": f"""WITH {SCENARIOS}, {_PROB}, c AS (SELECT {_COUNTS} FROM preds),
k(name, hit, over_n, miss) AS (SELECT 'Clean', tn, fn, fp FROM c UNION ALL SELECT 'Anomaly', tp, fp, fn FROM c),
p AS (SELECT name, {_safe('hit', 'hit + over_n')} AS precision, {_safe('hit', 'hit + miss')} AS recall, {_safe('2 * hit', '2 * hit + over_n + miss')} AS f1, hit + miss AS support FROM k),
r AS (SELECT * FROM p UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM p
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM p)
SELECT name, {sql_snap('precision')} AS precision, {sql_snap('recall')} AS recall, {sql_snap('f1')} AS f1, CAST(support AS BIGINT) AS support FROM r""",
    "sup_auc": f"WITH {SCENARIOS}, {_PROB}, a AS ({_auc('')}) SELECT {sql_snap('auc')} AS auc_roc FROM a",
    "sup_metrics_by_scenario": f"WITH {SCENARIOS}, {_PROB}, c AS (SELECT scenario, {_COUNTS} FROM preds GROUP BY scenario), a AS ({_auc('scenario')})"
    f" SELECT scenario, tp + fp + fn + tn AS test_rows, tp + fn AS anomalies, {_PRF}, {sql_snap('auc')} AS auc_roc FROM c JOIN a USING (scenario)",
}
