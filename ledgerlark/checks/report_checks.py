"""Registered queries for registry state, run log and dashboard pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.checks.score_checks import SCORE_TABLE, SCORED, _ranked, _score_table
from ledgerlark.checks.score_checks import _RANKED, _reason_sql
from ledgerlark.checks.support import snap_all, sql_snap
from ledgerlark.operators import attribution as at
from ledgerlark.operators import reports as rp
from ledgerlark.sources.sample_views import run_view

# Orders stand for registered models, line items for promotions, events for run events.
MODELS = """SELECT o_orderkey AS model_id, o_orderpriority AS model_type, concat('v', cast(o_custkey AS string)) AS model_version,
       o_orderdate AS trained_at, o_custkey AS training_samples, cast(o_totalprice AS decimal(12,2)) AS avg_anomaly_score,
       CASE WHEN o_orderstatus = 'F' THEN 'registered' END AS notes, concat('/models/', cast(o_orderkey AS string)) AS model_path
FROM orders"""

PROMOTIONS = """SELECT l_orderkey AS model_id, o_orderpriority AS model_type, l_shipdate AS promoted_at,
       l_linenumber * 1000000 + l_partkey AS seq, CASE WHEN l_returnflag = 'A' THEN concat('part ', cast(l_partkey AS string)) END AS notes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

RUN_EVENTS = """SELECT cast(user_id AS int) AS run_id, ts AS event_at, event_id AS seq,
       CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'running' END AS status,
       event_id AS model_id, cast(event_id % 50 AS int) AS batch_id, cast(floor(value * 100) AS bigint) AS carrier_claims_processed,
       CASE WHEN event_id % 2 = 0 THEN event_id END AS outpatient_claims_processed,
       CASE WHEN event_type = 'error' THEN props END AS error_message
FROM events"""


def _registry(spark, sf_dir):
    return rp.registry_state(run_view(spark, sf_dir, MODELS), run_view(spark, sf_dir, PROMOTIONS))


def _scores(spark, sf_dir):
    """Score rows; each period year counts as a scoring run."""
    return _score_table(spark, sf_dir).withColumn("scoring_run_id", F.col("period_year") - 1995)


def _runs(spark, sf_dir):
    return rp.run_log(run_view(spark, sf_dir, RUN_EVENTS), _scores(spark, sf_dir))


def reg_promote(spark, sf_dir):
    return snap_all(_registry(spark, sf_dir))


def reg_active(spark, sf_dir):
    return rp.active_models(_registry(spark, sf_dir))


def reg_versions(spark, sf_dir):
    return snap_all(rp.model_versions(_registry(spark, sf_dir)).drop("model_path"))


def rpt_run_log(spark, sf_dir):
    return snap_all(_runs(spark, sf_dir))


def rpt_overview(spark, sf_dir):
    return snap_all(rp.overview(_runs(spark, sf_dir), _scores(spark, sf_dir), _registry(spark, sf_dir)))


def rpt_totals(spark, sf_dir):
    return rp.totals(_runs(spark, sf_dir))


def rpt_trends(spark, sf_dir):
    return snap_all(rp.trends(_runs(spark, sf_dir), "2024-01-05"))


def rpt_decile_hist(spark, sf_dir):
    return rp.decile_histogram(_score_table(spark, sf_dir))


def rpt_ranking(spark, sf_dir):
    """Ranking page with its reasons, under all three filters: flagged, upper deciles, one year."""
    keys = ["at_physn_npi", "period_year", "scoring_run_id"]
    rows = at.attach_reasons(_score_table(spark, sf_dir), at.top_reasons(_ranked(spark, sf_dir), keys), keys)
    kept = rp.filter_scores(rows, flagged=True, deciles=(6, 10), year=1996)
    return snap_all(kept.select(*rp.SCORE_FIELDS, "top_reason_1", "top_reason_2", "top_reason_3"))


def rpt_top_flagged(spark, sf_dir):
    keys = ["at_physn_npi", "period_year", "scoring_run_id"]
    reasons = at.top_reasons(_ranked(spark, sf_dir), keys)
    return snap_all(rp.top_flagged(at.attach_reasons(_score_table(spark, sf_dir), reasons, keys)))


def rpt_health(spark, sf_dir):
    return snap_all(rp.health(_runs(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        reg_promote,
        reg_active,
        reg_versions,
        rpt_run_log,
        rpt_overview,
        rpt_totals,
        rpt_trends,
        rpt_decile_hist,
        rpt_ranking,
        rpt_top_flagged,
        rpt_health,
    )
}

_REGISTRY = f"""models AS ({MODELS}), promotions AS ({PROMOTIONS}),
winners AS (SELECT model_type, model_id AS active_id FROM promotions QUALIFY row_number() OVER (PARTITION BY model_type ORDER BY promoted_at DESC, seq DESC, model_id DESC) = 1),
noted AS (SELECT model_id, notes AS new_notes FROM promotions WHERE notes IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY promoted_at DESC, seq DESC, notes DESC) = 1),
registry AS (SELECT m.model_id, m.model_type, model_version, trained_at, training_samples, avg_anomaly_score, model_path,
               coalesce(new_notes, m.notes) AS notes, (SELECT max(promoted_at) FROM promotions p WHERE p.model_id = m.model_id) AS promoted_at,
               coalesce(m.model_id = active_id, false) AS is_active
             FROM models m LEFT JOIN winners USING (model_type) LEFT JOIN noted ON noted.model_id = m.model_id)"""

_REG_COLS = (
    "model_id, model_type, model_version, CAST(trained_at AS VARCHAR) AS trained_at, training_samples,"
    f" {sql_snap('avg_anomaly_score')} AS avg_anomaly_score, notes, CAST(promoted_at AS VARCHAR) AS promoted_at, is_active"
)

_RUNS = f"""{SCORED}, {SCORE_TABLE}, by_run AS (SELECT * REPLACE (period_year - 1995 AS scoring_run_id) FROM score_table),
run_events AS ({RUN_EVENTS}),
last_event AS (SELECT * FROM run_events QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY event_at DESC, seq DESC) = 1),
tally AS (SELECT scoring_run_id AS run_id, count(DISTINCT at_physn_npi) AS scored_n, count(*) FILTER (is_flagged) AS flagged_n FROM by_run GROUP BY 1),
begun AS (SELECT run_id, min(event_at) AS started_at FROM run_events GROUP BY run_id),
runs AS (SELECT e.run_id, started_at, CASE WHEN status <> 'running' THEN event_at END AS completed_at, status, model_id, batch_id, carrier_claims_processed,
           outpatient_claims_processed, CASE WHEN status = 'failed' THEN error_message END AS error_message,
           coalesce(scored_n, 0) AS providers_scored, coalesce(flagged_n, 0) AS providers_flagged
         FROM last_event e JOIN begun USING (run_id) LEFT JOIN tally t ON t.run_id = e.run_id)"""

_SCORE_COLS = ", ".join(rp.SCORE_FIELDS)

ORACLE = {
    "reg_promote": f"WITH {_REGISTRY} SELECT {_REG_COLS}, model_path FROM registry",
    "reg_active": f"WITH {_REGISTRY} SELECT model_type, model_id, model_version, model_path FROM registry WHERE is_active",
    "reg_versions": f"WITH {_REGISTRY} SELECT {_REG_COLS} FROM registry",
    "rpt_run_log": f"WITH {_RUNS} SELECT * REPLACE (CAST(started_at AS VARCHAR) AS started_at, CAST(completed_at AS VARCHAR) AS completed_at) FROM runs",
    "rpt_overview": f"""WITH {_RUNS}, {_REGISTRY}
SELECT run_id, CAST(completed_at AS VARCHAR) AS run_date, coalesce(carrier_claims_processed, 0) + coalesce(outpatient_claims_processed, 0) AS total_claims_processed,
  providers_scored, providers_flagged, coalesce((SELECT {sql_snap('round(sum(CASE WHEN is_flagged THEN CAST(avg_submitted_to_allowed_ratio AS DECIMAL(12,4)) * 1000 ELSE 0 END), 2)')}
    FROM by_run b WHERE b.scoring_run_id = r.run_id), 0) AS at_risk_score_proxy, model_version, model_type
FROM runs r LEFT JOIN models m ON m.model_id = r.model_id WHERE status = 'success'""",
    "rpt_totals": f"WITH {_RUNS} SELECT CAST(sum(carrier_claims_processed) AS BIGINT) AS claims_processed, CAST(sum(providers_flagged) AS BIGINT) AS providers_flagged FROM runs",
    "rpt_trends": f"WITH {_RUNS} SELECT CAST(CAST(completed_at AS DATE) AS VARCHAR) AS run_day, CAST(sum(carrier_claims_processed) AS BIGINT) AS claims_processed,"
    " CAST(sum(providers_flagged) AS BIGINT) AS providers_flagged, count(*) AS runs FROM runs WHERE completed_at >= TIMESTAMP '2024-01-05' GROUP BY CAST(completed_at AS DATE)",
    "rpt_decile_hist": f"WITH {SCORED} SELECT risk_decile, count(*) AS providers FROM scored GROUP BY 1",
    "rpt_ranking": f"WITH {SCORED}, {SCORE_TABLE}, {_RANKED}, texts AS (SELECT *, {_reason_sql()} AS reason FROM ranked)"
    f" SELECT {_SCORE_COLS},"
    + ", ".join(
        f" (SELECT max(reason) FROM texts t WHERE t.at_physn_npi = s.at_physn_npi AND t.period_year = s.period_year AND feature_rank = {i}) AS top_reason_{i}"
        for i in (1, 2, 3)
    )
    + " FROM score_table s WHERE is_flagged AND risk_decile BETWEEN 6 AND 10 AND period_year = 1996",
    "rpt_top_flagged": f"WITH {SCORED}, {SCORE_TABLE}, {_RANKED}, texts AS (SELECT *, {_reason_sql()} AS reason FROM ranked)"
    f" SELECT {_SCORE_COLS},"
    + ", ".join(
        f" (SELECT max(reason) FROM texts t WHERE t.at_physn_npi = s.at_physn_npi AND t.period_year = s.period_year AND feature_rank = {i}) AS top_reason_{i}"
        for i in (1, 2, 3)
    )
    + " FROM score_table s WHERE is_flagged ORDER BY risk_score DESC, at_physn_npi, period_year LIMIT 10",
    "rpt_health": f"WITH {_RUNS} SELECT CAST(max(completed_at) FILTER (status = 'success') AS VARCHAR) AS last_success, count(*) FILTER (status = 'success') AS successful_runs,"
    " count(*) FILTER (status = 'failed') AS failed_runs, count(*) FILTER (status = 'running') AS running_runs FROM runs",
}
