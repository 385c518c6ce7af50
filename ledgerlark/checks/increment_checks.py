"""Registered queries for increments, keyed refresh and duplicate pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.checks.support import BENE, CLAIMS_DENSE, CLAIMS_STREAM, OUTPATIENT, snap_all, sql_snap
from ledgerlark.checks import feature_checks as fc
from ledgerlark.operators import features as fx
from ledgerlark.operators import increments as inc
from ledgerlark.operators.pairs import claim_pairs
from ledgerlark.operators.ranking import first_per_key
from ledgerlark.session import scratch_path
from ledgerlark.sources import sample_views as views
from ledgerlark.sources.claim_state import PROVIDER_BUCKET, ClaimState
from ledgerlark.sources.tables import replace_rows

POSITION = "2024-01-10"
SIZE = 2000


def inc_active_providers(spark, sf_dir):
    return fx.active_providers(views.claims_stream(spark, sf_dir), "2024-01-10", "2024-01-11")


def inc_history_semijoin(spark, sf_dir):
    """Full history, per provider and day, of the providers active in one day."""
    c = views.claims_stream(spark, sf_dir)
    kept = fx.keep_providers(c, fx.active_providers(c, "2024-01-10", "2024-01-11"), ("clm_id",))
    return kept.groupBy("at_physn_npi", F.col("clm_from_dt").cast("string").alias("day")).agg(F.count("*").alias("claims"))


def inc_next_batch(spark, sf_dir):
    c = inc.next_batch(views.claims_stream(spark, sf_dir), POSITION, SIZE)
    return snap_all(c.select("clm_id", "at_physn_npi", "clm_from_dt", "allowed_amt", F.col("is_weekend_claim")))


def inc_watermark(spark, sf_dir):
    """Position after one batch and after the next one, which starts where the first ended."""
    c = views.claims_stream(spark, sf_dir)
    first = inc.batch_window(c, POSITION, SIZE)
    second = inc.batch_window(c, first.select("batch_end").scalar(), SIZE, last_batch=1)
    return snap_all(first.unionByName(second))


def inc_late_rows(spark, sf_dir):
    return snap_all(
        inc.late_rows(views.claims_stream(spark, sf_dir), POSITION).select("clm_id", "at_physn_npi", "clm_from_dt")
    )


def inc_refresh(spark, sf_dir):
    """Two batches of claims, the second one dated after a position: each adds its cells, then the features of the providers
    it names are folded from all cells and replaced.  Equals a full refresh wherever a provider has a claim in the second batch."""
    claims = views.dense_claim_table(spark, sf_dir)
    bene, op = views.bene(spark, sf_dir), views.outpatient(spark, sf_dir)
    root = scratch_path(spark, "refresh")
    state = ClaimState(spark, f"{root}/state")
    for number, dates in ((1, "clm_from_dt <= date'2000-12-31'"), (2, "clm_from_dt > date'2000-12-31'")):
        batch = claims.filter(dates)
        state.absorb(batch, number, with_keys=False)
        rows = state.features(state.active(batch), bene, op, number)
        replace_rows(rows, f"{root}/features", ["at_physn_npi", "period_year"], ["period_year", PROVIDER_BUCKET])
    return snap_all(spark.read.parquet(f"{root}/features").drop(PROVIDER_BUCKET))


def dup_claim_pairs(spark, sf_dir):
    cols = ("clm_from_dt", "desynpuf_id", "at_physn_npi", "primary_hcpcs_cd")
    c = first_per_key(views.claims_dense(spark, sf_dir).select("clm_id", *cols), ["clm_id"], cols)
    return snap_all(claim_pairs(c))


QUERIES = {
    f.__name__: f
    for f in (
        inc_active_providers,
        inc_history_semijoin,
        inc_next_batch,
        inc_watermark,
        inc_late_rows,
        inc_refresh,
        dup_claim_pairs,
    )
}

_ACTIVE = "active AS (SELECT DISTINCT at_physn_npi FROM claims WHERE clm_from_dt > DATE '2024-01-10' AND clm_from_dt <= DATE '2024-01-11')"


def _cut(position: str) -> str:
    return (
        f"(SELECT max(d) FROM (SELECT clm_from_dt AS d, sum(count(*)) OVER (ORDER BY clm_from_dt) - count(*) AS before"
        f" FROM claims WHERE clm_from_dt > {position} GROUP BY clm_from_dt) WHERE before < {SIZE})"
    )


_P = f"DATE '{POSITION}'"
_LATE_FEATURES = fc.features_cte(CLAIMS_DENSE)
_EARLY_FEATURES = fc.features_cte(
    CLAIMS_DENSE.replace("FROM raw_claims)", "FROM raw_claims WHERE clm_from_dt <= DATE '2000-12-31')")
)

ORACLE = {
    "inc_active_providers": f"WITH {CLAIMS_STREAM}, {_ACTIVE} SELECT * FROM active",
    "inc_history_semijoin": f"WITH {CLAIMS_STREAM}, {_ACTIVE} SELECT at_physn_npi, CAST(clm_from_dt AS VARCHAR) AS day, count(*) AS claims"
    " FROM claims WHERE at_physn_npi IN (SELECT at_physn_npi FROM active) GROUP BY ALL",
    "inc_next_batch": f"WITH {CLAIMS_STREAM} SELECT clm_id, at_physn_npi, CAST(clm_from_dt AS VARCHAR) AS clm_from_dt, {sql_snap('allowed_amt')} AS allowed_amt,"
    f" isodow(clm_from_dt) IN (6, 7) AS is_weekend_claim FROM claims WHERE clm_from_dt > {_P} AND clm_from_dt <= {_cut(_P)}",
    "inc_watermark": f"""WITH {CLAIMS_STREAM}, p1 AS (SELECT {_cut(_P)} AS d), p2 AS (SELECT {_cut('(SELECT d FROM p1)')} AS d)
SELECT '{POSITION}' AS batch_start, CAST((SELECT d FROM p1) AS VARCHAR) AS batch_end, count(*) AS claims, CAST(1 AS INT) AS batch_id
FROM claims WHERE clm_from_dt > {_P} AND clm_from_dt <= (SELECT d FROM p1)
UNION ALL SELECT * FROM (SELECT CAST((SELECT d FROM p1) AS VARCHAR), CAST((SELECT d FROM p2) AS VARCHAR), count(*) AS n, CAST(2 AS INT)
FROM claims WHERE clm_from_dt > (SELECT d FROM p1) AND clm_from_dt <= (SELECT d FROM p2)) WHERE n > 0""",
    "inc_late_rows": f"WITH {CLAIMS_STREAM} SELECT clm_id, at_physn_npi, CAST(clm_from_dt AS VARCHAR) AS clm_from_dt FROM claims WHERE clm_from_dt <= {_P}",
    "inc_refresh": f"""WITH late AS (WITH {_LATE_FEATURES} SELECT f.*, CAST(2 AS INT) AS batch_id FROM features f WHERE at_physn_npi IN
  (SELECT at_physn_npi FROM claims WHERE clm_from_dt > DATE '2000-12-31')),
early AS (WITH {_EARLY_FEATURES} SELECT *, CAST(1 AS INT) AS batch_id FROM features)
SELECT * FROM late UNION ALL BY NAME SELECT * FROM early e WHERE NOT EXISTS
  (SELECT 1 FROM late l WHERE l.at_physn_npi = e.at_physn_npi AND l.period_year = e.period_year)""",
    "dup_claim_pairs": f"""WITH {CLAIMS_DENSE},
one AS (SELECT clm_id, clm_from_dt AS d, desynpuf_id, at_physn_npi, primary_hcpcs_cd FROM claims
        QUALIFY row_number() OVER (PARTITION BY clm_id ORDER BY clm_from_dt, desynpuf_id, at_physn_npi, primary_hcpcs_cd) = 1),
heads AS (SELECT at_physn_npi, desynpuf_id, primary_hcpcs_cd, d, min(clm_id) AS head FROM one GROUP BY ALL),
pairs AS (
  SELECT head AS clm_id_a, clm_id AS clm_id_b, at_physn_npi, desynpuf_id, primary_hcpcs_cd AS hcpcs_cd, d AS date_a, d AS date_b, 0 AS gap, 'exact' AS duplicate_type
  FROM one JOIN heads USING (at_physn_npi, desynpuf_id, primary_hcpcs_cd, d) WHERE clm_id <> head
  UNION ALL
  SELECT a.head, b.head, b.at_physn_npi, b.desynpuf_id, b.primary_hcpcs_cd, a.d, b.d, b.d - a.d, 'near'
  FROM heads b ASOF JOIN heads a ON a.at_physn_npi = b.at_physn_npi AND a.desynpuf_id = b.desynpuf_id
       AND a.primary_hcpcs_cd = b.primary_hcpcs_cd AND a.d < b.d WHERE b.d - a.d <= 3)
SELECT clm_id_a, clm_id_b, at_physn_npi, desynpuf_id, hcpcs_cd, CAST(date_a AS VARCHAR) AS date_a, CAST(date_b AS VARCHAR) AS date_b,
       CAST(gap AS INT) AS date_diff_days, duplicate_type FROM pairs""",
}
