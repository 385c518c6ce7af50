"""Registered queries for the provider-year features, with the SQL that checks each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.checks.support import (
    BENE,
    CLAIMS,
    CLAIMS_DENSE,
    CONDITIONS,
    OUTPATIENT,
    snap_all,
    sql_snap,
)
from ledgerlark.operators import features as fx
from ledgerlark.operators.merge import replace_by_key
from ledgerlark.session import materialise
from ledgerlark.sources import sample_views as views

NPI = "at_physn_npi"
KEYS = [NPI, "period_year"]


def feat_carrier_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distinct counts, means and shares per provider-year, from the full feature job."""
    out = fx.provider_year_features(views.claim_table(spark, sf_dir), views.bene(spark, sf_dir), views.outpatient(spark, sf_dir))
    return snap_all(
        out.select(
            *KEYS,
            "total_carrier_claims",
            "distinct_beneficiaries",
            "distinct_hcpcs_codes",
            "distinct_pos_codes",
            "beneficiaries_per_state",
            "avg_submitted_to_allowed_ratio",
            "avg_submitted_charge",
            "avg_allowed_amt",
            "pct_weekend_claims",
            "high_chronic_burden_benes_pct",
        )
    )


_CARRIER = f"""
carrier AS (
  SELECT c.at_physn_npi, c.yr AS period_year, count(*) AS total_carrier_claims,
         count(DISTINCT c.desynpuf_id) AS distinct_beneficiaries,
         count(DISTINCT primary_hcpcs_cd) AS distinct_hcpcs_codes,
         count(DISTINCT place_of_service_cd) AS distinct_pos_codes,
         count(DISTINCT state_code) AS beneficiaries_per_state,
         avg(ratio4) / 10000 AS avg_submitted_to_allowed_ratio,
         quantile_cont(ratio4 / 10000.0, 0.95) AS p95_submitted_to_allowed_ratio,
         avg(cents) / 100 AS avg_submitted_charge, avg(cents) / 100 AS avg_allowed_amt,
         avg(CASE WHEN isodow(clm_from_dt) >= 6 THEN 1.0 ELSE 0.0 END) AS pct_weekend_claims,
         avg(CASE WHEN {CONDITIONS} >= 3 THEN 1.0 ELSE 0.0 END) AS high_chronic_burden_benes_pct,
         count(*) FILTER (clm_from_dt > death_date) AS claims_after_bene_death,
         count(*) FILTER (c.yr = year(death_date)) AS claims_in_bene_death_year,
         avg(CASE WHEN place_of_service_cd = '11' THEN 1.0 ELSE 0.0 END) AS pct_claims_office,
         avg(CASE WHEN place_of_service_cd = '12' THEN 1.0 ELSE 0.0 END) AS pct_claims_home,
         avg(CASE WHEN place_of_service_cd = '31' THEN 1.0 ELSE 0.0 END) AS pct_claims_nursing_facility
  FROM claims c LEFT JOIN bene b ON b.desynpuf_id = c.desynpuf_id AND b.year = c.yr
  GROUP BY 1, 2)"""

_DAILY = """
daily AS (SELECT at_physn_npi, yr AS period_year, max(n) AS max_claims_in_single_day
          FROM (SELECT at_physn_npi, yr, clm_from_dt, count(*) AS n FROM claims GROUP BY ALL) GROUP BY ALL)"""

_PER_BENE = """
per_bene AS (SELECT at_physn_npi, yr AS period_year, avg(n) AS avg_claims_per_beneficiary
             FROM (SELECT at_physn_npi, yr, desynpuf_id, count(*) AS n FROM claims GROUP BY ALL) GROUP BY ALL)"""

_CODES = """
code_n AS (SELECT at_physn_npi, yr, primary_hcpcs_cd AS code, count(*) AS n FROM claims GROUP BY ALL),
code_share AS (SELECT *, n / sum(n) OVER (PARTITION BY at_physn_npi, yr) AS share,
                      row_number() OVER (PARTITION BY at_physn_npi, yr ORDER BY n DESC, code NULLS LAST) AS place FROM code_n),
codes AS (SELECT at_physn_npi, yr AS period_year, count(code) AS distinct_hcpcs_codes,
                 max(code) FILTER (place = 1) AS top_hcpcs_code, max(share) FILTER (place = 1) AS top_hcpcs_code_share,
                 sum(share * share) AS hcpcs_concentration_score FROM code_share GROUP BY ALL)"""

_EXACT = """
exact_groups AS (SELECT at_physn_npi, yr AS period_year, count(*) AS exact_duplicate_count
                 FROM (SELECT at_physn_npi, yr, desynpuf_id, primary_hcpcs_cd, clm_from_dt FROM claims
                       GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL)"""

_NEAR = """
gaps AS (SELECT at_physn_npi, yr, clm_from_dt - lag(clm_from_dt) OVER (
           PARTITION BY at_physn_npi, desynpuf_id, primary_hcpcs_cd ORDER BY clm_from_dt) AS gap FROM claims),
near_rows AS (SELECT at_physn_npi, yr AS period_year,
                     CAST(count(*) FILTER (gap >= 1 AND gap <= 3) AS BIGINT) AS near_duplicate_count FROM gaps GROUP BY ALL)"""

_VOLUME = """
volume AS (SELECT at_physn_npi, yr AS period_year, count(*) AS n FROM claims GROUP BY ALL),
growth AS (SELECT v.at_physn_npi, v.period_year, coalesce(p.n, 0) AS prior_period_claim_count,
                  CASE WHEN p.n > 0 THEN (v.n - p.n) / p.n * 100 END AS claim_volume_growth_pct
           FROM volume v LEFT JOIN volume p ON p.at_physn_npi = v.at_physn_npi AND p.period_year + 1 = v.period_year)"""

_OP = """
op AS (SELECT at_physn_npi, CAST(year(clm_from_dt) AS INT) AS period_year, count(*) AS total_outpatient_claims,
              avg(CAST(clm_pmt_amt * 100 AS BIGINT)) / 100 AS avg_outpatient_payment FROM outpatient GROUP BY 1, 2)"""


def feat_ratio_p95(spark, sf_dir):
    out = fx.amounts(fx.amount_cells(views.claims(spark, sf_dir)))
    return snap_all(out.select(*KEYS, "avg_submitted_to_allowed_ratio", "p95_submitted_to_allowed_ratio"))


def feat_pos_mix(spark, sf_dir):
    out = fx.amounts(fx.amount_cells(views.claims(spark, sf_dir)))
    return snap_all(
        out.select(*KEYS, "distinct_pos_codes", "pct_claims_office", "pct_claims_home", "pct_claims_nursing_facility")
    )


def feat_daily_max(spark, sf_dir):
    days = fx.day_counts(fx.claim_cells(views.claims(spark, sf_dir)))
    return days.groupBy(*KEYS).agg(F.max("cnt").alias("max_claims_in_single_day"))


def feat_claims_per_bene(spark, sf_dir):
    benes = fx.beneficiary_counts(fx.claim_cells(views.claims(spark, sf_dir)))
    return snap_all(benes.groupBy(*KEYS).agg(F.avg("cnt").alias("avg_claims_per_beneficiary")))


def feat_code_mix(spark, sf_dir):
    return snap_all(fx.code_mix(fx.claim_cells(views.claims(spark, sf_dir))))


def feat_exact_dups(spark, sf_dir):
    rows = fx.duplicate_days(fx.claim_cells(views.claims_dense(spark, sf_dir)))
    return rows.groupBy(*KEYS).agg(F.sum("exact").alias("exact_duplicate_count")).filter("exact_duplicate_count > 0")


def feat_near_dups(spark, sf_dir):
    rows = fx.duplicate_days(fx.claim_cells(views.claims_dense(spark, sf_dir)))
    return rows.groupBy(*KEYS).agg(F.sum("near").alias("near_duplicate_count"))


def feat_duplicates(spark, sf_dir):
    """Duplicate rate on the dense claims, from the full feature job."""
    out = fx.provider_year_features(
        views.dense_claim_table(spark, sf_dir), views.bene(spark, sf_dir), views.outpatient(spark, sf_dir)
    )
    return snap_all(
        out.select(*KEYS, "total_carrier_claims", "exact_duplicate_count", "near_duplicate_count", "duplicate_rate")
    )


def feat_post_death(spark, sf_dir):
    joined = fx.with_beneficiary(fx.claim_cells(views.claims(spark, sf_dir)), views.bene(spark, sf_dir))
    return (
        fx.beneficiary_profile(joined)
        .groupBy(*KEYS)
        .agg(F.sum("after_death").alias("claims_after_bene_death"), F.sum("death_year").alias("claims_in_bene_death_year"))
    )


def join_claim_bene(spark, sf_dir):
    """Claims joined to their beneficiary-year, at cell grain: matched and unmatched claims, states, conditions."""
    joined = fx.with_beneficiary(fx.claim_cells(views.claims(spark, sf_dir)), views.bene(spark, sf_dir))
    return (
        joined.groupBy(*KEYS, "state_code", "conditions")
        .agg(F.sum("cnt").alias("claims"))
        .withColumn("conditions", F.col("conditions").cast("int"))
    )


def feat_growth(spark, sf_dir):
    out = fx.provider_year_features(views.claim_table(spark, sf_dir), views.bene(spark, sf_dir), views.outpatient(spark, sf_dir))
    return snap_all(out.select(*KEYS, "prior_period_claim_count", "claim_volume_growth_pct"))


def feat_outpatient(spark, sf_dir):
    out = fx.provider_year_features(views.claim_table(spark, sf_dir), views.bene(spark, sf_dir), views.outpatient(spark, sf_dir))
    return snap_all(out.select(*KEYS, "total_outpatient_claims", "avg_outpatient_payment"))


def feat_provider_year(spark, sf_dir):
    """Flagship: every feature for every provider-year."""
    return snap_all(
        fx.provider_year_features(
            views.claim_table(spark, sf_dir), views.bene(spark, sf_dir), views.outpatient(spark, sf_dir), batch_id=1
        )
    )


_ALL_PARTS = ",".join([_CARRIER, _DAILY, _PER_BENE, _CODES, _EXACT, _NEAR, _VOLUME, _OP])

_ALL_VALUES = f"""
         c.total_carrier_claims, c.distinct_beneficiaries, c.distinct_hcpcs_codes, c.distinct_pos_codes, c.beneficiaries_per_state,
         {sql_snap('c.avg_submitted_to_allowed_ratio')} AS avg_submitted_to_allowed_ratio,
         {sql_snap('c.p95_submitted_to_allowed_ratio')} AS p95_submitted_to_allowed_ratio,
         {sql_snap('c.avg_submitted_charge')} AS avg_submitted_charge, {sql_snap('c.avg_allowed_amt')} AS avg_allowed_amt,
         {sql_snap('c.pct_weekend_claims')} AS pct_weekend_claims, max_claims_in_single_day,
         c.claims_after_bene_death, c.claims_in_bene_death_year,
         {sql_snap('c.high_chronic_burden_benes_pct')} AS high_chronic_burden_benes_pct,
         {sql_snap('c.pct_claims_office')} AS pct_claims_office, {sql_snap('c.pct_claims_home')} AS pct_claims_home,
         {sql_snap('c.pct_claims_nursing_facility')} AS pct_claims_nursing_facility,
         {sql_snap('avg_claims_per_beneficiary')} AS avg_claims_per_beneficiary,
         {sql_snap('avg_claims_per_beneficiary')} AS carrier_claims_per_bene,
         top_hcpcs_code, {sql_snap('top_hcpcs_code_share')} AS top_hcpcs_code_share,
         {sql_snap('hcpcs_concentration_score')} AS hcpcs_concentration_score,
         coalesce(exact_duplicate_count, 0) AS exact_duplicate_count, coalesce(near_duplicate_count, 0) AS near_duplicate_count,
         {sql_snap('(coalesce(exact_duplicate_count, 0) + coalesce(near_duplicate_count, 0)) / c.total_carrier_claims')} AS duplicate_rate,
         prior_period_claim_count, {sql_snap('claim_volume_growth_pct')} AS claim_volume_growth_pct,
         coalesce(total_outpatient_claims, 0) AS total_outpatient_claims,
         {sql_snap('coalesce(avg_outpatient_payment, 0)')} AS avg_outpatient_payment"""

_ALL_FROM = """
  FROM carrier c LEFT JOIN daily USING (at_physn_npi, period_year) LEFT JOIN per_bene USING (at_physn_npi, period_year)
  LEFT JOIN codes USING (at_physn_npi, period_year) LEFT JOIN exact_groups USING (at_physn_npi, period_year)
  LEFT JOIN near_rows USING (at_physn_npi, period_year) LEFT JOIN growth USING (at_physn_npi, period_year)
  LEFT JOIN op USING (at_physn_npi, period_year)"""


def features_cte(claims_cte: str = CLAIMS) -> str:
    """CTE list ending in ``features``: the whole feature table, snapped."""
    return f"""{claims_cte}, {BENE}, {OUTPATIENT}, {_ALL_PARTS},
features AS (SELECT at_physn_npi, period_year, {_ALL_VALUES} {_ALL_FROM})"""


def _select(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


def feat_keyed_replace(spark, sf_dir):
    """Features of the claims before 1998 replaced, key by key, by those of all claims of 1997 on."""
    claims = views.claims(spark, sf_dir)
    old = fx.code_mix(fx.claim_cells(claims.filter("clm_from_dt < date'1998-01-01'")))
    new = fx.code_mix(fx.claim_cells(claims.filter("clm_from_dt >= date'1997-01-01'")))
    new = materialise(new.withColumn("top_hcpcs_code", F.concat(F.lit("new:"), "top_hcpcs_code")), "replacement")
    return snap_all(replace_by_key(old, new, KEYS))


QUERIES = {
    f.__name__: f
    for f in (
        feat_provider_year,
        feat_carrier_base,
        feat_ratio_p95,
        feat_daily_max,
        feat_claims_per_bene,
        feat_code_mix,
        feat_exact_dups,
        feat_near_dups,
        feat_duplicates,
        feat_post_death,
        feat_pos_mix,
        feat_growth,
        feat_outpatient,
        join_claim_bene,
        feat_keyed_replace,
    )
}

_K = "at_physn_npi, period_year"

ORACLE = {
    "feat_provider_year": _select(features_cte(), "SELECT *, CAST(1 AS INT) AS batch_id FROM features"),
    "feat_carrier_base": _select(
        f"{CLAIMS}, {BENE}, {_CARRIER}",
        f"SELECT {_K}, total_carrier_claims, distinct_beneficiaries, distinct_hcpcs_codes, distinct_pos_codes,"
        f" beneficiaries_per_state, {sql_snap('avg_submitted_to_allowed_ratio')} AS avg_submitted_to_allowed_ratio,"
        f" {sql_snap('avg_submitted_charge')} AS avg_submitted_charge, {sql_snap('avg_allowed_amt')} AS avg_allowed_amt,"
        f" {sql_snap('pct_weekend_claims')} AS pct_weekend_claims,"
        f" {sql_snap('high_chronic_burden_benes_pct')} AS high_chronic_burden_benes_pct FROM carrier",
    ),
    "feat_ratio_p95": _select(
        CLAIMS,
        f"SELECT at_physn_npi, yr AS period_year, {sql_snap('avg(ratio4) / 10000')} AS avg_submitted_to_allowed_ratio,"
        f" {sql_snap('quantile_cont(ratio4 / 10000.0, 0.95)')} AS p95_submitted_to_allowed_ratio FROM claims GROUP BY 1, 2",
    ),
    "feat_pos_mix": _select(
        CLAIMS,
        "SELECT at_physn_npi, yr AS period_year, count(DISTINCT place_of_service_cd) AS distinct_pos_codes, "
        + ", ".join(
            sql_snap(f"avg(CASE WHEN place_of_service_cd = '{code}' THEN 1.0 ELSE 0.0 END)") + f" AS pct_claims_{name}"
            for code, name in (("11", "office"), ("12", "home"), ("31", "nursing_facility"))
        )
        + " FROM claims GROUP BY 1, 2",
    ),
    "feat_daily_max": _select(f"{CLAIMS}, {_DAILY}", "SELECT * FROM daily"),
    "feat_claims_per_bene": _select(
        f"{CLAIMS}, {_PER_BENE}",
        f"SELECT {_K}, {sql_snap('avg_claims_per_beneficiary')} AS avg_claims_per_beneficiary FROM per_bene",
    ),
    "feat_code_mix": _select(
        f"{CLAIMS}, {_CODES}",
        f"SELECT {_K}, distinct_hcpcs_codes, top_hcpcs_code, {sql_snap('top_hcpcs_code_share')} AS top_hcpcs_code_share,"
        f" {sql_snap('hcpcs_concentration_score')} AS hcpcs_concentration_score FROM codes",
    ),
    "feat_exact_dups": _select(f"{CLAIMS_DENSE}, {_EXACT}", "SELECT * FROM exact_groups"),
    "feat_near_dups": _select(f"{CLAIMS_DENSE}, {_NEAR}", "SELECT * FROM near_rows"),
    "feat_duplicates": _select(
        features_cte(CLAIMS_DENSE),
        f"SELECT {_K}, total_carrier_claims, exact_duplicate_count, near_duplicate_count, duplicate_rate FROM features",
    ),
    "feat_post_death": _select(
        f"{CLAIMS}, {BENE}, {_CARRIER}",
        f"SELECT {_K}, claims_after_bene_death, claims_in_bene_death_year FROM carrier",
    ),
    "feat_growth": _select(
        f"{CLAIMS}, {_VOLUME}",
        f"SELECT {_K}, prior_period_claim_count, {sql_snap('claim_volume_growth_pct')} AS claim_volume_growth_pct FROM growth",
    ),
    "feat_outpatient": _select(
        f"{CLAIMS}, {OUTPATIENT}, {_VOLUME}, {_OP}",
        f"SELECT {_K}, coalesce(total_outpatient_claims, 0) AS total_outpatient_claims,"
        f" {sql_snap('coalesce(avg_outpatient_payment, 0)')} AS avg_outpatient_payment"
        f" FROM volume LEFT JOIN op USING ({_K})",
    ),
    "join_claim_bene": _select(
        f"{CLAIMS}, {BENE}",
        f"SELECT c.at_physn_npi, c.yr AS period_year, state_code, CAST({CONDITIONS} AS INT) AS conditions, count(*) AS claims"
        " FROM claims c LEFT JOIN bene b ON b.desynpuf_id = c.desynpuf_id AND b.year = c.yr GROUP BY 1, 2, 3, 4",
    ),
    "feat_keyed_replace": f"""
WITH {CLAIMS}, old_t AS (WITH {_CODES.replace('FROM claims', "FROM claims WHERE clm_from_dt < DATE '1998-01-01'")} SELECT * FROM codes),
new_t AS (WITH {_CODES.replace('FROM claims', "FROM claims WHERE clm_from_dt >= DATE '1997-01-01'")}
          SELECT * REPLACE ('new:' || top_hcpcs_code AS top_hcpcs_code) FROM codes),
merged AS (SELECT * FROM new_t UNION ALL
           SELECT * FROM old_t o WHERE NOT EXISTS (SELECT 1 FROM new_t n WHERE n.at_physn_npi = o.at_physn_npi AND n.period_year = o.period_year))
SELECT {_K}, distinct_hcpcs_codes, top_hcpcs_code, {sql_snap('top_hcpcs_code_share')} AS top_hcpcs_code_share,
       {sql_snap('hcpcs_concentration_score')} AS hcpcs_concentration_score FROM merged""",
}
