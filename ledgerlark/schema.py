"""Table layouts.  Column names are those of the public synthetic Medicare claim files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
RATIO = T.DecimalType(18, 4)

LINES = range(1, 14)
LINE_PROVIDER = [f"prf_physn_npi_{i}" for i in LINES]
LINE_PAID = [f"line_nch_pmt_amt_{i}" for i in LINES]
LINE_ALLOWED = [f"line_alowd_chrg_amt_{i}" for i in LINES]
LINE_CODE = [f"hcpcs_cd_{i}" for i in LINES]
OUTPATIENT_CODE = [f"hcpcs_cd_{i}" for i in range(1, 46)]
OUTPATIENT_REVENUE = [f"revenue_cd_{i}" for i in range(1, 6)]

# Source flag column -> analytics flag column.
CHRONIC_FLAGS = {
    "sp_alzhdmta": "flag_alzheimer",
    "sp_chf": "flag_chf",
    "sp_chrnkidn": "flag_chronic_kidney",
    "sp_cncr": "flag_cancer",
    "sp_copd": "flag_copd",
    "sp_depressn": "flag_depression",
    "sp_diabetes": "flag_diabetes",
    "sp_ischmcht": "flag_ischemic_heart",
    "sp_osteoprs": "flag_osteoporosis",
    "sp_ra_oa": "flag_ra_oa",
    "sp_strketia": "flag_stroke",
}


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_WIDE_LINE_PREFIXES = (
    "prf_physn_npi",
    "tax_num",
    "hcpcs_cd",
    "line_nch_pmt_amt",
    "line_bene_ptb_ddctbl_amt",
    "line_bene_prmry_pyr_pd_amt",
    "line_coinsrnc_amt",
    "line_alowd_chrg_amt",
    "line_prcsg_ind_cd",
    "line_icd9_dgns_cd",
)

RAW_CARRIER = _text(
    "desynpuf_id",
    "clm_id",
    "clm_from_dt",
    "clm_thru_dt",
    *[f"icd9_dgns_cd_{i}" for i in range(1, 9)],
    *[f"{p}_{i}" for p in _WIDE_LINE_PREFIXES for i in LINES],
)

RAW_BENEFICIARY = _text(
    "desynpuf_id",
    "bene_birth_dt",
    "bene_death_dt",
    "bene_sex_ident_cd",
    "bene_race_cd",
    "bene_esrd_ind",
    "sp_state_code",
    "bene_county_cd",
    "bene_hi_cvrage_tot_mons",
    "bene_smi_cvrage_tot_mons",
    "bene_hmo_cvrage_tot_mons",
    "plan_cvrg_mos_num",
    *CHRONIC_FLAGS,
    *[f"{kind}_{place}" for place in ("ip", "op", "car") for kind in ("medreimb", "benres", "pppymt")],
)

RAW_OUTPATIENT = _text(
    "desynpuf_id",
    "clm_id",
    "clm_from_dt",
    "clm_thru_dt",
    "prvdr_num",
    "clm_pmt_amt",
    "at_physn_npi",
    "clm_fac_type_cd",
    *[f"icd9_dgns_cd_{i}" for i in range(1, 11)],
    *OUTPATIENT_CODE,
    *OUTPATIENT_REVENUE,
)

RAW_BY_TYPE = {"beneficiary": RAW_BENEFICIARY, "carrier": RAW_CARRIER, "outpatient": RAW_OUTPATIENT}

BENEFICIARY_SUMMARY = T.StructType(
    [
        T.StructField("desynpuf_id", T.StringType()),
        T.StructField("year", T.ShortType()),
        T.StructField("sample_id", T.ShortType()),
        T.StructField("birth_date", T.DateType()),
        T.StructField("death_date", T.DateType()),
        *[T.StructField(n, T.StringType()) for n in ("sex_cd", "race_cd", "esrd_ind", "state_code", "county_cd")],
        *[T.StructField(n, T.ShortType()) for n in ("part_a_months", "part_b_months", "hmo_months")],
        *[T.StructField(n, T.ShortType()) for n in CHRONIC_FLAGS.values()],
        T.StructField("chronic_condition_count", T.IntegerType()),
        *[T.StructField(f"reimbursement_{n}", MONEY) for n in ("inpatient", "outpatient", "carrier")],
    ]
)

CARRIER_CLAIMS = T.StructType(
    [
        T.StructField("clm_id", T.StringType()),
        T.StructField("desynpuf_id", T.StringType()),
        T.StructField("at_physn_npi", T.StringType()),
        T.StructField("clm_from_dt", T.DateType()),
        T.StructField("clm_thru_dt", T.DateType()),
        T.StructField("claim_year", T.IntegerType()),
        T.StructField("clm_pmt_amt", MONEY),
        T.StructField("submitted_charge_amt", MONEY),
        T.StructField("allowed_amt", MONEY),
        T.StructField("submitted_to_allowed_ratio", RATIO),
        T.StructField("place_of_service_cd", T.StringType()),
        T.StructField("nch_clm_type_cd", T.StringType()),
        T.StructField("prncpal_dgns_cd", T.StringType()),
        T.StructField("primary_hcpcs_cd", T.StringType()),
        T.StructField("hcpcs_codes", T.ArrayType(T.StringType())),
        T.StructField("sample_id", T.ShortType()),
        T.StructField("is_weekend_claim", T.BooleanType()),
    ]
)

OUTPATIENT_CLAIMS = T.StructType(
    [
        T.StructField("clm_id", T.StringType()),
        T.StructField("desynpuf_id", T.StringType()),
        T.StructField("prvdr_num", T.StringType()),
        T.StructField("at_physn_npi", T.StringType()),
        T.StructField("clm_from_dt", T.DateType()),
        T.StructField("clm_thru_dt", T.DateType()),
        T.StructField("claim_year", T.IntegerType()),
        T.StructField("clm_pmt_amt", MONEY),
        T.StructField("clm_fac_type_cd", T.StringType()),
        T.StructField("prncpal_dgns_cd", T.StringType()),
        T.StructField("hcpcs_codes", T.ArrayType(T.StringType())),
        T.StructField("revenue_codes", T.ArrayType(T.StringType())),
        T.StructField("sample_id", T.ShortType()),
        T.StructField("is_weekend_claim", T.BooleanType()),
    ]
)

# The model inputs, in the order the models expect them.
MODEL_FEATURES = [
    "total_carrier_claims",
    "carrier_claims_per_bene",
    "claim_volume_growth_pct",
    "distinct_hcpcs_codes",
    "top_hcpcs_code_share",
    "hcpcs_concentration_score",
    "avg_submitted_to_allowed_ratio",
    "p95_submitted_to_allowed_ratio",
    "distinct_beneficiaries",
    "avg_claims_per_beneficiary",
    "beneficiaries_per_state",
    "high_chronic_burden_benes_pct",
    "pct_weekend_claims",
    "max_claims_in_single_day",
    "exact_duplicate_count",
    "near_duplicate_count",
    "duplicate_rate",
    "claims_after_bene_death",
]

PROVIDER_FEATURES = T.StructType(
    [
        T.StructField("at_physn_npi", T.StringType()),
        T.StructField("period_year", T.IntegerType()),
        T.StructField("batch_id", T.IntegerType()),
        T.StructField("total_carrier_claims", T.LongType()),
        T.StructField("distinct_beneficiaries", T.LongType()),
        T.StructField("distinct_hcpcs_codes", T.LongType()),
        T.StructField("distinct_pos_codes", T.LongType()),
        T.StructField("beneficiaries_per_state", T.LongType()),
        T.StructField("avg_submitted_to_allowed_ratio", T.DoubleType()),
        T.StructField("p95_submitted_to_allowed_ratio", T.DoubleType()),
        T.StructField("avg_submitted_charge", T.DoubleType()),
        T.StructField("avg_allowed_amt", T.DoubleType()),
        T.StructField("pct_weekend_claims", T.DoubleType()),
        T.StructField("max_claims_in_single_day", T.LongType()),
        T.StructField("claims_after_bene_death", T.LongType()),
        T.StructField("claims_in_bene_death_year", T.LongType()),
        T.StructField("high_chronic_burden_benes_pct", T.DoubleType()),
        T.StructField("pct_claims_office", T.DoubleType()),
        T.StructField("pct_claims_home", T.DoubleType()),
        T.StructField("pct_claims_nursing_facility", T.DoubleType()),
        T.StructField("avg_claims_per_beneficiary", T.DoubleType()),
        T.StructField("carrier_claims_per_bene", T.DoubleType()),
        T.StructField("top_hcpcs_code", T.StringType()),
        T.StructField("top_hcpcs_code_share", T.DoubleType()),
        T.StructField("hcpcs_concentration_score", T.DoubleType()),
        T.StructField("exact_duplicate_count", T.LongType()),
        T.StructField("near_duplicate_count", T.LongType()),
        T.StructField("duplicate_rate", T.DoubleType()),
        T.StructField("prior_period_claim_count", T.LongType()),
        T.StructField("claim_volume_growth_pct", T.DoubleType()),
        T.StructField("total_outpatient_claims", T.LongType()),
        T.StructField("avg_outpatient_payment", T.DoubleType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a table layout; optional columns the frame lacks become typed NULLs."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[f.name]) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
