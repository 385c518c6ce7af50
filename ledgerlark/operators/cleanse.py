"""Staging tables (all text) to typed analytics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import cleaning as cl
from ledgerlark.operators.ranking import first_per_key
from ledgerlark.schema import (
    BENEFICIARY_SUMMARY,
    CARRIER_CLAIMS,
    CHRONIC_FLAGS,
    LINE_ALLOWED,
    LINE_CODE,
    LINE_PAID,
    LINE_PROVIDER,
    OUTPATIENT_CLAIMS,
    OUTPATIENT_CODE,
    OUTPATIENT_REVENUE,
    conform,
)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def _code(df: DataFrame, name: str) -> Column:
    return cl.code_from_text(cl.optional(df, name))


def clean_beneficiaries(staging: DataFrame) -> DataFrame:
    """One typed row per (beneficiary, year); rows without either key are dropped."""
    df = lower_names(staging)

    def small(name: str) -> Column:
        return cl.small_int_from_text(cl.optional(df, name).cast("string"))

    def money(name: str) -> Column:
        return cl.money_from_text(cl.optional(df, name))

    typed = df.select(
        _code(df, "desynpuf_id").alias("desynpuf_id"),
        small("year").alias("year"),
        small("sample_id").alias("sample_id"),
        cl.date_from_text(cl.optional(df, "bene_birth_dt")).alias("birth_date"),
        cl.date_from_text(cl.optional(df, "bene_death_dt")).alias("death_date"),
        _code(df, "bene_sex_ident_cd").alias("sex_cd"),
        _code(df, "bene_race_cd").alias("race_cd"),
        _code(df, "bene_esrd_ind").alias("esrd_ind"),
        _code(df, "sp_state_code").alias("state_code"),
        _code(df, "bene_county_cd").alias("county_cd"),
        small("bene_hi_cvrage_tot_mons").alias("part_a_months"),
        small("bene_smi_cvrage_tot_mons").alias("part_b_months"),
        small("bene_hmo_cvrage_tot_mons").alias("hmo_months"),
        *[small(old).alias(new) for old, new in CHRONIC_FLAGS.items()],
        money("medreimb_ip").alias("reimbursement_inpatient"),
        money("medreimb_op").alias("reimbursement_outpatient"),
        money("medreimb_car").alias("reimbursement_carrier"),
    ).dropna(subset=["desynpuf_id", "year"])
    unique = first_per_key(typed, ["desynpuf_id", "year"], ["sample_id"])
    return conform(unique.withColumn("chronic_condition_count", cl.chronic_count()), BENEFICIARY_SUMMARY)


def carrier_rows(staging: DataFrame) -> DataFrame:
    """Typed carrier claims before de-duplication.

    A claim needs an id, a provider on some line and a real service date.  The provider is the first
    line value that is neither missing nor blank, so a blank first line does not lose the claim.
    """
    df = lower_names(staging)
    typed = df.select(
        F.trim("clm_id").alias("clm_id"),
        F.trim("desynpuf_id").alias("desynpuf_id"),
        cl.first_filled(cl.present(df, LINE_PROVIDER)).alias("at_physn_npi"),
        cl.date_from_text(F.col("clm_from_dt")).alias("clm_from_dt"),
        cl.date_from_text(cl.optional(df, "clm_thru_dt")).alias("clm_thru_dt"),
        cl.money_sum(cl.present(df, LINE_PAID)).alias("clm_pmt_amt"),
        cl.money_sum(cl.present(df, LINE_ALLOWED)).alias("allowed_amt"),
        cl.code_array(cl.present(df, LINE_CODE)).alias("hcpcs_codes"),
        _code(df, "icd9_dgns_cd_1").alias("prncpal_dgns_cd"),
        _code(df, "nch_clm_type_cd").alias("nch_clm_type_cd"),
        _code(df, "line_place_of_srvc_cd").alias("place_of_service_cd"),
        cl.small_int_from_text(cl.optional(df, "sample_id").cast("string")).alias("sample_id"),
    ).dropna(subset=["clm_id", "at_physn_npi", "clm_from_dt"])
    return conform(
        typed.withColumns(
            {
                "claim_year": F.year("clm_from_dt"),
                "is_weekend_claim": cl.is_weekend(F.col("clm_from_dt")),
                "submitted_charge_amt": F.col("allowed_amt"),
                "submitted_to_allowed_ratio": cl.guarded_ratio(F.col("clm_pmt_amt"), F.col("allowed_amt")),
                "primary_hcpcs_cd": F.try_element_at("hcpcs_codes", F.lit(1)),
            }
        ),
        CARRIER_CLAIMS,
    )


def clean_carrier(staging: DataFrame) -> DataFrame:
    """Typed carrier claims, one row per claim id over all files."""
    return first_per_key(carrier_rows(staging), ["clm_id"], ["clm_from_dt", "desynpuf_id", "at_physn_npi"])


def outpatient_rows(staging: DataFrame) -> DataFrame:
    """Typed outpatient claims before de-duplication."""
    df = lower_names(staging)
    typed = df.select(
        F.trim("clm_id").alias("clm_id"),
        F.trim("desynpuf_id").alias("desynpuf_id"),
        *[_code(df, c).alias(c) for c in ("prvdr_num", "at_physn_npi", "clm_fac_type_cd")],
        _code(df, "icd9_dgns_cd_1").alias("prncpal_dgns_cd"),
        cl.date_from_text(F.col("clm_from_dt")).alias("clm_from_dt"),
        cl.date_from_text(cl.optional(df, "clm_thru_dt")).alias("clm_thru_dt"),
        cl.money_from_text(F.col("clm_pmt_amt")).alias("clm_pmt_amt"),
        cl.code_array(cl.present(df, OUTPATIENT_CODE)).alias("hcpcs_codes"),
        cl.code_array(cl.present(df, OUTPATIENT_REVENUE)).alias("revenue_codes"),
        cl.small_int_from_text(cl.optional(df, "sample_id").cast("string")).alias("sample_id"),
    ).dropna(subset=["clm_id", "clm_from_dt"])
    return conform(
        typed.withColumns(
            {"claim_year": F.year("clm_from_dt"), "is_weekend_claim": cl.is_weekend(F.col("clm_from_dt"))}
        ),
        OUTPATIENT_CLAIMS,
    )


def clean_outpatient(staging: DataFrame) -> DataFrame:
    """Typed outpatient claims, one row per claim id over all files."""
    return first_per_key(outpatient_rows(staging), ["clm_id"], ["clm_from_dt", "desynpuf_id"])
