"""Text cleaners, case by case, and the typed tables built from them."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import cleaning as cl
from ledgerlark.operators import cleanse
from ledgerlark.schema import BENEFICIARY_SUMMARY, CARRIER_CLAIMS, CHRONIC_FLAGS


def apply(spark, values, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_dates(spark):
    given = ["20080115", "20080115.0", "", "0", "nan", None, "2008-01-15", "2008", "ABCDEFGH", "20081399", " 20080115 "]
    want = [date(2008, 1, 15)] * 2 + [None] * 8 + [date(2008, 1, 15)]
    assert apply(spark, given, cl.date_from_text) == want


def test_numbers(spark):
    given = ["1500", "1500.75", "0", "-250.5", None, "", "NaN", "unknown", "1.5d", "1e3"]
    assert apply(spark, given, cl.double_from_text) == [1500.0, 1500.75, 0.0, -250.5, None, None, None, None, None, 1000.0]


def test_small_integers(spark):
    assert apply(spark, ["12", "12.0", "x", None, "1.5", "99999"], cl.small_int_from_text) == [12, 12, None, None, None, None]


def test_codes(spark):
    assert apply(spark, [" A ", "nan", None, ""], cl.code_from_text) == ["A", None, None, ""]


@pytest.mark.parametrize(
    "codes,want",
    [
        (["99213", "93000", ""], ["99213", "93000"]),
        (["99213", "99213", "93000"], ["99213", "93000"]),
        (["nan", "0", ""], []),
        (["A", "B", "C"], ["A", "B", "C"]),
        ([None, "none", " X "], ["X"]),
    ],
)
def test_code_array(spark, codes, want):
    df = spark.createDataFrame([codes], "a string, b string, c string")
    assert df.select(cl.code_array(cl.present(df, ["a", "b", "missing", "c"])).alias("o")).first()["o"] == want


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(Decimal("80.00"), Decimal("100.00")), (Decimal("1.00"), Decimal("0.00"))], "p decimal(14,2), a decimal(14,2)")
    assert [r[0] for r in df.select(cl.guarded_ratio(F.col("p"), F.col("a"))).collect()] == [Decimal("0.8000"), None]


def carrier(spark, **changes):
    row = {
        "clm_id": "C1", "desynpuf_id": " B1 ", "clm_from_dt": "20080105", "clm_thru_dt": "20080106",
        "prf_physn_npi_1": None, "prf_physn_npi_2": " 42 ", "line_alowd_chrg_amt_1": "100", "line_alowd_chrg_amt_2": "x",
        "line_nch_pmt_amt_1": "60.5", "line_nch_pmt_amt_2": "19.5", "hcpcs_cd_1": "0", "hcpcs_cd_2": "99213",
        "icd9_dgns_cd_1": "nan", "sample_id": "1",
    }
    rows = changes.pop("rows", None) or [{**row, **changes}]
    names = list(row)
    return spark.createDataFrame([tuple({**row, **r}[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def test_carrier_claim(spark):
    out = cleanse.clean_carrier(carrier(spark))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CARRIER_CLAIMS]
    r = out.first()
    assert (r.clm_id, r.desynpuf_id, r.at_physn_npi) == ("C1", "B1", "42")
    assert (r.allowed_amt, r.clm_pmt_amt, r.submitted_charge_amt) == (Decimal("100.00"), Decimal("80.00"), Decimal("100.00"))
    assert (r.submitted_to_allowed_ratio, r.primary_hcpcs_cd, r.hcpcs_codes) == (Decimal("0.8000"), "99213", ["99213"])
    assert r.is_weekend_claim and r.claim_year == 2008 and r.prncpal_dgns_cd is None and r.place_of_service_cd is None


def test_carrier_rows_without_key_provider_or_date_are_dropped(spark):
    bad = [{"clm_id": None}, {"prf_physn_npi_2": "  "}, {"clm_from_dt": "0"}, {"clm_from_dt": "20081399"}]
    assert cleanse.clean_carrier(carrier(spark, rows=bad)).count() == 0


def test_blank_first_provider_does_not_lose_the_claim(spark):
    assert cleanse.clean_carrier(carrier(spark, prf_physn_npi_1="")).first().at_physn_npi == "42"


def test_claims_are_unique_over_all_files_and_independent_of_partitioning(spark):
    rows = [{"clm_id": f"C{i % 3}", "clm_from_dt": f"2008010{1 + i % 5}"} for i in range(30)]
    df = carrier(spark, rows=rows)
    one = sorted(map(str, cleanse.clean_carrier(df.repartition(1)).collect()))
    many = sorted(map(str, cleanse.clean_carrier(df.repartition(7)).collect()))
    assert one == many and len(one) == 3
    assert all("datetime.date(2008, 1, 1)" in r for r in one)


def test_beneficiary(spark):
    flags = {old: "2" for old in CHRONIC_FLAGS} | {"sp_chf": "1", "sp_copd": "1.0"}
    row = {"DESYNPUF_ID": "B1", "BENE_BIRTH_DT": "19400101", "BENE_DEATH_DT": "0", "sp_state_code": "26", "year": "2008", **flags}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} string" for n in row))
    out = cleanse.clean_beneficiaries(df)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in BENEFICIARY_SUMMARY]
    r = out.first()
    assert (r.birth_date, r.death_date, r.chronic_condition_count, r.year, r.sample_id) == (date(1940, 1, 1), None, 2, 2008, None)
