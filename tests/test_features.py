"""Feature semantics on small claim sets."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import features as fx
from ledgerlark.operators.pairs import claim_pairs
from ledgerlark.schema import MODEL_FEATURES, PROVIDER_FEATURES

CLAIM = (
    "clm_id string, at_physn_npi string, desynpuf_id string, clm_from_dt date, primary_hcpcs_cd string,"
    " place_of_service_cd string, submitted_charge_amt decimal(14,2), allowed_amt decimal(14,2),"
    " submitted_to_allowed_ratio decimal(18,4)"
)
BENE = "desynpuf_id string, year int, state_code string, death_date date, flag_chf int, flag_copd int, flag_diabetes int"
OP = "at_physn_npi string, desynpuf_id string, clm_from_dt date, clm_pmt_amt decimal(14,2)"


def claims(spark, rows):
    """rows: (npi, bene, day, code[, ratio[, pos]])"""
    full = []
    for i, r in enumerate(rows):
        npi, bene, day, code, *rest = r
        ratio = None if not rest or rest[0] is None else Decimal(str(rest[0]))
        pos = rest[1] if len(rest) > 1 else None
        d = None if day is None else date.fromisoformat(day)
        full.append((f"c{i:04d}", npi, bene, d, code, pos, Decimal("10.00"), Decimal("10.00"), ratio))
    return spark.createDataFrame(full, CLAIM)


def run(spark, rows, bene=(), op=(), **kw):
    out = fx.provider_year_features(
        claims(spark, rows), spark.createDataFrame(list(bene), BENE), spark.createDataFrame(list(op), OP), **kw
    )
    return {(r.at_physn_npi, r.period_year): r for r in out.collect()}


def dup(spark, rows):
    return {k: (r.exact_duplicate_count, r.near_duplicate_count) for k, r in run(spark, rows).items()}


@pytest.mark.parametrize(
    "rows,want",
    [
        ([("A", "1", "2008-05-01", "X"), ("A", "1", "2008-06-01", "Y")], (0, 0)),
        ([("A", "1", "2008-05-01", "X")] * 2 + [("A", "1", "2008-07-01", "Y")], (1, 0)),
        ([("A", "1", "2008-05-01", "X"), ("A", "1", "2008-05-03", "X")], (0, 1)),
        ([("A", "1", "2008-05-01", "X"), ("A", "1", "2008-05-06", "X")], (0, 0)),
        ([("A", "1", "2008-05-01", "X"), ("A", "2", "2008-05-01", "X")], (0, 0)),
        ([("A", "1", "2008-05-01", "X"), ("A", "1", "2008-05-02", "X"), ("A", "1", "2008-05-02", "X")], (1, 1)),
        ([("A", None, "2008-05-01", None), ("A", None, "2008-05-02", None)], (0, 1)),
    ],
)
def test_duplicates(spark, rows, want):
    assert dup(spark, rows)[("A", 2008)] == want


def test_duplicates_stay_with_their_provider(spark):
    got = dup(spark, [("A", "1", "2008-05-01", "X")] * 2 + [("B", "1", "2008-05-01", "X")])
    assert got == {("A", 2008): (1, 0), ("B", 2008): (0, 0)}


def test_near_duplicate_across_new_year_counts_in_the_later_year(spark):
    got = dup(spark, [("A", "1", "2008-12-31", "X"), ("A", "1", "2009-01-02", "X")])
    assert got == {("A", 2008): (0, 0), ("A", 2009): (0, 1)}


def test_volume_distinct_ratio_weekend(spark):
    days = ["2008-01-05", "2008-01-06", "2008-01-07", "2008-01-08"]
    rows = [("A", b, d, "X", r) for b, d, r in zip(["1", "1", "2", "3"], days, [2, 3, None, None])]
    r = run(spark, rows)[("A", 2008)]
    assert (r.total_carrier_claims, r.distinct_beneficiaries) == (4, 3)
    assert r.avg_submitted_to_allowed_ratio == pytest.approx(2.5)
    assert r.p95_submitted_to_allowed_ratio == pytest.approx(2.95)
    assert r.pct_weekend_claims == pytest.approx(0.5)
    assert (r.distinct_pos_codes, r.pct_claims_office, r.claim_volume_growth_pct) == (0, 0.0, None)


def test_percentile_is_exact_on_many_values(spark):
    import numpy as np

    values = [round(0.0001 * ((i * 7919) % 10007), 4) for i in range(1500)]
    r = run(spark, [("A", "1", "2008-01-05", "X", v) for v in values])[("A", 2008)]
    assert r.p95_submitted_to_allowed_ratio == pytest.approx(np.percentile(values, 95), abs=1e-12)


def test_post_death(spark):
    bene = [("1", 2008, "5", date(2008, 6, 1), 2, 2, 2), ("2", 2008, "6", date(2008, 11, 20), 1, 1, 1)]
    rows = [("A", "1", "2008-07-15", "X"), ("A", "1", "2008-04-10", "X"), ("A", "2", "2008-03-01", "X"), ("A", "3", "2008-03-01", "X")]
    r = run(spark, rows, bene)[("A", 2008)]
    assert (r.claims_after_bene_death, r.claims_in_bene_death_year, r.beneficiaries_per_state) == (1, 3, 2)
    assert r.high_chronic_burden_benes_pct == pytest.approx(0.25)


def test_death_is_taken_from_the_claims_own_year_unless_asked(spark):
    bene = [("1", 2008, "5", date(2008, 6, 1), 2, 2, 2)]
    rows = [("A", "1", "2009-02-01", "X")]
    assert run(spark, rows, bene)[("A", 2009)].claims_after_bene_death == 0
    assert run(spark, rows, bene, death_any_year=True)[("A", 2009)].claims_after_bene_death == 1


def test_top_code_tie_and_missing_code(spark):
    rows = [("A", "1", "2008-01-02", c) for c in ("Z", "B", "B", "Z", None)]
    r = run(spark, rows)[("A", 2008)]
    assert (r.top_hcpcs_code, r.distinct_hcpcs_codes) == ("B", 2)
    assert r.top_hcpcs_code_share == pytest.approx(0.4)
    assert r.hcpcs_concentration_score == pytest.approx(0.36)


def test_growth_needs_the_year_before(spark):
    rows = [("A", "1", "2008-01-02", "X"), ("A", "1", "2008-03-02", "X")]
    rows += [("A", "1", "2009-01-02", "X")] * 3 + [("A", "1", "2011-01-02", "X")]
    got = run(spark, rows)
    assert set(got) == {("A", 2008), ("A", 2009), ("A", 2011)}
    assert got[("A", 2009)].claim_volume_growth_pct == pytest.approx(50.0)
    assert (got[("A", 2011)].prior_period_claim_count, got[("A", 2011)].claim_volume_growth_pct) == (0, None)


def test_outpatient_and_daily_max(spark):
    op = [("A", "1", date(2008, 2, 1), Decimal("30.00")), ("A", "1", date(2008, 2, 2), None), ("B", "1", date(2008, 2, 2), None)]
    rows = [("A", b, "2008-01-02", "X") for b in "123"] + [("A", "1", "2008-02-02", "X")]
    got = run(spark, rows, op=op)
    assert set(got) == {("A", 2008)}
    r = got[("A", 2008)]
    assert (r.total_outpatient_claims, r.avg_outpatient_payment, r.max_claims_in_single_day) == (2, 30.0, 3)
    assert r.avg_claims_per_beneficiary == pytest.approx(4 / 3)


def test_window_is_half_open_and_keeps_full_history(spark):
    rows = [("A", "1", "2008-01-02", "X"), ("A", "1", "2009-01-10", "X"), ("B", "1", "2009-01-01", "X"), ("C", "1", "2009-01-11", "X")]
    got = run(spark, rows, start="2009-01-01", end="2009-01-10", batch_id=7)
    assert set(got) == {("A", 2008), ("A", 2009)}
    assert got[("A", 2008)].batch_id == 7


def test_schema_and_model_inputs(spark):
    out = fx.provider_year_features(claims(spark, []), spark.createDataFrame([], BENE), spark.createDataFrame([], OP))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in PROVIDER_FEATURES]
    assert len(MODEL_FEATURES) == 18 and set(MODEL_FEATURES) <= set(out.columns)


def _skewed(spark):
    rows = [("BIG", "1", "2008-05-01", "X", 0.5)] * 400
    rows += [("BIG", str(i % 7), str(date(2008, 1, 1) + timedelta(days=i % 300)), f"C{i % 5}", 0.25 + 0.001 * (i % 50)) for i in range(400)]
    rows += [(f"N{i % 20}", str(i), str(date(2008, 1, 1) + timedelta(days=i % 300)), "Y", 0.75) for i in range(400)]
    rows += [("BIG", "9", str(date(2008, 3, 1) + timedelta(days=i * 2)), "X", 0.5) for i in range(10)]
    return rows


def test_result_does_not_depend_on_partitioning(spark):
    rows = _skewed(spark)
    bene = spark.createDataFrame([], BENE)
    op = spark.createDataFrame([], OP)
    frames = [fx.provider_year_features(claims(spark, rows).repartition(n), bene, op) for n in (1, 13)]
    shown = [sorted(str(r.asDict()) for r in f.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in f.dtypes]).collect()) for f in frames]
    assert shown[0] == shown[1] and len(shown[0]) == 21


def test_pairs_match_the_duplicate_counts(spark):
    df = claims(spark, _skewed(spark)).withColumn("clm_id", F.concat("at_physn_npi", F.lit("-"), F.monotonically_increasing_id())).persist()
    pairs = {r["duplicate_type"]: r["n"] for r in claim_pairs(df).groupBy("duplicate_type").agg(F.count("*").alias("n")).collect()}
    cells = fx.claim_cells(df)
    surplus = cells.agg(F.sum(F.col("cnt") - 1)).first()[0]
    near = fx.duplicate_days(cells).agg(F.sum("near")).first()[0]
    assert (pairs["exact"], pairs["near"]) == (surplus, near)
    both = claim_pairs(df).join(df.select(F.col("clm_id").alias("clm_id_a"), F.col("clm_from_dt").alias("da")), "clm_id_a")
    assert both.filter("da <> date_a OR clm_id_a = clm_id_b OR date_diff_days NOT BETWEEN 0 AND 3").isEmpty()


def test_long_and_short_provider_lists_keep_the_same_claims(spark):
    df = claims(spark, _skewed(spark))
    some = spark.createDataFrame([("BIG",), ("N3",)], "at_physn_npi string")
    spread = ("desynpuf_id", "clm_from_dt", "clm_id")
    short = fx.keep_providers(df, some, spread)
    long = fx.keep_providers(df, some, spread, list_size=10**9)
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect())) and short.columns == long.columns
    assert "BroadcastHashJoin" in short._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in long._jdf.queryExecution().executedPlan().toString()
