"""Files to tables to scores, end to end, on a handful of claims."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import quality, reports
from ledgerlark.plans import backfill, benchmark, retrain, weekly
from ledgerlark.sources import raw, tables
from ledgerlark.sources.warehouse import Warehouse
from ledgerlark.streaming.refresh import refresh_from_files

NOW = datetime(2026, 1, 5)


def write_raw(root, lines_per_file=30):
    """Small raw zone: two samples, six files each, upper-case headers."""
    for s in (1, 2):
        folder = root / f"sample_0{s}"
        folder.mkdir(parents=True)
        carrier = "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_THRU_DT,ICD9_DGNS_CD_1,PRF_PHYSN_NPI_1,HCPCS_CD_1,LINE_NCH_PMT_AMT_1,LINE_ALOWD_CHRG_AMT_1"
        for part, letter in enumerate("AB"):
            rows = [
                f"B{i % 7},{s}{letter}{i},20{8 + i % 3:02d}0{1 + i % 9}1{i % 10},,{i},P{i % 5},9921{i % 4},{50 + i}.5,{100 + i}"
                for i in range(lines_per_file)
            ]
            (folder / f"DE1_0_2008_to_2010_Carrier_Claims_Sample_{s}{letter}.csv").write_text("\n".join([carrier, *rows]) + "\n")
        op = ["DESYNPUF_ID,CLM_ID,CLM_FROM_DT,CLM_PMT_AMT,AT_PHYSN_NPI,HCPCS_CD_1"]
        op += [f"B{i % 7},O{s}{i},20080{1 + i % 9}10,{i}.25,P{i % 5},X{i % 3}" for i in range(10)]
        (folder / f"DE1_0_2008_to_2010_Outpatient_Claims_Sample_{s}.csv").write_text("\n".join(op) + "\n")
        for y in (2008, 2009, 2010):
            bene = ["DESYNPUF_ID,BENE_BIRTH_DT,BENE_DEATH_DT,BENE_SEX_IDENT_CD,BENE_HI_CVRAGE_TOT_MONS,BENE_SMI_CVRAGE_TOT_MONS,SP_STATE_CODE,SP_CHF"]
            bene += [f"B{i},19400101,{'20090601' if i == 1 and y == 2009 else ''},1,12,12,{i % 3},{1 + i % 2}" for i in range(7)]
            (folder / f"DE1_0_{y}_Beneficiary_Summary_File_Sample_{s}.csv").write_text("\n".join(bene) + "\n")


@pytest.fixture(scope="module")
def zone(tmp_path_factory):
    root = tmp_path_factory.mktemp("zone")
    write_raw(root / "raw")
    return root


@pytest.fixture(scope="module")
def wh(spark, zone):
    wh = Warehouse(spark, str(zone / "warehouse"))
    backfill.backfill(wh, str(zone / "raw"), str(zone / "parquet"))
    return wh


def test_validation_finds_what_is_wrong(spark, tmp_path):
    write_raw(tmp_path)
    ok, findings = backfill.validate(spark, str(tmp_path))
    assert ok and {r.finding for r in findings.filter("severity = 'warning'").collect()} == {"DEVIATION"}
    bad = tmp_path / "sample_02"
    (bad / "DE1_0_2008_to_2010_Outpatient_Claims_Sample_2.csv").write_text("DESYNPUF_ID,CLM_ID,CLM_FROM_DT\nB1,,20080101\n")
    (bad / "DE1_0_2009_Beneficiary_Summary_File_Sample_2.csv").write_text("DESYNPUF_ID,BENE_BIRTH_DT\n")
    (bad / "DE1_0_2008_to_2010_Carrier_Claims_Sample_2B.csv").rename(bad / "kept_elsewhere.txt")
    ok, findings = backfill.validate(spark, str(tmp_path))
    errors = sorted((r.finding, r.column) for r in findings.filter("severity = 'error'").collect())
    assert not ok and errors == [("EMPTY", None), ("HIGH_NULL_RATE", "clm_id"), ("MISSING", None), ("MISSING_COLUMN", "clm_pmt_amt")]
    with pytest.raises(ValueError, match="MISSING"):
        backfill.backfill(Warehouse(spark, str(tmp_path / "w")), str(tmp_path), str(tmp_path / "p"))
    assert quality.summary([findings]).filter("sample = 'sample_01'").first().passed


def test_conversion_skips_existing_targets(spark, zone, wh):
    report = raw.convert_all(spark, str(zone / "raw"), str(zone / "parquet"))
    assert len(report) == 12 and {r["status"] for r in report} == {"skipped"}
    forced = raw.convert_all(spark, str(zone / "raw"), str(zone / "parquet"), sample="sample_01", force=True)
    assert len(forced) == 6 and {r["status"] for r in forced} == {"converted"}


def test_files_of_one_header_are_converted_by_one_job(spark, tmp_path, monkeypatch):
    for s in ("sample_01", "sample_02"):
        (tmp_path / "raw" / s).mkdir(parents=True)
        for i in range(20):
            (tmp_path / "raw" / s / f"part {i}.csv").write_text("A,B\n" + "".join(f"{s}{i},{j}\n" for j in range(i % 3)))
    (tmp_path / "raw" / "sample_01" / "other.csv").write_text('B,"a b",C\n1,,3\n')
    (tmp_path / "raw" / "sample_01" / "nothing.csv").write_text("")
    groups = raw.group_files(spark, [(r["sample"], r["file_name"], r["location"]) for r in raw.discover(spark, str(tmp_path / "raw")).collect()])
    assert sorted((len(g.files), g.columns) for g in groups) == [(1, ("b", "a b", "c")), (40, ("a", "b"))]  # a file without bytes is not listed
    target = tmp_path / "parquet"

    def broken(spark, staged, place, publish=raw._publish):
        if place.endswith("sample_02/part 7.parquet"):
            raise OSError("no room")
        publish(spark, staged, place)

    with monkeypatch.context() as m:
        m.setattr(raw, "_publish", broken)
        with pytest.raises(OSError):
            raw.convert_all(spark, str(tmp_path / "raw"), str(target))
    made = {p.name for p in target.iterdir()}
    assert made <= {"sample_01", "sample_02"} and not (target / "sample_02" / "part 7.parquet").exists()
    report = raw.convert_all(spark, str(tmp_path / "raw"), str(target))
    assert len(report) == 41 and {r["status"] for r in report} == {"converted", "skipped"}
    for s in ("sample_01", "sample_02"):
        for i in (0, 4, 7, 19):
            back = spark.read.parquet(str(target / s / f"part {i}.parquet"))
            assert back.columns == ["a", "b"] and sorted(map(tuple, back.collect())) == [(f"{s}{i}", str(j)) for j in range(i % 3)]
    assert spark.read.parquet(str(target / "sample_01" / "other.parquet")).collect()[0].asDict() == {"b": "1", "a b": None, "c": "3"}


def test_audit_of_copies_equals_audit_of_raw_files(spark, zone, wh, tmp_path):
    ok, raw_findings = backfill.validate(spark, str(zone / "raw"))
    copied, findings = backfill.audit_converted(spark, str(zone / "parquet"))
    assert ok and copied and sorted(map(str, raw_findings.collect())) == sorted(map(str, findings.collect()))
    write_raw(tmp_path / "raw")
    (tmp_path / "raw" / "sample_02" / "DE1_0_2009_Beneficiary_Summary_File_Sample_2.csv").write_text("DESYNPUF_ID,BENE_BIRTH_DT\n")
    with pytest.raises(ValueError, match="EMPTY"):
        backfill.backfill(Warehouse(spark, str(tmp_path / "w")), str(tmp_path / "raw"), str(tmp_path / "p"))
    assert not list((tmp_path / "p").rglob("*.parquet"))  # corrected files are converted next time


def test_staging_is_reloaded_as_a_whole(spark, zone, tmp_path):
    own = Warehouse(spark, str(tmp_path))
    for _ in range(2):
        rows = backfill.load_staging(own, str(zone / "parquet"), "beneficiary")
    assert sorted((r.year, r.sample_id) for r in rows.select("year", "sample_id").distinct().collect()) == [
        (y, s) for y in (2008, 2009, 2010) for s in (1, 2)
    ]
    assert rows.count() == 42 and spark.read.parquet(own.path("load_log")).count() == 12


def test_tables_of_the_backfill(spark, wh):
    assert wh.carrier().count() == 120 and wh.outpatient().count() == 20
    bene = wh.beneficiaries()
    assert bene.count() == 21  # both samples name the same people: one row per beneficiary and year
    assert bene.filter("death_date IS NOT NULL").select("desynpuf_id", "year").collect() == [("B1", 2009)]
    log = spark.read.parquet(wh.path("load_log"))
    assert log.agg(F.sum("rows_loaded")).first()[0] == 120 + 20 + 42
    from ledgerlark.operators.features import active_providers

    plan = active_providers(wh.carrier(), "2009-12-01", "2010-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "(claim_year" in plan.split("PartitionFilters: ")[1].split("]")[0] and ">= 2009" in plan and "<= 2010" in plan
    plan = wh.carrier().filter("claim_year = 2009 AND at_physn_npi = 'P1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(claim_year" in plan and "EqualTo(at_physn_npi,P1)" in plan


def test_weekly_runs_cover_all_claims_and_equal_a_full_refresh(spark, wh):
    runs = []
    while (run := weekly.run_weekly(wh, batch_size=50, threshold=50, now=NOW)) is not None:
        runs.append(run)
    assert sum(r["claims"] for r in runs) == 120 and [r["batch_id"] for r in runs] == list(range(1, len(runs) + 1))
    assert len(runs) >= 2
    from ledgerlark.operators.features import provider_year_features

    full = provider_year_features(wh.carrier(), wh.beneficiaries(), wh.outpatient()).drop("batch_id")
    names = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in full.dtypes]
    assert sorted(map(str, full.select(*names).collect())) == sorted(map(str, wh.features().drop("batch_id").select(*names).collect()))
    scores = spark.read.parquet(wh.path("provider_risk_scores"))
    flagged = scores.filter("is_flagged")
    assert flagged.count() > 0 and flagged.filter("top_reason_1 IS NULL").isEmpty()
    assert scores.filter("NOT is_flagged AND top_reason_1 IS NOT NULL").isEmpty()
    shap = spark.read.parquet(wh.path("shap_values"))
    assert shap.count() == 18 * flagged.count()
    from ledgerlark.sources.warehouse import RUN_EVENTS

    log = reports.run_log(wh.state("run_events", RUN_EVENTS), scores)
    view = reports.overview(log, scores, retrain.registry(wh))
    assert view.count() == len(runs) and view.filter("model_version IS NULL").isEmpty()
    assert reports.totals(log).first().claims_processed == 120
    one = flagged.first().at_physn_npi
    page = reports.provider_explanation(shap, one).select("shap_value").collect()
    assert [abs(r[0]) for r in page] == sorted((abs(r[0]) for r in page), reverse=True)


def test_retraining_keeps_or_promotes(spark, wh):
    if not tables.table_exists(spark, wh.path("provider_features")):
        weekly.refresh_features(wh, 1)
    first = retrain.active_model(wh)
    out = retrain.run_retraining(wh, NOW, trees=20)
    assert out["promoted"] == (first is None or out["reason"].startswith("improvement"))
    state = retrain.registry(wh)
    assert state.filter("is_active").count() == 1
    retrain.promote(wh, out["model_id"], NOW, "by hand")
    row = retrain.registry(wh).filter("is_active").collect()
    assert [(r.model_id, r.notes) for r in row] == [(out["model_id"], "by hand")]
    retrain.promote(wh, out["model_id"], NOW)
    assert retrain.registry(wh).filter("is_active").first().notes == "by hand"


def test_supervised_benchmark(spark, wh):
    with pytest.raises(FileNotFoundError):
        benchmark.train_and_evaluate(Warehouse(spark, wh.path("nowhere")))
    rate = benchmark.run_injections(wh)
    assert rate["rows"] == 3 * wh.features().count() and rate["anomalies"] > 0
    out = benchmark.train_and_evaluate(wh, params={"maxIter": 2, "maxDepth": 2})
    assert set(out) == {"overall", "scenarios", "report", "top_features"} and len(out["top_features"]) == 5
    scored = benchmark.score(wh, wh.features())
    assert scored.count() == wh.features().count() and scored.filter("prob IS NULL OR prob NOT BETWEEN 0 AND 1").isEmpty()


def test_replace_rows_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("a", 2, "x")], "k string, y int, v string")
    tables.full_refresh(old, path, ["y"])
    before = set((tmp_path / "t" / "y=2").iterdir())
    tables.replace_rows(spark.createDataFrame([("b", 1, "new"), ("c", 1, "new")], "k string, y int, v string"), path, ["k", "y"], "y")
    got = sorted(map(tuple, spark.read.parquet(path).select("k", "y", "v").collect()))
    assert got == [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "new"), ("c", 1, "new")]
    assert set((tmp_path / "t" / "y=2").iterdir()) == before
    tables.append_absent(spark.createDataFrame([("z", 1)], "k string, n int"), str(tmp_path / "s"), ["k"])
    tables.append_absent(spark.createDataFrame([("z", 2), ("y", 3)], "k string, n int"), str(tmp_path / "s"), ["k"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "s")).collect())) == [("y", 3), ("z", 1)]


def test_stream_equals_full_refresh_and_sees_late_claims(spark, wh, tmp_path):
    from ledgerlark.operators.features import provider_year_features

    claims = wh.carrier()
    late = F.col("claim_year") == 2008
    claims.filter(~late).coalesce(1).write.parquet(str(tmp_path / "claims"))
    args = (claims.schema, wh.beneficiaries(), wh.outpatient(), str(tmp_path / "features"), str(tmp_path / "cp"))
    refresh_from_files(spark, str(tmp_path / "claims"), *args).awaitTermination()
    claims.filter(late).coalesce(1).write.mode("append").parquet(str(tmp_path / "claims"))
    refresh_from_files(spark, str(tmp_path / "claims"), *args).awaitTermination()
    full = provider_year_features(claims, wh.beneficiaries(), wh.outpatient()).drop("batch_id")
    got = spark.read.parquet(str(tmp_path / "features")).select(*full.columns)
    names = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in full.dtypes]
    assert sorted(map(str, full.select(*names).collect())) == sorted(map(str, got.select(*names).collect()))
