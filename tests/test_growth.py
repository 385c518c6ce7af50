"""How the shared steps grow: what is shuffled, how often a view is run, and that the rows stay the same."""

import re

import pytest

from ledgerlark.checks import cleaning_checks as cc
from ledgerlark.checks import score_checks as sc
from ledgerlark.operators import features as fx
from ledgerlark.sources import raw
from ledgerlark.sources import sample_views as views

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def tables(spark, tmp_path):
    """Lines, orders, parts and customers with repeated keys and NULLs."""
    d = str(tmp_path)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz"
    days = ["1996-12-30", "1997-01-02", "1997-01-02", None]
    lines = [(o, (o or 0) % 3 + 1, (o or 0) % 4, n, 10.25 * n, 0.05, "ANR"[n % 3], days[((o or 0) + n) % 4]) for o in (1, 2, 3, 4, None) for n in (1, 2, 2, 15)]
    spark.createDataFrame(lines, line.replace("timestamp_ntz", "string")).selectExpr(
        *[c.split()[0] for c in line.split(", ")[:-1]], "cast(l_shipdate AS timestamp_ntz) AS l_shipdate"
    ).write.parquet(f"{d}/lineitem.parquet")
    orders = [(1, 7, "P1"), (2, 7, "P2"), (3, 8, None), (3, 9, "P3"), (4, None, "P4")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(1, "A"), (2, None), (3, "C"), (3, "D")], "p_partkey long, p_type string").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(7, 1), (7, 2), (8, None), (8, None), (9, 3)], "c_custkey long, c_nationkey int").write.parquet(f"{d}/customer.parquet")
    return d


@pytest.mark.parametrize("text", [views.BENE, views.WIDE_CLAIMS])
def test_planned_view_has_the_rows_of_its_text(spark, tables, text, monkeypatch):
    got = rows_of(views.run_view(spark, tables, text))
    monkeypatch.setattr(views, "_PLANNED", {})
    assert got and got == rows_of(views.run_view(spark, tables, text))


def beneficiaries(spark, d):
    """Customers that come once, twice alike, twice with another balance or nation, without an id (key 103), and with a balance that no column shows (27,720)."""
    money = [(1, 2, 10.004), (2, 3, 5.0), (2, 3, 5.0), (3, 1, 7.0), (3, 1, 8.0), (4, 1, None), (5, None, 1.0), (5, 6, 1.0), (103, 2, 4.0), (103, 2, 4.0), (103, 3, 4.0)]
    money += [(27720, 1, 1.0), (27720, 1, 2.0), (None, 1, 1.0), (9, 1, 1.0)]
    spark.createDataFrame(money, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{d}/customer.parquet")
    days = ["1996-01-05", "1996-07-05", "1998-02-01", None]
    orders = [(k, day) for k in (1, 2, 3, 4, 5, 103, 27720, None, 77) for day in days]
    spark.createDataFrame(orders, "o_custkey long, d string").selectExpr("o_custkey", "cast(d AS timestamp_ntz) AS o_orderdate").write.parquet(f"{d}/orders.parquet")
    return d


def test_planned_beneficiaries_have_the_rows_of_their_text(spark, tmp_path, monkeypatch):
    d = beneficiaries(spark, str(tmp_path))
    planned = views.raw_beneficiary(spark, d)
    got, names = rows_of(planned), planned.columns
    monkeypatch.setattr(views, "_PLANNED", {})
    text = views.raw_beneficiary(spark, d)
    assert names == text.columns and planned.schema.simpleString() == text.schema.simpleString()
    assert len(got) == 3 * 10 and got == rows_of(text)


def test_beneficiaries_are_distinct_before_they_are_wide(spark, tmp_path):
    """Only rows without an id or of a repeated customer are compared as wide rows."""
    df = views.raw_beneficiary(spark, beneficiaries(spark, str(tmp_path)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    compared = [line for line in plan.splitlines() if "Exchange hashpartitioning(desynpuf_id" in line]
    narrow = [line for line in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert "Union" in plan and len(compared) == 1 and narrow and not any("sp_state_code" in line for line in narrow)


def test_lines_meet_their_order_before_they_are_spread_over_slots(spark):
    plan = views.wide_claims(spark, SF)._jdf.queryExecution().executedPlan().toString()
    by_order = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(l_orderkey", line)]
    assert len(by_order) == 1 and "REPARTITION" in by_order[0]


def claims(spark):
    rows = [
        (f"{p}-{i}", f"b{i % 3}", p, f"2008-0{1 + i % 5}-0{1 + i % 4}", "xy"[i % 2], 10.0 + i % 2, 9.5, "11")
        for p, n in (("P1", 40), ("P2", 3), ("P3", 25), (None, 2))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "clm_id string, desynpuf_id string, at_physn_npi string, d string, primary_hcpcs_cd string, a double, b double, place_of_service_cd string")
    return views._typed(
        df.selectExpr("clm_id", "desynpuf_id", "at_physn_npi", "cast(d AS date) AS clm_from_dt", "primary_hcpcs_cd", "cast(a AS decimal(12,2)) AS allowed_amt", "cast(b AS decimal(12,2)) AS clm_pmt_amt", "place_of_service_cd")
    )


def side_tables(spark):
    bene = spark.createDataFrame([(f"b{i}", 2008, s, None, 1) for i, s in ((0, "A"), (1, "B"), (1, "C"))], "desynpuf_id string, year int, state_code string, death_date date, flag_chf int")
    op = spark.createDataFrame([("P1", "2008-05-01", 12.5), ("P2", "2008-05-02", None), (None, "2008-05-02", 1.0)], "at_physn_npi string, d string, p double")
    return bene, op.selectExpr("at_physn_npi", "cast(d AS date) AS clm_from_dt", "cast(p AS decimal(12,2)) AS clm_pmt_amt")


def test_claims_are_shuffled_by_provider_only(spark):
    plan = fx.provider_year_features(claims(spark), *side_tables(spark))._jdf.queryExecution().executedPlan().toString()
    fine = r"Exchange hashpartitioning\(at_physn_npi#\d+, (period_year#\d+, )?(day|desynpuf_id|primary_hcpcs_cd|place_of_service_cd)"
    assert "hashpartitioning(at_physn_npi" in plan and not re.search(fine, plan)


def test_large_providers_have_the_same_features(spark, monkeypatch):
    whole = rows_of(fx.provider_year_features(claims(spark), *side_tables(spark)))
    assert [r[0] for r in whole] == ["P1", "P2", "P3"]
    for bound in (0, 10, 30):
        monkeypatch.setattr(fx, "LARGE_PROVIDER", bound)
        assert rows_of(fx.provider_year_features(claims(spark), *side_tables(spark))) == whole


def test_large_provider_is_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(fx, "LARGE_PROVIDER", 30)
    assert fx.large_providers(claims(spark)) == (["P1"], 28)
    plan = fx.provider_year_features(claims(spark), *side_tables(spark))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(at_physn_npi#\d+, desynpuf_id#\d+, primary_hcpcs_cd#\d+, ", plan)


def test_partitions_follow_the_claims(spark, monkeypatch):
    whole = rows_of(fx.provider_year_features(claims(spark), *side_tables(spark)))
    monkeypatch.setattr(fx, "CLAIMS_PER_TASK", 10)
    df = fx.provider_year_features(claims(spark), *side_tables(spark))
    assert re.search(r"hashpartitioning\(at_physn_npi#\d+, 7\), REPARTITION_BY_NUM", df._jdf.queryExecution().executedPlan().toString())
    assert rows_of(df) == whole


def counted(monkeypatch):
    ran, real = [], views.run_view
    monkeypatch.setattr(views, "run_view", lambda spark, d, sql: ran.append(sql) or real(spark, d, sql))
    return ran


def test_views_run_once(spark, tmp_path, monkeypatch):
    (tmp_path / "sf").symlink_to(SF)
    ran, d = counted(monkeypatch), str(tmp_path / "sf")
    sc.feature_table(spark, d)
    from ledgerlark.checks import learning_checks as lc

    assert lc.labelled(spark, d).count() > 0
    assert ran.count(views.CLAIMS) == 1


def test_zone_is_written_by_one_job_a_header(spark, tmp_path, monkeypatch):
    written, real = [], raw.write_by_file
    monkeypatch.setattr(raw, "write_by_file", lambda rows, staged, places, write: written.append(len(places)) or real(rows, staged, places, write))
    (tmp_path / "sf").symlink_to(SF)
    cc.raw_zone(spark, str(tmp_path / "sf"))
    assert sorted(written[:4]) == [1, 1, 3, 6]  # then the conversion


def test_files_are_written_without_sorting_rows_by_file(spark, tmp_path):
    rows = spark.sql("SELECT id, 's' AS _sample, concat('f', id % 3) AS _file FROM range(30)")
    places = {("s", f"f{i}"): f"{tmp_path}/out/f{i}" for i in range(4)}
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(name), []

    def write(out, path):
        seen.append(int(spark.conf.get(name)))
        out.parquet(path)

    raw.write_by_file(rows, f"{tmp_path}/staged", places, write)
    assert min(seen[:1]) >= 3 and spark.conf.get(name) == before
    back = {i: sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out/f{i}").collect()) for i in range(4)}
    assert back == {i: [x for x in range(30) if x % 3 == i] for i in range(4)}
    assert spark.read.parquet(f"{tmp_path}/out/f3").columns == ["id"]


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    yield
    spark.conf.set(name, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text", [views.CLAIMS, views.CLAIMS_DENSE])
def test_claims_meet_their_part_before_their_order(spark, tables, text, monkeypatch, no_broadcast):
    planned = views.run_view(spark, tables, text)
    joins = re.findall(r"SortMergeJoin \[(l_\w+)#", plan_of(planned))
    assert joins == ["l_orderkey", "l_partkey"]  # from the top down
    got, kinds = rows_of(planned), planned.schema.simpleString()
    monkeypatch.setattr(views, "_PLANNED", {})
    as_text = views.run_view(spark, tables, text)
    assert got and got == rows_of(as_text) and kinds == as_text.schema.simpleString()


def test_written_claims_are_compressed_well(spark, tables):
    files = views.claim_table(spark, tables).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_beneficiary_years_are_found_in_counted_partitions(spark, tables, monkeypatch, no_broadcast):
    whole = rows_of(views.bene(spark, tables))
    monkeypatch.setattr(views, "LINES_PER_TASK", 3)
    df = views.bene(spark, tables)
    assert re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L, 7\), REPARTITION_BY_NUM", plan_of(df))
    assert whole and rows_of(df) == whole


def test_profile_returns_to_its_provider_before_it_is_counted(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(fx, "CLAIMS_PER_TASK", 10)
    plan = plan_of(fx.provider_year_features(claims(spark), *side_tables(spark)))
    assert len(re.findall(r"Exchange hashpartitioning\(at_physn_npi#\d+, 7\), REPARTITION_BY_NUM.*\n.*Project \[at_physn_npi#\d+, period_year#\d+, state_code#", plan)) == 1
    assert not re.search(r"Exchange hashpartitioning\(at_physn_npi#\d+, period_year#\d+, state_code#", plan)


def test_profile_is_the_same_by_provider(spark):
    rows = [("P1", 2008, "2008-05-01", 2), ("P1", 2008, "2008-07-01", 3), ("P2", 2009, "2009-01-01", 1), (None, 2008, "2008-01-01", 1)]
    joined = spark.createDataFrame(rows, "at_physn_npi string, period_year int, d string, cnt long").selectExpr(
        "*", "cast(d AS date) AS day", "CASE WHEN cnt < 3 THEN 'A' END AS state_code", "cast('2008-04-01' AS date) AS death_date", "cast(cnt + 1 AS int) AS conditions"
    )
    got = rows_of(fx.beneficiary_profile(joined, 3))
    assert got == rows_of(fx.beneficiary_profile(joined)) == [
        ("P1", 2008, "A", 2, 2, 2, 2), ("P1", 2008, None, 3, 3, 3, 3), ("P2", 2009, "A", 1, 1, 0, 0), (None, 2008, "A", 1, 0, 1, 0)
    ]
