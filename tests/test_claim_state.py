"""Stored cells, keys and day counts: what they read, what they rewrite, and what a failure leaves behind."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import features as fx
from ledgerlark.operators import increments as inc
from ledgerlark.plans import backfill, weekly
from ledgerlark.schema import BENEFICIARY_SUMMARY, CARRIER_CLAIMS, OUTPATIENT_CLAIMS, conform
from ledgerlark.sources import claim_state, tables, versions
from ledgerlark.sources.batches import BatchTable
from ledgerlark.sources.claim_state import PROVIDER_BUCKET, ClaimState
from ledgerlark.sources.warehouse import Warehouse

NOW = datetime(2026, 1, 5)
COLUMNS = "clm_id string, at_physn_npi string, desynpuf_id string, primary_hcpcs_cd string, clm_from_dt date, allowed_amt double, place_of_service_cd string"


def claims(spark, rows):
    """Claims from (id, provider, day of 2009)."""
    made = [(i, p, f"B{(d or 0) % 3}", f"C{(d or 0) % 4}", None if d is None else date(2009, 1 + d // 28, 1 + d % 28), 10.0 + (d or 0), "11") for i, p, d in rows]
    df = spark.createDataFrame(made, COLUMNS).withColumns({"clm_pmt_amt": F.col("allowed_amt") / 2, "submitted_charge_amt": F.col("allowed_amt")})
    df = df.withColumn("submitted_to_allowed_ratio", F.lit(0.5)).withColumn("claim_year", F.year("clm_from_dt"))
    return conform(df, CARRIER_CLAIMS)


@pytest.fixture
def bene(spark):
    return spark.createDataFrame([], BENEFICIARY_SUMMARY)


@pytest.fixture
def outpatient(spark):
    return spark.createDataFrame([], OUTPATIENT_CLAIMS)


def rows_of(df):
    names = sorted(c for c in df.columns if c not in ("batch_id", PROVIDER_BUCKET))
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.select(*names).collect())


def filters_of(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]


FIRST = [(f"c{i}", f"P{i % 23}", i % 90) for i in range(200)]


def test_features_fold_from_the_buckets_of_active_providers(spark, tmp_path, bene, outpatient):
    state = ClaimState(spark, str(tmp_path), buckets=8)
    one, two = claims(spark, FIRST), claims(spark, [("n1", "P3", 5), ("n2", "P3", 91), ("n3", "P99", 7)])
    state.absorb(one, 1)
    path = str(tmp_path / "features")
    write = lambda rows: tables.replace_rows(rows, path, weekly.FEATURE_KEYS, ["period_year", PROVIDER_BUCKET])
    write(state.features(state.active(one), bene, outpatient, 1))
    files = {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    state.absorb(two, 2)
    active = state.active(two)
    touched = {b for (b,) in tables.values_of(active, [PROVIDER_BUCKET])}
    assert 0 < len(touched) <= 2
    cells, amounts = state.history(active)
    for part in (cells, amounts):
        found = filters_of(part)
        assert found.count("") == 1 and all(PROVIDER_BUCKET in f for f in found if f) and len(found) > 1  # "": the list of providers
        assert not any("carrier_claims" in f for f in part.inputFiles())
    write(state.features(active, bene, outpatient, 2))
    kept = {f for f in files if int(f.parent.name.split("=")[1]) not in touched}
    assert kept and all(f.exists() and f.stat().st_mtime_ns == files[f] for f in kept)
    assert not any(f.exists() for f in set(files) - kept)
    full = fx.provider_year_features(one.unionByName(two), bene, outpatient)
    assert rows_of(spark.read.parquet(path)) == rows_of(full)


def test_keyed_insert_reads_the_buckets_of_its_keys(spark, tmp_path):
    state = ClaimState(spark, str(tmp_path), buckets=8)
    state.absorb(claims(spark, [*FIRST, (None, "P1", 3)]), 1)
    incoming = claims(spark, [("c5", "P5", 5), ("c5", "P5", 5), (None, "P1", 3), ("new", "P1", 1), ("new", "P1", 2)])
    fresh = state.fresh(incoming, 2)
    assert [(r.clm_id, r.clm_from_dt.day) for r in fresh.collect()] == [("new", 2)]  # the smallest row of a new id; NULL equals NULL
    found = filters_of(state.known([3, 4], 2))
    assert found and all("key_bucket" in f and "IN (3,4)" in f for f in found)
    assert state.fresh(claims(spark, []), 2).isEmpty()
    state.absorb(fresh, 2)
    assert state.fresh(incoming, 3).isEmpty()
    assert [r.clm_id for r in state.fresh(incoming, 2).collect()] == ["new"]  # the same batch again


def test_a_batch_run_again_counts_once_and_compaction_changes_nothing(spark, tmp_path, bene, outpatient):
    state = ClaimState(spark, str(tmp_path), buckets=4)
    parts = [claims(spark, FIRST[i::3]) for i in range(3)]
    for number, part in enumerate(parts, 1):
        state.absorb(part, number)
        state.absorb(part, number)
    everyone = state.active(claims(spark, FIRST))
    whole = rows_of(fx.provider_year_features(claims(spark, FIRST), bene, outpatient))
    assert rows_of(state.features(everyone, bene, outpatient, 9)) == whole
    days = sorted(map(tuple, state.days.read().groupBy("day").agg(F.sum("cnt")).collect()))
    state.compact()
    assert state.cells.deltas() == [1, 2, 3]
    state.compact(after=1)
    assert state.cells.deltas() == [] and state.cells.upto() == 3 and state.keys.read().count() == 200
    assert rows_of(state.features(everyone, bene, outpatient, 9)) == whole
    assert sorted(map(tuple, state.days.read().collect())) == days
    state.absorb(claims(spark, [("late", "P1", 2)]), 4)
    assert state.keys.read().count() == 201 and state.keys.read(before=4).count() == 200


def test_next_batch_is_cut_from_day_counts(spark, tmp_path):
    state = ClaimState(spark, str(tmp_path), buckets=4)
    first, late = claims(spark, FIRST), claims(spark, [("l1", "P1", 3), ("l2", "P2", 89), ("x", "P1", None)])
    state.absorb(first, 1)
    state.absorb(late, 2)
    everything = first.unionByName(late)
    for position, size in (("1970-01-01", 30), ("2009-01-20", 50), ("2009-01-20", 10**6), ("2009-12-01", 5)):
        stored = inc.window_of_days(state.days.read(), position, size, 4)
        assert stored.collect() == inc.batch_window(everything, position, size, 4).collect()
        assert stored.inputFiles() and all("claim_days" in f for f in stored.inputFiles())


@pytest.fixture
def wh(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.carrier_table().replace_all(claims(spark, FIRST).withColumn(PROVIDER_BUCKET, claim_state.bucket("at_physn_npi", claim_state.BUCKETS)), 0)
    return wh


def test_added_claims_reach_table_cells_and_batches(spark, wh):
    assert backfill.add_claims(wh, claims(spark, FIRST[:5]), NOW) == 0 and wh.last_ingest() == 0
    assert backfill.add_claims(wh, claims(spark, [FIRST[0], ("a", "P0", 1), ("b", "P77", 100)]), NOW) == 2
    assert wh.carrier().count() == 202 and wh.last_ingest() == 1
    weekly.refresh_features(wh, 1)
    assert rows_of(wh.features()) == rows_of(fx.provider_year_features(wh.carrier(), wh.beneficiaries(), wh.outpatient()))
    backfill.add_claims(wh, claims(spark, [("c", "P77", 99)]), NOW)
    weekly.refresh_features(wh, 2, "2009-04-01", "2009-04-30")
    assert rows_of(wh.features()) == rows_of(fx.provider_year_features(wh.carrier(), wh.beneficiaries(), wh.outpatient()))


def test_a_failed_insert_is_not_seen_and_can_be_repeated(spark, wh, monkeypatch):
    wh.claim_state()
    new = claims(spark, [("a", "P0", 1), ("b", "P1", 2)])

    def broken(self, df, batch_id, put=BatchTable.put):
        put(self, df, batch_id)
        if self.root.endswith("claim_cells"):
            raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(BatchTable, "put", broken)
        with pytest.raises(OSError):
            backfill.add_claims(wh, new, NOW)
    assert wh.carrier().count() == 200 and wh.last_ingest() == 0
    assert wh.claim_state().days.read(upto=wh.last_ingest()).agg(F.sum("cnt")).first()[0] == 200
    assert backfill.add_claims(wh, new, NOW) == 2
    assert wh.carrier().count() == 202 and wh.claim_state().days.read().agg(F.sum("cnt")).first()[0] == 202


def test_readers_meet_the_old_version_or_the_new_one(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "old"), (2, "old")], schema)
    assert versions.current(spark, root) is None and versions.read(spark, root, old.schema).count() == 0
    versions.publish(old, root)
    reader = versions.read(spark, root, old.schema)

    @F.udf("string")
    def fails(v):
        raise ValueError("half way")

    with pytest.raises(Exception, match="half way"):
        versions.publish(old.withColumn("v", fails("v")), root)
    assert {r.v for r in versions.read(spark, root, old.schema).collect()} == {"old"}
    versions.publish(spark.createDataFrame([(3, "new")], schema), root, upto=7)
    assert [r.v for r in versions.read(spark, root, old.schema).collect()] == ["new"] and versions.current(spark, root) == (2, 7)
    assert {r.v for r in reader.collect()} == {"old"}  # a reader that began before
    assert versions.read(spark, root, old.schema, 1).count() == 2  # a snapshot by number
    versions.publish(old, root)
    assert not tables.path_exists(spark, versions.location(root, 1)) and tables.path_exists(spark, versions.location(root, 2))


def test_rows_are_replaced_in_their_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(k, y, b, "old") for y in (1, 2) for b in (0, 1) for k in ("a", "b")]
    tables.replace_rows(spark.createDataFrame(rows, "k string, y int, b int, v string"), path, ["k", "y"], ["y", "b"])
    before = {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    new = spark.createDataFrame([("a", 1, 0, "new"), ("c", 2, 1, "new")], "k string, y int, b int, v string")
    tables.replace_rows(new, path, ["k", "y"], ["y", "b"])
    got = {(r.k, r.y, r.b): r.v for r in spark.read.parquet(path).collect()}
    assert got == {(k, y, b): "old" for k, y, b, _ in rows if (k, y, b) != ("a", 1, 0)} | {("a", 1, 0): "new", ("c", 2, 1): "new"}
    for f, t in before.items():
        if ("y=1" in str(f)) == ("b=1" in str(f)):  # (1, 1) and (2, 0) are untouched
            assert f.exists() and f.stat().st_mtime_ns == t
    picked = spark.read.parquet(path).filter(tables.one_of(["y", "b"], [(1, 0), (2, 1)]))
    assert {(r.y, r.b) for r in picked.collect()} == {(1, 0), (2, 1)}
