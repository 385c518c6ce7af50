"""Distributed ranking helpers against brute force."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlark.functions.scoring import risk_score, with_deciles
from ledgerlark.operators.increments import batch_window, day_table, next_batch, next_batch_strict
from ledgerlark.operators.merge import insert_if_absent, replace_by_key
from ledgerlark.operators.ranking import auc_by_group, first_per_key, mark_smallest, smallest_by_hash

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_first_per_key_is_the_minimum_row(spark):
    rows = [("k", 3, "c"), ("k", 1, "b"), ("k", 1, "a"), ("j", None, "z"), ("j", 5, "y")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert sorted(map(tuple, first_per_key(df, ["k"], ["o"]).collect())) == [("j", None, "z"), ("k", 1, "a")]


@pytest.mark.parametrize("share", [0.0, 0.01, 0.2, 1.0])
def test_smallest_by_hash(spark, share):
    rows = [("big" if i % 3 else f"g{i % 5}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i int").withColumn("h", F.md5(F.col("i").cast("string")))
    got = smallest_by_hash(df, ["g"], "h", lambda n: F.floor(n * share), ["i"]).collect()
    import hashlib

    want = set()
    for g in {r[0] for r in rows}:
        own = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for k, i in rows if k == g)
        want |= {(g, i) for _, i in own[: int(len(own) * share)]}
    assert {(r.g, r.i) for r in got} == want and len(got) == len(want)
    marked = mark_smallest(df, ["g"], "h", lambda n: F.floor(n * share), ["i"])
    assert (marked.count(), marked.filter("is_chosen").count()) == (3000, len(want))


def test_smallest_by_hash_with_one_hash_for_all(spark):
    df = spark.range(1000).withColumn("h", F.lit("abcd" * 8))
    assert sorted(r.id for r in smallest_by_hash(df, [], "h", lambda n: F.lit(10), ["id"]).collect()) == list(range(10))


def _auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@FEW
@given(st.lists(st.tuples(st.sampled_from([0.0, 0.1, 0.25, 0.2501, 0.5, 0.9999, 1.0]), st.booleans()), min_size=1, max_size=40))
def test_auc(spark, pairs):
    df = spark.createDataFrame([(s, int(y)) for s, y in pairs], "prob double, label int")
    row = auc_by_group(df, [], "prob", "label").first()
    want = _auc(pairs)
    assert row["auc_roc"] == (None if want is None else pytest.approx(want, abs=1e-12))


def test_auc_matches_the_built_in_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(1)
    rows = [(rng.random() * 0.7 + 0.3 * y, float(y)) for y in (rng.random() < 0.2 for _ in range(2000))]
    df = spark.createDataFrame(rows, "prob double, label double")
    built_in = BinaryClassificationEvaluator(rawPredictionCol="prob", numBins=0).evaluate(df)
    assert auc_by_group(df, [], "prob", "label").first()["auc_roc"] == pytest.approx(built_in, abs=1e-9)


@FEW
@given(st.lists(st.integers(0, 100), min_size=1, max_size=60))
def test_deciles_equal_quantile_cut(spark, values):
    import pandas as pd

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s int")
    got = [r["d"] for r in with_deciles(df, "s", "d").orderBy("i").collect()]
    if len(set(values)) == 1:
        assert got == [None] * len(values)
        return
    want = pd.qcut(values, q=10, labels=False, duplicates="drop") + 1
    assert got == list(want)


def test_risk_score_truncates_and_clips(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.013,), (1.0,), (-3.0,), (3.0,)], "r double")
    assert [r[0] for r in df.select(risk_score(F.col("r"))).collect()] == [100, 50, 49, 0, 100, 0]


def _days(spark, counts):
    rows = [(f"{d}-{i:03d}", f"2008-01-{d:02d}") for d, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "clm_id string, d string").select("clm_id", F.col("d").cast("date").alias("clm_from_dt"))


def test_batch_takes_whole_days_and_batches_cover_everything(spark):
    df = _days(spark, {1: 3, 2: 4, 5: 1, 6: 9})
    position, seen, batch = "1970-01-01", 0, 0
    while (w := batch_window(df, position, 5, batch).first()) is not None:
        rows = next_batch(df, position, 5)
        assert rows.count() == w["claims"] and w["batch_id"] == batch + 1
        position, seen, batch = str(w["batch_end"]), seen + w["claims"], batch + 1
    assert (seen, batch, position) == (17, 2, "2008-01-06")
    assert day_table(df, position).count() == 0


def test_strict_batch_cuts_inside_a_day(spark):
    df = _days(spark, {1: 3, 2: 4, 5: 1})
    got = sorted(r.clm_id for r in next_batch_strict(df, "1970-01-01", 5).collect())
    assert got[:3] == ["1-000", "1-001", "1-002"] and len(got) == 5 and all(c.startswith("2-") for c in got[3:])
    assert got == sorted(r.clm_id for r in next_batch_strict(df.repartition(7), "1970-01-01", 5).collect())


def test_merge_operators(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (2, "a"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, insert_if_absent(target, new, ["k"], ["v"]).collect())) == [(3, "c")]
    assert sorted(map(tuple, replace_by_key(target, new, ["k"]).collect())) == [(1, "old"), (2, "a"), (2, "b"), (3, "c")]


def test_null_groups_are_kept(spark):
    rows = [(None, f"{i:08x}") for i in range(10)] + [(1, f"{i:08x}") for i in range(5)]
    df = spark.createDataFrame(rows, "g int, h string")
    marked = mark_smallest(df, ["g"], "h", lambda n: F.floor(n / 5)).collect()
    assert len(marked) == 15 and sum(r.is_chosen for r in marked if r.g is None) == 2 and sum(r.is_chosen for r in marked if r.g == 1) == 1


def test_auc_of_null_group_and_crowded_scores(spark):
    rows = [(None, 0.5 + i * 1e-7, int(i % 3 == 0)) for i in range(900)] + [("a", 0.2, 1), ("a", 0.1, 0)]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    got = {r.g: r.auc_roc for r in auc_by_group(df, ["g"], "s", "y").collect()}
    own = [(s, y) for g, s, y in rows if g is None]
    pos, neg = [s for s, y in own if y], [s for s, y in own if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got[None] - want) < 1e-12 and got["a"] == 1.0


def test_null_keys_are_inserted_once(spark):
    target = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    incoming = spark.createDataFrame([(None, 5), (2, 6), (3, 7)], "k int, v int")
    assert [tuple(r) for r in insert_if_absent(target, incoming, ["k"], ["v"]).collect()] == [(3, 7)]
