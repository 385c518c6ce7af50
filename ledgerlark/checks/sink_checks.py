"""Registered queries for the table sinks, the conversion's skip rule and the earliest claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.checks import cleaning_checks as cc
from ledgerlark.checks.score_checks import SCORED, _score_table
from ledgerlark.checks.support import CLAIMS
from ledgerlark.operators.increments import next_batch_strict
from ledgerlark.session import scratch_path
from ledgerlark.sources import raw, tables
from ledgerlark.sources import sample_views as views

EARLIEST = 5000


def sink_year_partitions(spark, sf_dir):
    """Claims written twice as a full refresh, partitioned by year and clustered by provider, and read back."""
    path = scratch_path(spark, "sink-claims")
    claims = views.claims(spark, sf_dir).withColumn("claim_year", F.year("clm_from_dt"))
    for rows in (claims.filter("claim_year < 1995"), claims):
        tables.full_refresh(rows, path, ["claim_year"], ["at_physn_npi"])
    back = spark.read.parquet(path)
    return back.groupBy(F.col("claim_year").cast("int").alias("claim_year")).agg(
        F.count("*").alias("claims"), F.sum((F.col("allowed_amt") * 100).cast("bigint")).alias("cents")
    )


def sink_append_runs(spark, sf_dir):
    """Score rows of two runs appended by run, and read back."""
    path = scratch_path(spark, "sink-scores")
    scored = _score_table(spark, sf_dir)
    for run in (1, 2):
        tables.append(scored.filter(F.col("risk_decile") >= run).withColumn("scoring_run_id", F.lit(run)), path, ["scoring_run_id"])
    back = spark.read.parquet(path)
    return back.groupBy(F.col("scoring_run_id").cast("int").alias("scoring_run_id")).agg(
        F.count("*").alias("rows"), F.sum("risk_score").alias("risk")
    )


def src_convert_skip(spark, sf_dir):
    """Files converted, then skipped, then converted again by force."""
    root, target = cc.raw_zone(spark, sf_dir), scratch_path(spark, "converted")
    report = []
    for step, force in ((1, False), (2, False), (3, True)):
        found = raw.convert_all(spark, f"{root}/csv", target, force=force)
        report += [(step, r["status"]) for r in found]
    return spark.createDataFrame(report, "step int, status string").groupBy("step", "status").agg(F.count("*").alias("files"))


def inj_earliest_claims(spark, sf_dir):
    """The earliest claims that a bounded injection works on, by day."""
    kept = next_batch_strict(views.claims(spark, sf_dir), "0001-01-01", EARLIEST)
    return kept.groupBy(F.col("clm_from_dt").cast("string").alias("day")).agg(F.count("*").alias("claims"))


QUERIES = {f.__name__: f for f in (sink_year_partitions, sink_append_runs, src_convert_skip, inj_earliest_claims)}

ORACLE = {
    "sink_year_partitions": f"WITH {CLAIMS} SELECT CAST(yr AS INT) AS claim_year, count(*) AS claims, CAST(sum(cents) AS BIGINT) AS cents FROM claims GROUP BY yr",
    "sink_append_runs": f"WITH {SCORED} SELECT CAST(run AS INT) AS scoring_run_id, count(*) AS rows, CAST(sum(risk_score) AS BIGINT) AS risk"
    " FROM scored, range(1, 3) AS r(run) WHERE risk_decile >= run GROUP BY run",
    "src_convert_skip": f"WITH {cc._FILES}, f AS (SELECT count(DISTINCT (s, file_name)) AS n FROM file_rows)"
    " SELECT CAST(step AS INT) AS step, CASE step WHEN 2 THEN 'skipped' ELSE 'converted' END AS status, n AS files FROM f, range(1, 4) AS t(step)",
    "inj_earliest_claims": f"""WITH {CLAIMS}, days AS (SELECT clm_from_dt AS d, count(*) AS n FROM claims GROUP BY 1),
upto AS (SELECT *, sum(n) OVER (ORDER BY d) - n AS before FROM days)
SELECT CAST(d AS VARCHAR) AS day, CAST(least(n, {EARLIEST} - before) AS BIGINT) AS claims FROM upto WHERE before < {EARLIEST}""",
}
