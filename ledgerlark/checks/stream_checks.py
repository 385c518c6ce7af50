"""Registered query for the streaming refresh."""

from __future__ import annotations

from ledgerlark.checks import feature_checks as fc
from ledgerlark.checks.support import CLAIMS_STREAM, snap_all
from ledgerlark.session import scratch_path
from ledgerlark.sources import sample_views as views
from ledgerlark.streaming.refresh import refresh_from_files


def stream_refresh(spark, sf_dir):
    """All claims of the event table arrive as four files, two per micro-batch, and every claim once more in four further files."""
    root = scratch_path(spark, "stream")
    claims = views.claims_stream(spark, sf_dir)
    claims.repartition(4, "clm_id").write.parquet(f"{root}/claims")
    claims.repartition(4, "clm_id").write.mode("append").parquet(f"{root}/claims")
    query = refresh_from_files(
        spark,
        f"{root}/claims",
        claims.schema,
        views.bene(spark, sf_dir),
        views.outpatient(spark, sf_dir),
        f"{root}/features",
        f"{root}/checkpoint",
        max_files=2,
    )
    query.awaitTermination()
    return snap_all(spark.read.parquet(f"{root}/features").drop("batch_id", "provider_bucket"))


QUERIES = {"stream_refresh": stream_refresh}

ORACLE = {"stream_refresh": f"WITH {fc.features_cte(CLAIMS_STREAM)} SELECT * FROM features"}
