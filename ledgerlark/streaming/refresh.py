"""Feature refresh as a file stream.

New claim files in the claims folder trigger a refresh of exactly the providers they name.  The stream
tracks files, not dates, so claims dated before earlier ones are picked up too.

A micro-batch reads its own files and, of the stored cells (``claim_state``), the buckets of the providers it names; never the
claims folder.  A claim id that an earlier batch brought is not counted again.  A batch that is run again after a failure
overwrites what it wrote and gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlark.operators.features import PROVIDER
from ledgerlark.session import temporary_tables
from ledgerlark.sources.claim_state import BUCKETS, PROVIDER_BUCKET, ClaimState
from ledgerlark.sources.tables import replace_rows

KEYS = [PROVIDER, "period_year"]


def refresh_from_files(
    spark: SparkSession,
    claims_path: str,
    schema: T.StructType,
    bene: DataFrame,
    outpatient: DataFrame,
    feature_path: str,
    checkpoint: str,
    max_files: int | None = None,
    state_path: str | None = None,
    buckets: int = BUCKETS,
):
    """Start the stream over all files not yet seen; it ends when they are processed.

    The stored cells live in ``state_path`` and belong to the checkpoint.
    """
    state = ClaimState(spark, state_path or f"{checkpoint.rstrip('/')}-state", buckets)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        number = batch_id + 1
        with temporary_tables(spark):
            fresh = state.fresh(batch, number)
            if fresh.isEmpty():
                return
            state.absorb(fresh, number)
            rows = state.features(state.active(fresh), bene, outpatient, number)
            replace_rows(rows, feature_path, KEYS, ["period_year", PROVIDER_BUCKET])
            state.compact()

    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(claims_path)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
