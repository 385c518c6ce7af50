"""Model inputs: missing values to zero, and standardisation by population mean and deviation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ledgerlark.schema import MODEL_FEATURES


def model_matrix(features: DataFrame, batch_id: int | None = None, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Model inputs as doubles without NULLs, for all rows or one batch."""
    rows = features if batch_id is None else features.filter(F.col("batch_id") == batch_id)
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def scaler_table(matrix: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """(feature, mean, scale), one aggregate pass; a constant feature has scale 1."""
    stats = matrix.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("scale"))
            for c in columns
        ]
    )
    return stats.select(F.inline(rows)).withColumn(
        "scale", F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0))
    )


def scaler_rows(scaler: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> dict[str, Row]:
    """The scaler's row of each model column; a missing one is an error."""
    rows = {r["feature"]: r for r in scaler.filter(F.col("feature").isin(*columns)).collect()}
    if missing := [c for c in columns if c not in rows]:
        raise ValueError(f"scaler lacks {', '.join(missing)}")
    return rows


def standardise(matrix: DataFrame, scaler: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Columns as (x - mean) / scale.  The scaler is one row per model column, read as constants."""
    rows = scaler_rows(scaler, columns)
    return matrix.withColumns({c: (F.col(c) - float(rows[c]["mean"])) / float(rows[c]["scale"]) for c in columns})
