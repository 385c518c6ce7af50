"""Duplicate claim pairs: same provider, beneficiary and code, 0 to 3 days apart.

The number of pairs stays linear in the number of claims.  Within a day every further claim is paired
with the first claim of its group ("exact"), and the first claims of two neighbouring days at most
three days apart are paired ("near").  So the exact pairs of a group add up to its surplus rows and the
near pairs equal the near-duplicate count of the features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.features import PROVIDER

GROUP = [PROVIDER, "desynpuf_id", "primary_hcpcs_cd"]
_SALTS = 32


def claim_pairs(claims: DataFrame) -> DataFrame:
    """Pairs (clm_id_a earlier or smaller, clm_id_b).  Claim ids must be unique."""
    keyed = claims.filter(F.col(PROVIDER).isNotNull() & F.col("clm_from_dt").isNotNull()).select(
        *GROUP, F.col("clm_from_dt").alias("day"), "clm_id"
    )
    # One row per group and day: the first claim id and the number of claims, combined map-side.
    heads = keyed.groupBy(*GROUP, "day").agg(F.min("clm_id").alias("head"), F.count("*").alias("cnt"))

    order = Window.partitionBy(*GROUP).orderBy("day")
    near = (
        heads.withColumn("date_a", F.lag("day").over(order))
        .withColumn("clm_id_a", F.lag("head").over(order))
        .withColumn("gap", F.date_diff("day", "date_a"))
        .filter("gap BETWEEN 1 AND 3")
        .select(
            "clm_id_a", F.col("head").alias("clm_id_b"), *GROUP, "date_a", F.col("day").alias("date_b"),
            F.col("gap").alias("date_diff_days"), F.lit("near").alias("duplicate_type"),
        )
    )

    # A group of copies may be huge, so its claims meet their head on a salted key.
    salted_heads = heads.filter("cnt > 1").select(
        *GROUP, "day", "head", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt")
    )
    left = keyed.withColumn("_salt", F.pmod(F.xxhash64("clm_id"), F.lit(_SALTS)).cast("int")).alias("l")
    right = salted_heads.alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in GROUP[1:]]
    on = (F.col(f"l.{PROVIDER}") == F.col(f"r.{PROVIDER}")) & (F.col("l.day") == F.col("r.day"))
    on = on & (F.col("l._salt") == F.col("r._salt"))
    for cond in same:
        on = on & cond
    exact = left.join(right, on).filter(F.col("l.clm_id") != F.col("r.head")).select(
        F.col("r.head").alias("clm_id_a"),
        F.col("l.clm_id").alias("clm_id_b"),
        *[F.col(f"l.{c}").alias(c) for c in GROUP],
        F.col("l.day").alias("date_a"),
        F.col("l.day").alias("date_b"),
        F.lit(0).alias("date_diff_days"),
        F.lit("exact").alias("duplicate_type"),
    )
    return exact.unionByName(near).withColumnRenamed("primary_hcpcs_cd", "hcpcs_cd")
