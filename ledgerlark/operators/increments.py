"""Incremental processing by service date.

A position is the last service date already processed.  The next batch holds the earliest claims after
it.  Only per-day counts decide where the batch ends, so nothing larger than one row per calendar day
is ever ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.features import dated_between
from ledgerlark.operators.ranking import smallest_by_hash

SEED_POSITION = "1970-01-01"
BATCH_SIZE = 500_000


def _day(value: str | Column) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def counts_by_day(claims: DataFrame) -> DataFrame:
    """(day, cnt): the table that decides where batches end; it can be kept and added to instead of counted again."""
    return claims.filter(F.col("clm_from_dt").isNotNull()).groupBy(F.col("clm_from_dt").alias("day")).agg(F.count("*").alias("cnt"))


def running_days(days: DataFrame, position: str | Column = SEED_POSITION) -> DataFrame:
    """Claims per day after the position, with the running total before each day.  ``days`` may hold several counts of a day."""
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return (
        days.filter(F.col("day") > _day(position))
        .groupBy("day")
        .agg(F.sum("cnt").alias("cnt"))
        .withColumn("before", F.coalesce(F.sum("cnt").over(before), F.lit(0)))
    )


def window_of_days(
    days: DataFrame, position: str | Column = SEED_POSITION, size: int = BATCH_SIZE, last_batch: int = 0
) -> DataFrame:
    """One row: old position (exclusive), new position (inclusive), claims in the batch, batch id.

    The batch ends with the day in which the size is reached and takes that day whole, so a later
    batch cannot miss the rest of it.  Without new claims there is no row.
    """
    return (
        running_days(days, position)
        .filter(F.col("before") < size)
        .agg(F.max("day").alias("batch_end"), F.sum("cnt").alias("claims"))
        .filter(F.col("batch_end").isNotNull())
        .select(
            _day(position).alias("batch_start"), "batch_end", "claims", F.lit(last_batch + 1).alias("batch_id")
        )
    )


def day_table(claims: DataFrame, position: str | Column = SEED_POSITION) -> DataFrame:
    """``running_days`` straight from claims."""
    return running_days(counts_by_day(dated_between(claims, position)), position)


def batch_window(
    claims: DataFrame, position: str | Column = SEED_POSITION, size: int = BATCH_SIZE, last_batch: int = 0
) -> DataFrame:
    """``window_of_days`` straight from claims."""
    return window_of_days(counts_by_day(dated_between(claims, position)), position, size, last_batch)


def next_batch(claims: DataFrame, position: str | Column = SEED_POSITION, size: int = BATCH_SIZE) -> DataFrame:
    """The claims of the next batch: dates in (position, end of batch]."""
    end = batch_window(claims, position, size).select("batch_end").scalar()
    return dated_between(claims, position, end)


def next_batch_strict(
    claims: DataFrame, position: str, size: int = BATCH_SIZE, key: Sequence[str] = ("clm_id",)
) -> DataFrame:
    """Exactly ``size`` claims by date.

    Days before the cut are taken whole.  Inside the day that is cut, date gives no order; the claims
    with the smallest hash of ``key`` are taken, without sorting the day in one task.
    """
    days = day_table(claims, position).filter(F.col("before") < size)
    inside = F.broadcast(
        days.select(F.col("day").alias("clm_from_dt"), (F.lit(size) - F.col("before")).alias("_room"), "cnt")
    )  # one row per calendar day
    tagged = claims.join(inside, "clm_from_dt")
    whole = tagged.filter("cnt <= _room").select(*claims.columns)
    cut = tagged.filter("cnt > _room").withColumn("_h", F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in key])))
    cut = smallest_by_hash(cut, ["clm_from_dt", "_room"], "_h", lambda n: F.col("_room"), key)
    return whole.unionByName(cut.select(*claims.columns))


def late_rows(arrivals: DataFrame, position: str | Column) -> DataFrame:
    """Arrivals dated at or before the position: a date-based reader never selects them."""
    return dated_between(arrivals, end=position)
