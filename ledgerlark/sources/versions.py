"""Tables that are replaced as a whole.

Each version is written beside the others; an empty marker file in a pointer folder then makes it the current one.  Creating the
marker is one step of any file system, and finding it is one listing.  A reader takes the path of the current version once and
meets either the old table or the new one, also while a reload runs or after one failed.  Old versions stay readable until they are
pruned.  One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlark.sources import tables

KEEP = 2
_MARKER = re.compile(r"version-(\d+)\.upto-(\d+)")


def _pointer(root: str) -> str:
    return f"{root.rstrip('/')}/current"


def location(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version-{version:06d}"


def current(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """(current version, the number it was published with), or None before the first."""
    marks = [m for f in tables.names_in(spark, _pointer(root)) if (m := _MARKER.fullmatch(f))]
    return max(((int(m[1]), int(m[2])) for m in marks), default=None)


def publish(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), upto: int = 0, keep: int = KEEP
) -> int:
    """Write the next version and make it the current one.  ``upto``: a number stored with it, such as the last batch it holds."""
    spark = df.sparkSession
    now = current(spark, root)
    version = 1 if now is None else now[0] + 1
    tables.full_refresh(df, location(root, version), partition_by, cluster_by)
    fs, mark = tables.file_system(spark, f"{_pointer(root)}/version-{version:06d}.upto-{upto}")
    fs.create(mark).close()
    for old in range(max(1, version - keep - 8), version - keep + 1):
        tables.drop_path(spark, location(root, old))
    return version


def read(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The current version, or the one named; an empty frame before the first."""
    if version is None:
        now = current(spark, root)
        if now is None:
            return spark.createDataFrame([], schema)
        version = now[0]
    return spark.read.schema(schema).parquet(location(root, version))
