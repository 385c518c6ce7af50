"""Parquet tables of the warehouse: reading, appending, full refresh and keyed replace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.merge import insert_if_absent, replace_by_key
from ledgerlark.session import materialise


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names right below a path; none where it does not exist."""
    fs, target = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``column=value`` folders right below a path."""
    return [n for n in names_in(spark, path) if "=" in n]


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of its layout when it does not exist yet."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Replace the whole table.

    ``cluster_by`` brings equal values together and sorts them inside the files.  It is a rebalance:
    adaptive execution cuts an oversized group into several files and merges small ones.
    """
    if cluster_by:
        df = df.hint("rebalance", *partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_absent(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = ()) -> None:
    """Insert rows whose key the table lacks."""
    target = read_or_empty(df.sparkSession, path, df.schema)
    append(materialise(insert_if_absent(target, df, keys, order), "insert"), path)


def values_of(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """Distinct values of columns that have few by their making, such as buckets and years."""
    return sorted(tuple(r) for r in df.select(*columns).distinct().collect())


def one_of(columns: Sequence[str], values: Sequence[tuple]) -> Column:
    """True for rows with one of the given combinations, as a filter that prunes partitions: one list per column, then the pairs."""
    out = F.lit(bool(values))
    for i, c in enumerate(columns):
        out = out & F.col(c).isin(sorted({v[i] for v in values}))
    if len(columns) > 1:
        pairs = F.lit(False)
        for first in sorted({v[0] for v in values}):
            rest = one_of(columns[1:], [v[1:] for v in values if v[0] == first])
            pairs = pairs | ((F.col(columns[0]) == first) & rest)
        out = out & pairs
    return out


def replace_rows(df: DataFrame, path: str, keys: Sequence[str], partition_by: str | Sequence[str]) -> None:
    """Replace the rows with the keys of ``df``, reading and rewriting only the partitions it touches.

    The merged rows are written to the shared folder first, so the table is never read and
    overwritten in one job, and a failed overwrite can be repeated from there.
    """
    spark = df.sparkSession
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    staged = materialise(df, "replace-new")
    merged = staged
    if table_exists(spark, path):
        touched = read_or_empty(spark, path, df.schema).filter(one_of(columns, values_of(staged, columns)))
        merged = materialise(replace_by_key(touched, staged, keys), "replace-merged")
    (
        merged.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
