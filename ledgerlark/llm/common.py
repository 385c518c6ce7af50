"""Helpers shared by the text operators: row identity, shared-folder tables, white space."""

from __future__ import annotations

import ctypes
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import scratch_path

#: The six ASCII white-space characters, as a trim list and as a regular expression class.
WS_CHARS = " \t\n\x0b\x0c\r"
WS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_key(docs: DataFrame, *cols: str) -> DataFrame:
    """Add ``_rk1, _rk2``: a 128-bit key of the named columns.

    Rows that agree in these columns share a key, so what is computed per key holds for each repeat.
    """
    flags = [F.col(c).isNull() for c in cols]  # hashing skips nulls; the flags keep (null, x) and (x, null) apart
    parts = [*flags, *[F.col(c) for c in cols]]
    return docs.withColumns({"_rk1": F.xxhash64(*parts), "_rk2": F.xxhash64(F.lit(7), *parts)})


def join_on_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    return left.join(right, ["_rk1", "_rk2"], how)


def word_array(text: Column) -> Column:
    """Maximal runs without ASCII white space; null and blank texts give an empty array."""
    core = F.trim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, WS + "+", -1))


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables of one job in the shared folder.  They cut lineage, so a lost executor re-reads files.

    ``drop`` removes a table that nothing reads any more; tables behind a returned frame stay.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def write(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
        writer.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if (path := self.paths.pop(name, None)) is not None:
                drop_path(self.spark, path)


#: Whole texts go to Python in smaller batches than Spark's default, which counts rows and not bytes.
TEXT_BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def give_back() -> None:
    """Return freed memory to the system.  Python workers live on for later stages, and the C library keeps what arrays have left."""
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # glibc has it
        trim(0)


def freeing(run):
    """A function over record batches that gives back memory at the end of each task."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def slices(batches, rows: int = 500):
    """Record batches cut into views of few rows, so that what a task builds from whole texts stays small."""
    for rb in batches:
        for at in range(0, rb.num_rows, rows):
            yield rb.slice(at, rows)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Hold one session setting while a job of this package runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def text_groups(texts: list, limit: int = 500_000):
    """Neighbouring texts in lists of at most ``limit`` characters or bytes in all; a longer text is a list of its own."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > limit:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group
