"""Raw claim files: CSV originals, their Parquet copies, and the tagged staging tables.

Layout: ``<root>/<sample>/<file name>.csv``; a "file" may also be a folder of CSV parts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.cleanse import lower_names
from ledgerlark.schema import RAW_BY_TYPE
from ledgerlark.sources.tables import drop_path, file_system, folders, path_exists

SAMPLES = ("sample_01", "sample_02")
#: Files that a task may have open at a time; Spark sorts the rows of a task that meets more.
MAX_WRITERS = 16

_FILE = r"([^/]+)\.(?:csv|parquet)(?:/[^/]+)?$"
_SAMPLE = r"([^/]+)/[^/]+\.(?:csv|parquet)(?:/[^/]+)?$"


def own_path() -> Column:
    """End of the path of the file a row came from, as it is written; the metadata column shows it percent-encoded.

    Sample, file and part are the last three names.  A short text keeps what is done with it in every row cheap.
    """
    return F.url_decode(F.replace(F.substring_index(F.col("_metadata.file_path"), "/", -3), F.lit("+"), F.lit("%2B")))


def file_name(path: Column | None = None) -> Column:
    """Name of the logical file a row came from, without extension."""
    return F.regexp_extract(own_path() if path is None else path, _FILE, 1)


def sample_name(path: Column | None = None) -> Column:
    return F.regexp_extract(own_path() if path is None else path, _SAMPLE, 1)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, named by the header row."""
    return lower_names(spark.read.option("header", True).option("inferSchema", False).csv(path))


def discover(spark: SparkSession, root: str, extension: str = "csv") -> DataFrame:
    """(sample, file_name, folder) of every file below ``root``; lists names, reads no content."""
    paths = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{extension}")
        .load(root)
        .select("path")
    )
    return paths.select(
        sample_name(F.col("path")).alias("sample"),
        file_name(F.col("path")).alias("file_name"),
        F.regexp_extract("path", rf"^(.*?\.{extension})(?:/[^/]+)?$", 1).alias("location"),
    ).distinct()


def first_line(spark: SparkSession, location: str) -> str | None:
    """First line of a CSV file, or of the first part with one in a folder of parts; nothing more is read."""
    fs, path = file_system(spark, location)
    jvm = spark._jvm
    parts = sorted((s.getPath() for s in fs.listStatus(path)), key=lambda p: p.getName()) if fs.getFileStatus(path).isDirectory() else [path]
    for part in parts:
        if part.getName().startswith(("_", ".")):
            continue
        stream = fs.open(part)
        try:
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        if line is not None:
            return line
    return None


@dataclass(frozen=True)
class FileGroup:
    """Raw files with one header: they are read, audited and converted by one job."""

    files: tuple[tuple[str, str, str], ...]  # (sample, file name, location)
    columns: tuple[str, ...]

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows of the group as text, with ``_sample`` and ``_file``."""
        if not self.columns:
            return spark.createDataFrame([], "_sample string, _file string")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in self.columns])
        rows = spark.read.schema(schema).option("header", True).csv([location for _, _, location in self.files])
        return rows.select(*[F.col(f"`{c}`") for c in self.columns], sample_name().alias("_sample"), file_name().alias("_file"))


def group_files(spark: SparkSession, files: Sequence[tuple[str, str, str]]) -> list[FileGroup]:
    """Files by header line.  The driver reads the first line of each file; a data set has few different ones."""
    by_header: dict[str | None, list[tuple[str, str, str]]] = {}
    for f in sorted(files):
        by_header.setdefault(first_line(spark, f[2]), []).append(f)
    out = []
    for header, members in by_header.items():
        columns = () if header is None else tuple(read_csv(spark, members[0][2]).columns)
        out.append(FileGroup(tuple(members), columns))
    return out


@contextmanager
def files_side_by_side(spark: SparkSession):
    """Tasks write rows of a few files as they come: with a writer per file there is no need to sort them by file first."""
    name, before = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set(name, str(max(MAX_WRITERS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_by_file(rows: DataFrame, staged: str, places: dict[tuple[str, str], str], write: Callable[[DataFrameWriter, str], None]) -> None:
    """Rows with ``_sample`` and ``_file`` written by one job to a folder beside, whose parts are then moved to the places of
    their (sample, file).  A place without rows gets an empty file with the columns."""
    spark = rows.sparkSession
    try:
        with files_side_by_side(spark):
            write(rows.write.partitionBy("_sample", "_file"), staged)
        escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        parts = {f"{staged}/_sample={escape(s)}/_file={escape(f)}": place for (s, f), place in places.items()}
        made = {f"{staged}/{a}/{b}" for a in folders(spark, staged) for b in folders(spark, f"{staged}/{a}")}
        if made - set(parts):
            raise OSError(f"rows of unknown files: {sorted(made - set(parts))}")
        for part, place in parts.items():
            if part not in made:  # a file without rows
                write(rows.drop("_sample", "_file").limit(0).coalesce(1).write, part)
            _publish(spark, part, place)
    finally:
        drop_path(spark, staged)


def _publish(spark: SparkSession, staged: str, target: str) -> None:
    """Move a complete folder to its place; what stood there goes first."""
    fs, source = file_system(spark, staged)
    _, place = file_system(spark, target)
    fs.mkdirs(place.getParent())
    fs.delete(place, True)
    if not fs.rename(source, place):
        raise OSError(f"cannot move {staged} to {target}")


def convert_all(
    spark: SparkSession, raw_root: str, parquet_root: str, sample: str | None = None, force: bool = False
) -> list[dict]:
    """Copy every CSV file to Parquet, keeping the folder layout.

    A target that exists is left alone unless ``force``.  Files with one header are written by one job, however many they are,
    to a folder beside the targets, and each is moved to its place when the job is done: after a failure every target is
    either as it was or complete.  A file without rows gives an empty target with its columns, one without a header none.
    """
    root = parquet_root.rstrip("/")
    found = discover(spark, raw_root)
    if sample is not None:
        found = found.filter(F.col("sample") == sample)
    if not force and path_exists(spark, root):
        done = discover(spark, root, "parquet").select("sample", "file_name", F.lit(True).alias("done"))
        found = found.join(done, ["sample", "file_name"], "left")
    else:
        found = found.withColumn("done", F.lit(None).cast("boolean"))
    rows = found.orderBy("sample", "file_name").collect()  # names only
    target = lambda s, f: f"{root}/{s}/{f}.parquet"
    status = {}
    for group in group_files(spark, [(r["sample"], r["file_name"], r["location"]) for r in rows if not r["done"]]):
        if group.columns:
            _convert(spark, group, root, target)
        status |= {f[:2]: "converted" if group.columns else "no header" for f in group.files}
    return [
        {"status": status.get((r["sample"], r["file_name"]), "skipped"), "path": target(r["sample"], r["file_name"])} for r in rows
    ]


def _convert(spark: SparkSession, group: FileGroup, root: str, target) -> None:
    staged = f"{root}/_converting-{uuid.uuid4().hex[:12]}"
    places = {(s, f): target(s, f) for s, f, _ in group.files}
    write_by_file(group.read(spark), staged, places, lambda out, path: out.option("compression", "snappy").parquet(path))


def staging(spark: SparkSession, parquet_root: str, file_type: str, samples: Sequence[str] = SAMPLES) -> DataFrame:
    """All Parquet copies of one file type over all samples, with the staging tags.

    ``sample_id`` is the 1-based position of the sample; beneficiary rows also get the four-digit
    year of their file name.
    """
    index = F.create_map(*[x for i, s in enumerate(samples, start=1) for x in (F.lit(s), F.lit(i))])
    found = discover(spark, parquet_root, "parquet").filter(
        F.lower("file_name").contains(file_type) & F.col("sample").isin(*samples)
    )
    paths = [r["location"] for r in found.collect()]
    if not paths:
        raise FileNotFoundError(f"no {file_type} files below {parquet_root}")
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    names = [f.name for f in RAW_BY_TYPE[file_type].fields if f.name in df.columns]
    rows = df.select(
        *names,
        file_name().alias("file_name"),
        F.try_element_at(index, sample_name()).cast("smallint").alias("sample_id"),
    )
    if file_type == "beneficiary":
        year = F.regexp_extract("file_name", r"(?:^|_)(\d{4})(?:_|$)", 1)
        rows = rows.withColumn("year", F.nullif(year, F.lit("")).cast("smallint"))
    return rows


def load_log(staged: DataFrame, table_name: str) -> DataFrame:
    """Rows loaded per (table, sample, file)."""
    return staged.groupBy("sample_id", "file_name").agg(F.count("*").alias("rows_loaded")).select(
        F.lit(table_name).alias("table_name"), "sample_id", "file_name", "rows_loaded"
    )
