"""Session set-up and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans in this package are written for.  All of them are plain Spark options; nothing
# here is needed for correct results, only for good physical plans.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlark") -> SparkSession:
    """Session for tests and the benchmark.  On a cluster, pass RECOMMENDED_CONF to spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` when the cluster names one.

    Only a local master without that setting falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="ledgerlark-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """New, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_OPEN_JOBS: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables that ``materialise`` writes inside the block are removed at its end, also after a failure.

    For jobs that leave nothing lazy behind.
    """
    mine: list[str] = []
    _OPEN_JOBS.append(mine)
    try:
        yield
    finally:
        _OPEN_JOBS.remove(mine)
        for path in mine:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet below the shared folder and read it back.

    Cuts lineage and fixes the rows: a lost executor re-reads files instead of re-running the plan.
    """
    path = scratch_path(df.sparkSession, label)
    if _OPEN_JOBS:
        _OPEN_JOBS[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative learners checkpoint into the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
