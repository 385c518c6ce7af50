"""Audits of raw files.  Every audit is a frame of findings with a severity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOLERANCE = 0.10
MAX_NULL_RATE = 0.05


@dataclass(frozen=True)
class FileSpec:
    """One expected file per sample: name pattern, published row count, needed columns, key columns."""

    pattern: str
    rows: int
    required: tuple[str, ...]
    keys: tuple[str, ...]


_CARRIER_REQUIRED = (
    "desynpuf_id",
    "clm_id",
    "clm_from_dt",
    "prf_physn_npi_1",
    "line_alowd_chrg_amt_1",
    "line_nch_pmt_amt_1",
    "hcpcs_cd_1",
)

# Names and codebook row counts of the public synthetic files.
FILE_SPECS = {
    "carrier_a": FileSpec(
        "DE1_0_2008_to_2010_Carrier_Claims_{sample}A", 2_350_000, _CARRIER_REQUIRED, ("desynpuf_id", "clm_id")
    ),
    "carrier_b": FileSpec(
        "DE1_0_2008_to_2010_Carrier_Claims_{sample}B", 2_350_000, _CARRIER_REQUIRED, ("desynpuf_id", "clm_id")
    ),
    "outpatient": FileSpec(
        "DE1_0_2008_to_2010_Outpatient_Claims_{sample}",
        790_000,
        ("desynpuf_id", "clm_id", "clm_from_dt", "clm_pmt_amt"),
        ("desynpuf_id", "clm_id"),
    ),
    "bene_2008": FileSpec(
        "DE1_0_2008_Beneficiary_Summary_File_{sample}",
        116_352,
        (
            "desynpuf_id",
            "bene_birth_dt",
            "bene_sex_ident_cd",
            "bene_hi_cvrage_tot_mons",
            "bene_smi_cvrage_tot_mons",
        ),
        ("desynpuf_id",),
    ),
    "bene_2009": FileSpec(
        "DE1_0_2009_Beneficiary_Summary_File_{sample}", 116_352, ("desynpuf_id", "bene_birth_dt"), ("desynpuf_id",)
    ),
    "bene_2010": FileSpec(
        "DE1_0_2010_Beneficiary_Summary_File_{sample}", 116_352, ("desynpuf_id", "bene_birth_dt"), ("desynpuf_id",)
    ),
}
SAMPLE_LABELS = {"sample_01": "Sample_1", "sample_02": "Sample_2"}


def expected_specs(samples: dict[str, str] | None = None) -> dict[tuple[str, str], FileSpec]:
    """(sample, file_name) -> specification of every file that should be there."""
    return {
        (s, spec.pattern.replace("{sample}", label)): spec
        for s, label in (samples or SAMPLE_LABELS).items()
        for spec in FILE_SPECS.values()
    }


def expected_files(spark: SparkSession, samples: dict[str, str] | None = None) -> DataFrame:
    rows = [(s, name, spec.rows) for (s, name), spec in expected_specs(samples).items()]
    return spark.createDataFrame(rows, "sample string, file_name string, target bigint")


PROFILE = (
    "sample string, file_name string, rows bigint,"
    " columns array<struct<column: string, required: boolean, key: boolean, present: boolean, filled: bigint>>"
)


def file_profile(file: DataFrame, sample: str, file_name: str, spec: FileSpec) -> DataFrame:
    """One row per file: its row count and, for each needed or key column, whether the header has it
    (in any case) and how many rows fill it.  One pass over the file; all audits start from here."""
    have = {c.strip().lower(): c for c in file.columns}
    wanted = list(dict.fromkeys([*spec.required, *spec.keys]))
    stats = file.agg(
        F.count("*").alias("rows"),
        *[F.count(F.col(f"`{have[c]}`") if c in have else F.lit(None)).alias(f"n_{c}") for c in wanted],
    )
    columns = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(c in spec.required).alias("required"),
                F.lit(c in spec.keys).alias("key"),
                F.lit(c in have).alias("present"),
                F.col(f"n_{c}").alias("filled"),
            )
            for c in wanted
        ]
    )
    return stats.select(
        F.lit(sample).alias("sample"), F.lit(file_name).alias("file_name"), "rows", columns.alias("columns")
    )


def group_profiles(rows: DataFrame, columns: Sequence[str], specs: dict[tuple[str, str], FileSpec], files: Sequence[tuple[str, str]]) -> DataFrame:
    """``file_profile`` of many files with the same columns by one aggregate.

    ``rows`` carries ``_sample`` and ``_file``; ``files`` names the (sample, file) among them, so that files without rows count too.
    """
    spark = rows.sparkSession
    have = {c.strip().lower(): c for c in columns}
    mine = {key: specs[key] for key in files if key in specs}
    wanted = sorted({c for spec in mine.values() for c in (*spec.required, *spec.keys)})
    counts = rows.groupBy(F.col("_sample").alias("sample"), F.col("_file").alias("file_name")).agg(
        F.count("*").alias("rows"),
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in wanted]).cast("array<string>"),
            F.array(*[F.count(F.col(f"`{have[c]}`") if c in have else F.lit(None)) for c in wanted]).cast("array<bigint>"),
        ).alias("filled"),
    )
    needed = [
        (s, f, [(c, c in spec.required, c in spec.keys, c in have) for c in dict.fromkeys([*spec.required, *spec.keys])])
        for (s, f), spec in mine.items()
    ]
    listed = spark.createDataFrame(
        needed, "sample string, file_name string, needed array<struct<column: string, required: boolean, key: boolean, present: boolean>>"
    )
    filled = lambda c: F.coalesce(F.try_element_at("filled", c["column"]), F.lit(0))
    return listed.join(counts, ["sample", "file_name"], "left").select(
        "sample",
        "file_name",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.transform(
            "needed",
            lambda c: F.struct(
                c["column"].alias("column"), c["required"].alias("required"), c["key"].alias("key"), c["present"].alias("present"), filled(c).alias("filled")
            ),
        ).alias("columns"),
    )


def stack_profiles(spark: SparkSession, profiles: list[DataFrame]) -> DataFrame:
    out = spark.createDataFrame([], PROFILE)
    for p in profiles:
        out = out.unionByName(p)
    return out


def _severity():
    return (
        F.when(F.col("finding").isin("MISSING", "EMPTY", "MISSING_COLUMN", "HIGH_NULL_RATE"), "error")
        .when(F.col("finding") == "DEVIATION", "warning")
        .otherwise("ok")
    )


def row_count_audit(expected: DataFrame, profile: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """MISSING and EMPTY files are errors; a count off target by more than the tolerance is a warning."""
    n, target = F.col("rows"), F.col("target")
    deviation = F.when(target > 0, F.abs(n - target) / target)
    finding = (
        F.when(n.isNull(), "MISSING").when(n == 0, "EMPTY").when(deviation > tolerance, "DEVIATION").otherwise("OK")
    )
    return (
        expected.join(profile.select("sample", "file_name", "rows"), ["sample", "file_name"], "left")
        .select("sample", "file_name", "rows", "target", deviation.alias("deviation"), finding.alias("finding"))
        .withColumn("severity", _severity())
    )


def required_columns_audit(profile: DataFrame) -> DataFrame:
    """One row per required column: present in the header? and how many rows fill it."""
    return (
        profile.select("sample", "file_name", F.inline("columns"))
        .filter("required")
        .select("sample", "file_name", "column", "present", "filled")
        .withColumn("finding", F.when(F.col("present"), "OK").otherwise("MISSING_COLUMN"))
        .withColumn("severity", _severity())
    )


def key_null_audit(profile: DataFrame, limit: float = MAX_NULL_RATE) -> DataFrame:
    """Share of rows without each key column that the file has, over the whole file."""
    rate = F.when(F.col("rows") > 0, (F.col("rows") - F.col("filled")) / F.col("rows"))
    return (
        profile.select("sample", "file_name", "rows", F.inline("columns"))
        .filter("key AND present")
        .select("sample", "file_name", "column", rate.alias("null_rate"))
        .withColumn("finding", F.when(F.col("null_rate") > limit, "HIGH_NULL_RATE").otherwise("OK"))
        .withColumn("severity", _severity())
    )


def summary(audits: list[DataFrame]) -> DataFrame:
    """Per sample: number of findings by severity, and whether it passes (no error)."""
    findings = audits[0].select("sample", "severity")
    for audit in audits[1:]:
        findings = findings.unionByName(audit.select("sample", "severity"))
    return findings.groupBy("sample").agg(
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.bool_and(F.col("severity") != "error").alias("passed"),
    )
