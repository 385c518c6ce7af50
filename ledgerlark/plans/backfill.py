"""Historical backfill: raw files to typed tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import cleanse, quality
from ledgerlark.operators.features import PROVIDER
from ledgerlark.schema import CARRIER_CLAIMS, conform
from ledgerlark.session import materialise, temporary_tables
from ledgerlark.sources import raw, versions
from ledgerlark.sources.claim_state import PROVIDER_BUCKET, ClaimState, bucket
from ledgerlark.sources.tables import append, drop_path
from ledgerlark.sources.warehouse import INGESTS, Warehouse


def validate(spark: SparkSession, raw_root: str, samples: Sequence[str] = raw.SAMPLES) -> tuple[bool, DataFrame]:
    """Audits of all expected files: (no errors?, findings with sample, file, finding, severity).

    One aggregate per header, however many files have it.
    """
    specs = quality.expected_specs({s: quality.SAMPLE_LABELS[s] for s in samples})
    found = [(r["sample"], r["file_name"], r["location"]) for r in raw.discover(spark, raw_root).collect()]
    groups = raw.group_files(spark, [f for f in found if f[:2] in specs])
    profiles = [quality.group_profiles(g.read(spark), g.columns, specs, [f[:2] for f in g.files]) for g in groups]
    return findings_of(spark, profiles, samples)


def audit_converted(spark: SparkSession, parquet_root: str, samples: Sequence[str] = raw.SAMPLES) -> tuple[bool, DataFrame]:
    """The same audits on the Parquet copies: row counts and key columns only, so the raw files are not read again."""
    specs = quality.expected_specs({s: quality.SAMPLE_LABELS[s] for s in samples})
    found = [(r["sample"], r["file_name"], r["location"]) for r in raw.discover(spark, parquet_root, "parquet").collect()]
    by_columns: dict[tuple[str, ...], list[tuple[str, str, str]]] = {}
    for f in sorted(found):
        if f[:2] in specs:
            by_columns.setdefault(tuple(spark.read.parquet(f[2]).columns), []).append(f)
    profiles = []
    for columns, files in by_columns.items():
        rows = spark.read.parquet(*[location for _, _, location in files])
        tagged = rows.select(*[F.col(f"`{c}`") for c in columns], raw.sample_name().alias("_sample"), raw.file_name().alias("_file"))
        profiles.append(quality.group_profiles(tagged, columns, specs, [f[:2] for f in files]))
    return findings_of(spark, profiles, samples)


def findings_of(spark: SparkSession, profiles: list[DataFrame], samples: Sequence[str]) -> tuple[bool, DataFrame]:
    profile = materialise(quality.stack_profiles(spark, profiles), "file-profiles")
    audits = [
        quality.row_count_audit(quality.expected_files(spark, {s: quality.SAMPLE_LABELS[s] for s in samples}), profile),
        quality.required_columns_audit(profile),
        quality.key_null_audit(profile),
    ]
    out = None
    for audit in audits:
        column = F.col("column") if "column" in audit.columns else F.lit(None).cast("string").alias("column")
        part = audit.select("sample", "file_name", column, "finding", "severity")
        out = part if out is None else out.unionByName(part)
    return out.filter("severity = 'error'").isEmpty(), out


def load_staging(wh: Warehouse, parquet_root: str, kind: str, samples: Sequence[str] = raw.SAMPLES) -> DataFrame:
    """Full reload of one staging table, with its load log.  Optional: ``transform_all`` reads the
    Parquet copies directly."""
    rows = raw.staging(wh.spark, parquet_root, kind, samples)
    root = wh.path(f"staging_{kind}")
    version = versions.publish(rows, root)
    stored = versions.read(wh.spark, root, rows.schema, version)
    append(raw.load_log(stored, f"staging_{kind}"), wh.path("load_log"))
    return stored


def transform_all(wh: Warehouse, parquet_root: str, samples: Sequence[str] = raw.SAMPLES) -> None:
    """Full refresh of the three typed tables and of what is kept about the claims.

    Claim tables are partitioned by year and provider bucket and clustered by provider.  Each table is written beside the one in
    use, which readers keep until the new one is complete.
    """
    staged = {k: raw.staging(wh.spark, parquet_root, k, samples) for k in ("beneficiary", "carrier", "outpatient")}
    versions.publish(cleanse.clean_beneficiaries(staged["beneficiary"]), wh.path("beneficiary_summary"))
    upto = wh.last_ingest()
    for table, rows in (
        (wh.carrier_table(), cleanse.clean_carrier(staged["carrier"])),
        (wh.outpatient_table(), cleanse.clean_outpatient(staged["outpatient"])),
    ):
        table.replace_all(rows.withColumn(PROVIDER_BUCKET, bucket(PROVIDER, wh.buckets)), upto)
    ClaimState(wh.spark, wh.path("claim_state"), wh.buckets, upto).rebuild(wh.carrier(), upto)
    for kind, rows in staged.items():
        append(raw.load_log(rows, kind), wh.path("load_log"))


def add_claims(wh: Warehouse, incoming: DataFrame, now: datetime | None = None) -> int:
    """Insert carrier claims whose id is new, with everything that is kept about them; returns their number.

    Only the key buckets of the incoming ids are compared.  A failed attempt leaves nothing that readers see: the batch counts
    once its number is written at the end, and the next attempt overwrites it.
    """
    with temporary_tables(wh.spark):
        state, batch_id = wh.claim_state(), wh.last_ingest() + 1
        fresh = state.fresh(conform(incoming, CARRIER_CLAIMS), batch_id)
        rows = fresh.count()
        if rows:
            stored = fresh.withColumn(PROVIDER_BUCKET, bucket(PROVIDER, wh.buckets))
            state.absorb(fresh, batch_id, True, lambda: wh.carrier_table().put(stored, batch_id))
            wh.add_state("ingests", INGESTS, (batch_id, rows, now or datetime.now()))
            wh.carrier_table().compact(upto=batch_id)
            wh.claim_state().compact()
    return rows


def backfill(
    wh: Warehouse, raw_root: str, parquet_root: str, samples: Sequence[str] = raw.SAMPLES, force: bool = False
) -> DataFrame:
    """Convert, audit, clean.  Raises when the audits find an error; returns the findings.

    The audits read the Parquet copies, so each raw file is read once.  Copies made by a run that fails its audit are removed
    again, so that corrected files are converted next time.
    """
    report = raw.convert_all(wh.spark, raw_root, parquet_root, force=force)
    ok, findings = audit_converted(wh.spark, parquet_root, samples)
    if not ok:
        errors = findings.filter("severity = 'error'").collect()  # at most one per file and column
        for r in report:
            if r["status"] == "converted":
                drop_path(wh.spark, r["path"])
        raise ValueError("raw files failed validation: " + "; ".join(f"{r.file_name} {r.column or ''} {r.finding}" for r in errors))
    transform_all(wh, parquet_root, samples)
    return findings
