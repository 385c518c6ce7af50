"""Corpus pipeline: quality rules, line dedup, near-duplicate join, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of
``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import decontaminate, line_dedup, near_dups, packing, quality_rules
from ledgerlark.llm.common import Scratch, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules keep.  Rows travel as one column, so no column name can clash."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), *[c for c in ("text", "lang", "source") if c in docs.columns])
    return quality_rules.apply_rules(rows, ["_row"]).where("kept").select("_row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand in ten documents or more; n_chars follows the text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = line_dedup.dedup_lines(docs.select("doc_id", "text", *([F.struct(*rest).alias("_row")] if rest else [])), min_docs=10, min_chars=1)
    out = out.select("doc_id", "text", *(["_row.*"] if rest else []))
    if "n_chars" in rest:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dups.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", benchmark_free),
    ("packing", packed),
]

#: Tokens come from a vocabulary file, which SQL cannot read; tests/llm holds a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage reads what its predecessor wrote to the shared folder."""
    docs, scratch = read_table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.write(docs, name)
    return docs
