"""Shared pieces of the registered queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import scratch_path
from ledgerlark.sources import sample_views as views
from ledgerlark.sources.tables import table_exists


def snap(c: Column | str, digits: int = 6) -> Column:
    """Round for comparison.  The offset sits just above one half so that exact decimal ties fall
    the same way in both engines whatever the last bit of the double is."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10**digits)
    return F.floor(c.cast("double") * F.lit(scale) + F.lit(0.5001)) / F.lit(scale)


def sql_snap(expr: str, digits: int = 6) -> str:
    return f"(floor(CAST({expr} AS DOUBLE) * 1e{digits} + 0.5001) / 1e{digits})"


def snap_all(df: DataFrame, digits: int = 6) -> DataFrame:
    """Snap every DOUBLE column and show dates as text."""
    out = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        c = F.col(field.name)
        if kind in ("double", "decimal"):
            c = snap(c, digits)
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif kind == "short":
            c = c.cast("int")
        out.append(c.alias(field.name))
    return df.select(*out)


_ONCE: dict[tuple, str] = {}


def once_per_session(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table that several queries read: written on first use, again if it has been removed."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _ONCE or not table_exists(spark, _ONCE[key]):
        _ONCE[key] = scratch_path(spark, name)
        build().write.parquet(_ONCE[key])
    return spark.read.parquet(_ONCE[key])


RATIO4 = (
    "CASE WHEN allowed_amt > 0 THEN (CAST(clm_pmt_amt * 100 AS BIGINT) * 20000 + CAST(allowed_amt * 100 AS BIGINT))"
    " // (2 * CAST(allowed_amt * 100 AS BIGINT)) END"
)


def claim_ctes(view: str, name: str = "claims") -> str:
    """CTE text: the claims view plus year, cents and the ratio in ten-thousandths."""
    return f"""raw_{name} AS ({view}),
{name} AS (SELECT *, CAST(year(clm_from_dt) AS INT) AS yr, CAST(allowed_amt * 100 AS BIGINT) AS cents,
                  {RATIO4} AS ratio4 FROM raw_{name})"""


CLAIMS = claim_ctes(views.CLAIMS)
CLAIMS_DENSE = claim_ctes(views.CLAIMS_DENSE)
CLAIMS_STREAM = claim_ctes(views.CLAIMS_STREAM)
BENE = f"bene AS ({views.BENE})"
OUTPATIENT = f"outpatient AS ({views.OUTPATIENT})"

CONDITIONS = " + ".join(
    f"(CASE WHEN {f} = 1 THEN 1 ELSE 0 END)" for f in views._FLAG_MODULI
)
