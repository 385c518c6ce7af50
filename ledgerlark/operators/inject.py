"""Labelled anomaly scenarios: copies of the feature table with disturbed features of some providers.

Every random choice is a rank or value derived from an md5 of the seed and a key, so results do not
depend on partitioning and survive task retries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.features import PROVIDER, keep_providers
from ledgerlark.operators.increments import next_batch_strict
from ledgerlark.operators.ranking import smallest_by_hash
from ledgerlark.session import materialise

# Share of providers per scenario, share of their claims copied, and code pairs.
UPCODING_RATE = 0.04
PHANTOM_RATE = 0.03
DUPLICATE_RATE = 0.03
PHANTOM_SHARE = 0.30
DUPLICATE_SHARE = 0.15
UPCODING_MAP = {
    "99213": "99215",
    "99203": "99205",
    "99212": "99214",
    "93000": "93010",
    "71046": "71048",
}

_SPREAD = ("clm_id", "desynpuf_id", "clm_from_dt")


def keyed_hash(seed: int, purpose: str, *cols: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(f"{seed}:{purpose}"), *[F.col(c).cast("string") for c in cols]))


def unit_value(digest: Column) -> Column:
    """First 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def at_least_one(n: Column, share: float) -> Column:
    return F.greatest(F.lit(1), F.floor(n * F.lit(share)))


def target_providers(features: DataFrame, scenario: str, rate: float, seed: int = 42) -> DataFrame:
    """max(1, int(n * rate)) of the distinct providers, written once because several joins read them."""
    providers = features.select(PROVIDER).distinct().withColumn("_h", keyed_hash(seed, scenario, PROVIDER))
    chosen = smallest_by_hash(providers, [], "_h", lambda n: at_least_one(n, rate), [PROVIDER])
    return materialise(chosen.select(PROVIDER), "targets")


def _labelled(features: DataFrame, targets: DataFrame, scenario: str) -> DataFrame:
    marked = features.join(targets.withColumn("_hit", F.lit(1)), PROVIDER, "left")
    return marked.withColumn("label", F.coalesce("_hit", F.lit(0))).withColumn("scenario", F.lit(scenario)).drop("_hit")


def _updated(features: DataFrame, changes: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Features with ``columns`` computed where the provider has a change row, else unchanged."""
    joined = features.join(changes, PROVIDER, "left")
    extra = [c for c in changes.columns if c != PROVIDER]
    hit = F.col(extra[0]).isNotNull()
    new = {c: F.when(hit, v).otherwise(F.col(c)).cast(features.schema[c].dataType) for c, v in columns.items()}
    return joined.withColumns(new).drop(*extra)


def upcoded_claims(claims: DataFrame, codes: dict[str, str], seed: int = 42) -> DataFrame:
    """Claims with mapped codes replaced and their charge raised by a factor in [1.2, 1.4)."""
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    higher = F.try_element_at(lookup, F.col("primary_hcpcs_cd"))
    factor = F.lit(1.2) + F.lit(0.2) * unit_value(keyed_hash(seed, "charge", "clm_id"))
    charge = F.col("submitted_charge_amt").cast("double")
    return claims.withColumns(
        {
            "submitted_charge_amt": F.when(higher.isNotNull(), charge * factor).otherwise(charge),
            "primary_hcpcs_cd": F.coalesce(higher, F.col("primary_hcpcs_cd")),
        }
    )


def upcoding(
    claims: DataFrame, features: DataFrame, seed: int = 42, rate: float = UPCODING_RATE, codes: dict[str, str] | None = None
) -> DataFrame:
    """Mean charge and mean ratio of the targets recomputed from upcoded claims, over all their years.

    The ratio itself does not change with the charge, so the ratio feature only loses its split by
    year; that is how the scenario is defined.
    """
    targets = target_providers(features, "upcoding", rate, seed)
    changed = upcoded_claims(keep_providers(claims, targets, _SPREAD), codes or UPCODING_MAP, seed)
    stats = changed.groupBy(PROVIDER).agg(
        F.avg("submitted_charge_amt").alias("_charge"),
        F.avg(F.col("submitted_to_allowed_ratio").cast("double")).alias("_ratio"),
    )
    out = _updated(
        features,
        stats,
        {"avg_submitted_charge": F.col("_charge"), "avg_submitted_to_allowed_ratio": F.col("_ratio")},
    )
    return _labelled(out, targets, "upcoding")


def phantom_claims(claims: DataFrame, targets: DataFrame, seed: int = 42, share: float = PHANTOM_SHARE) -> DataFrame:
    """Copies of a share of each target's claims, moved by one to five days."""
    h = keyed_hash(seed, "phantom", "clm_id", "desynpuf_id", "clm_from_dt", "primary_hcpcs_cd")
    own = keep_providers(claims, targets, _SPREAD).withColumn("_h", h)
    picked = smallest_by_hash(own, [PROVIDER], "_h", lambda n: at_least_one(n, share), ["allowed_amt"])
    shift = F.lit(1) + F.pmod(F.conv(F.substring("_h", 25, 8), 16, 10).cast("bigint"), F.lit(5)).cast("int")
    return picked.withColumn("clm_from_dt", F.date_add("clm_from_dt", shift)).drop("_h")


def _with_extra(features: DataFrame, extra: DataFrame, count_col: str) -> DataFrame:
    """Adds ``k`` rows per provider to a duplicate count and to the rate's denominator."""
    more = F.col(count_col) + F.col("_k")
    total = F.greatest(F.col("total_carrier_claims") + F.col("_k"), F.lit(1))
    return _updated(features, extra, {count_col: more, "duplicate_rate": more / total})


def phantom_billing(claims: DataFrame, features: DataFrame, seed: int = 42, rate: float = PHANTOM_RATE) -> DataFrame:
    targets = target_providers(features, "phantom_billing", rate, seed)
    extra = phantom_claims(claims, targets, seed).groupBy(PROVIDER).agg(F.count("*").alias("_k"))
    return _labelled(_with_extra(features, extra, "near_duplicate_count"), targets, "phantom_billing")


def duplicate_submission(claims: DataFrame, features: DataFrame, seed: int = 42, rate: float = DUPLICATE_RATE) -> DataFrame:
    targets = target_providers(features, "duplicate_submission", rate, seed)
    extra = (
        keep_providers(claims, targets, _SPREAD)
        .groupBy(PROVIDER)
        .agg(at_least_one(F.count("*"), DUPLICATE_SHARE).alias("_k"))
    )
    return _labelled(_with_extra(features, extra, "exact_duplicate_count"), targets, "duplicate_submission")


def all_scenarios(
    claims: DataFrame, features: DataFrame, seed: int = 42, codes: dict[str, str] | None = None, max_claims: int | None = None
) -> DataFrame:
    """The three scenarios stacked.  ``max_claims`` keeps only the earliest claims; off by default."""
    if max_claims is not None:
        claims = next_batch_strict(claims, "0001-01-01", max_claims)
    return (
        upcoding(claims, features, seed, codes=codes)
        .unionByName(phantom_billing(claims, features, seed))
        .unionByName(duplicate_submission(claims, features, seed))
    )


def label_rate(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count("*").alias("rows"), F.sum("label").alias("anomalies"), F.avg("label").alias("label_rate")
    )
