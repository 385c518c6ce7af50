"""Provider-by-year features.

Plan shape, chosen so that no task ever holds a whole provider of more than ``LARGE_PROVIDER`` claims:

* ``claim_cells`` collapses claims to one row per (provider, beneficiary, code, day).  Every later step starts
  from that one shuffle (Spark reuses the exchange) or from ``amount_cells``, each with few columns.
* Claims of all but very large providers are laid out by provider before that, so the levels below need no shuffle of their
  own and no map-side hash table of nearly distinct rows.  For a very large provider each further level groups on
  fine keys, combined map-side; what is shuffled on (provider, year) alone is at most one row per task and provider-year.
* Additive results of all branches are stacked and folded by a single aggregate instead of a chain of
  joins.  The two branches with non-hashable aggregates join at the end, already co-partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.cleaning import chronic_count, is_weekend
from ledgerlark.schema import CHRONIC_FLAGS, PROVIDER_FEATURES
from ledgerlark.session import materialise

PROVIDER = "at_physn_npi"
YEAR = "period_year"
KEYS = [PROVIDER, YEAR]

FULL_START = "1970-01-01"
FULL_END = "9999-12-31"

# Ids in a broadcast provider list: about 50 MB as a hash table.
BROADCAST_PROVIDERS = 500_000
_SALTS = 32
# Claims of a provider up to which one task may fold it.
LARGE_PROVIDER = 1_000_000
# Claims that a task folds on average.  The partitions are counted, so that adaptive execution does not join them again
# by their compressed size: their hash tables and sorts are several times larger, and would spill.
CLAIMS_PER_TASK = 200_000


def _count_if(cond: Column, weight: str = "cnt") -> Column:
    return F.sum(F.when(cond, F.col(weight)).otherwise(F.lit(0)))


# --- choice of providers -------------------------------------------------------------------------


def active_providers(claims: DataFrame, start: str = FULL_START, end: str = FULL_END) -> DataFrame:
    """Providers with a claim dated in the half-open window (start, end]."""
    return dated_between(claims, start, end).filter(F.col(PROVIDER).isNotNull()).select(PROVIDER).distinct()


def dated_between(claims: DataFrame, start: str | Column | None = None, end: str | Column | None = None) -> DataFrame:
    """Claims dated after ``start`` and up to ``end``.

    Tables are partitioned by year, so the years of the bounds are named too: partitions outside are
    not read.
    """

    def day(bound: str | Column) -> Column:
        return F.lit(bound).cast("date") if isinstance(bound, str) else bound

    by_year = "claim_year" in claims.columns
    if start is not None:
        claims = claims.filter(F.col("clm_from_dt") > day(start))
        claims = claims.filter(F.col("claim_year") >= F.year(day(start))) if by_year else claims
    if end is not None:
        claims = claims.filter(F.col("clm_from_dt") <= day(end))
        claims = claims.filter(F.col("claim_year") <= F.year(day(end))) if by_year else claims
    return claims


def keep_providers(claims: DataFrame, providers: DataFrame, spread: tuple[str, ...], list_size: int | None = None) -> DataFrame:
    """Full history of the listed providers (semi-join).  ``providers`` has one row per provider.

    A list of at most ``BROADCAST_PROVIDERS`` ids, counted first, is broadcast and claims do not move.
    A longer list is joined on a key salted from ``spread``, so that one very large provider is
    handled by many tasks; the list is repeated once per salt.
    """
    if (providers.count() if list_size is None else list_size) <= BROADCAST_PROVIDERS:
        return claims.join(F.broadcast(providers.select(PROVIDER)), PROVIDER, "left_semi").select(*claims.columns)
    salt = F.pmod(F.xxhash64(*spread), F.lit(_SALTS)).cast("int")
    salted = providers.select(PROVIDER, F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"))
    return claims.withColumn("_salt", salt).join(salted, [PROVIDER, "_salt"], "left_semi").select(*claims.columns)


def _dated(claims: DataFrame) -> DataFrame:
    return claims.filter(F.col(PROVIDER).isNotNull() & F.year("clm_from_dt").isNotNull())


def large_providers(claims: DataFrame) -> tuple[list[str], int]:
    """Providers with more than ``LARGE_PROVIDER`` claims, at most the number of claims over it, and the claims of all others."""
    counts = claims.filter(F.col(PROVIDER).isNotNull()).groupBy(PROVIDER).count()
    is_large = F.col("count") > LARGE_PROVIDER
    row = counts.agg(F.collect_list(F.when(is_large, F.col(PROVIDER))).alias("names"), F.sum(F.when(~is_large, F.col("count"))).alias("n")).first()
    return sorted(row["names"]), row["n"] or 0


# --- shared pre-aggregates -----------------------------------------------------------------------


def claim_cells(claims: DataFrame) -> DataFrame:
    """One row per (provider, beneficiary, code, day) with its claim count.

    The filter names the year because the joins further down imply the same filter: with equal
    predicates all branches keep an equal subplan and share one scan and one exchange.
    """
    return (
        _dated(claims)
        .groupBy(PROVIDER, "desynpuf_id", "primary_hcpcs_cd", F.col("clm_from_dt").alias("day"))
        .agg(F.count("*").alias("cnt"))
        .withColumn(YEAR, F.year("day"))
    )


def amount_cells(claims: DataFrame) -> DataFrame:
    """Claims per (provider, year, place of service, ratio), with money summed in whole cents."""
    return (
        _dated(claims)
        .groupBy(
            PROVIDER,
            F.year("clm_from_dt").alias(YEAR),
            "place_of_service_cd",
            F.col("submitted_to_allowed_ratio").alias("ratio"),
        )
        .agg(
            F.count("*").alias("cnt"),
            F.sum((F.col("submitted_charge_amt") * 100).cast("bigint")).alias("charge_cents"),
            F.count("submitted_charge_amt").alias("charge_n"),
            F.sum((F.col("allowed_amt") * 100).cast("bigint")).alias("allowed_cents"),
            F.count("allowed_amt").alias("allowed_n"),
        )
    )


def add_cells(cells: DataFrame) -> DataFrame:
    """Claim cells of several batches as one row per cell."""
    return cells.groupBy(PROVIDER, "desynpuf_id", "primary_hcpcs_cd", "day").agg(F.sum("cnt").alias("cnt")).withColumn(YEAR, F.year("day"))


def add_amounts(amount: DataFrame) -> DataFrame:
    """Amount cells of several batches as one row per cell."""
    sums = [F.sum(c).alias(c) for c in ("cnt", "charge_cents", "charge_n", "allowed_cents", "allowed_n")]
    return amount.groupBy(PROVIDER, YEAR, "place_of_service_cd", "ratio").agg(*sums)


# --- single branches -----------------------------------------------------------------------------


def day_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*KEYS, "day").agg(F.sum("cnt").alias("cnt"))


def beneficiary_counts(cells: DataFrame) -> DataFrame:
    """Claims per beneficiary; claims without a beneficiary form one group."""
    return cells.groupBy(*KEYS, "desynpuf_id").agg(F.sum("cnt").alias("cnt"))


def code_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*KEYS, "primary_hcpcs_cd").agg(F.sum("cnt").alias("cnt"))


def code_mix(cells: DataFrame) -> DataFrame:
    """Distinct codes, most used code (ties: lowest code, missing code last), its share, and the
    Herfindahl index sum(share^2) = sum(n^2) / total^2."""
    n = F.col("cnt").cast("double")
    code = F.col("primary_hcpcs_cd")
    rank = F.struct((-F.col("cnt")).alias("neg"), code.isNull().alias("missing"), code.alias("code"))
    return (
        code_counts(cells)
        .groupBy(*KEYS)
        .agg(
            F.count(code).alias("distinct_hcpcs_codes"),
            F.sum("cnt").cast("double").alias("_total"),
            F.sum(n * n).alias("_squares"),
            F.min(rank).alias("_top"),
        )
        .select(
            *KEYS,
            "distinct_hcpcs_codes",
            F.col("_top.code").alias("top_hcpcs_code"),
            (-F.col("_top.neg") / F.col("_total")).alias("top_hcpcs_code_share"),
            (F.col("_squares") / (F.col("_total") * F.col("_total"))).alias("hcpcs_concentration_score"),
        )
    )


def amounts(amount: DataFrame) -> DataFrame:
    """Means, 95th percentile of the ratio and place-of-service shares.

    The percentile is exact: it runs over the histogram of ratio values, which four stored decimals
    keep small however many claims a provider has.  The set of places holds distinct codes of a
    two-digit code list only.
    """
    ratio = F.col("ratio")
    total = F.sum("cnt")
    place = F.col("place_of_service_cd")
    return amount.groupBy(*KEYS).agg(
        F.size(F.collect_set(place)).cast("bigint").alias("distinct_pos_codes"),
        (F.sum(ratio.cast("decimal(28,4)") * F.col("cnt")).cast("double") / _count_if(ratio.isNotNull())).alias(
            "avg_submitted_to_allowed_ratio"
        ),
        F.percentile(ratio.cast("double"), 0.95, F.col("cnt")).alias("p95_submitted_to_allowed_ratio"),
        (F.sum("charge_cents") / F.when(F.sum("charge_n") > 0, F.sum("charge_n")) / 100).alias("avg_submitted_charge"),
        (F.sum("allowed_cents") / F.when(F.sum("allowed_n") > 0, F.sum("allowed_n")) / 100).alias("avg_allowed_amt"),
        (_count_if(place == "11") / total).alias("pct_claims_office"),
        (_count_if(place == "12") / total).alias("pct_claims_home"),
        (_count_if(place == "31") / total).alias("pct_claims_nursing_facility"),
    )


def duplicate_days(cells: DataFrame) -> DataFrame:
    """Per cell: is it an exact-duplicate group, and does it follow its predecessor by 1 to 3 days?

    A row that follows another on the same day has gap 0 and never counts, so one flag per day equals
    the row-wise definition.  The window holds at most one row per calendar day, across years.
    """
    group = [PROVIDER, "desynpuf_id", "primary_hcpcs_cd"]
    order = Window.partitionBy(*group).orderBy("day")
    gap = F.date_diff("day", F.lag("day").over(order))
    return cells.select(
        *KEYS,
        F.when(F.col("cnt") > 1, 1).otherwise(0).alias("exact"),
        F.when(gap.between(1, 3), 1).otherwise(0).alias("near"),
    )


def with_beneficiary(cells: DataFrame, bene: DataFrame, death_any_year: bool = False) -> DataFrame:
    """Cells joined to the beneficiary row of the claim's own year (left join).

    What follows regroups on (provider, year, state), so the join output needs no particular layout
    and adaptive execution is free to split a skewed beneficiary.  ``death_any_year`` takes the death
    date from any of the beneficiary's years instead of the claim's own.
    """
    flags = [f for f in CHRONIC_FLAGS.values() if f in bene.columns]
    side = bene.select(
        F.col("desynpuf_id"),
        F.col("year").cast("int").alias(YEAR),
        "state_code",
        "death_date",
        (chronic_count(flags) if flags else F.lit(0)).alias("conditions"),
    )
    joined = cells.join(side, ["desynpuf_id", YEAR], "left")
    if death_any_year:
        deaths = bene.groupBy("desynpuf_id").agg(F.min("death_date").alias("_died"))
        joined = joined.join(deaths, "desynpuf_id", "left").withColumn("death_date", F.col("_died")).drop("_died")
    return joined


def beneficiary_profile(joined: DataFrame, parts: int | None = None) -> DataFrame:
    """Per (provider, year, state): claims, claims after death, in the death year, and of
    beneficiaries with three or more conditions.

    With ``parts``, rows go back to their provider before they are counted, so that no task of the join, whose size
    adaptive execution chooses by compressed bytes, holds a hash table of nearly distinct rows beside its sorts.
    """
    died = F.col("death_date").isNotNull()

    def claims_if(cond: Column) -> Column:
        return F.when(cond, F.col("cnt")).otherwise(F.lit(0))

    counted = {
        "cnt": F.col("cnt"),
        "after_death": claims_if(died & (F.col("day") > F.col("death_date"))),
        "death_year": claims_if(died & (F.col(YEAR) == F.year("death_date"))),
        "burdened": claims_if(F.col("conditions") >= 3),
    }
    rows = joined.select(*KEYS, "state_code", *[c.alias(n) for n, c in counted.items()])
    rows = rows if parts is None else rows.repartition(parts, PROVIDER)
    return rows.groupBy(*KEYS, "state_code").agg(*[F.sum(n).alias(n) for n in counted])


# --- everything together -------------------------------------------------------------------------

_STACK = {
    "day_cnt": "bigint",
    "weekend_cnt": "bigint",
    "bene_cnt": "bigint",
    "bene_row": "int",
    "bene_id_row": "int",
    "exact": "int",
    "near": "int",
    "state_row": "int",
    "after_death": "bigint",
    "death_year": "bigint",
    "burdened": "bigint",
    "op_row": "bigint",
    "op_pay_row": "bigint",
    "op_cents": "bigint",
}


def _stack_row(df: DataFrame, **values: Column) -> DataFrame:
    return df.select(
        *KEYS, *[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in _STACK.items()]
    )


def provider_year_features(
    claims: DataFrame,
    bene: DataFrame,
    outpatient: DataFrame,
    batch_id: int = 0,
    start: str | None = None,
    end: str | None = None,
    death_any_year: bool = False,
) -> DataFrame:
    """All features, one row per (provider, year).

    With a window, only providers active in (start, end] are computed, from their full history.

    Claims are shuffled by provider, and once more to meet their beneficiaries: all that is grouped by a provider and more is then folded where it lies.  Providers with more
    than ``LARGE_PROVIDER`` claims go by the finer keys of each branch instead.  ``claims`` is read four times.
    """
    if start is not None or end is not None:
        # Written once: three joins below read the list, and its length decides how they are done.
        active = materialise(active_providers(claims, start or FULL_START, end or FULL_END), "active-providers")
        claims = keep_providers(claims, active, ("desynpuf_id", "primary_hcpcs_cd", "clm_from_dt"))
        outpatient = keep_providers(outpatient, active, ("desynpuf_id", "clm_from_dt", "clm_pmt_amt"))

    def folded(own: DataFrame, op: DataFrame, parts: int | None = None) -> DataFrame:
        own = own if parts is None else own.repartition(parts, PROVIDER)
        return features_of_cells(claim_cells(own), amount_cells(own), bene, op, batch_id, death_any_year, parts)

    names, n = large_providers(claims)
    parts = max(1, -(-n // CLAIMS_PER_TASK))
    if not names:
        return folded(claims, outpatient, parts)
    large = F.coalesce(F.col(PROVIDER).isin(names), F.lit(False))
    rest = folded(claims.filter(~large), outpatient.filter(~large), parts)
    return rest.unionByName(folded(claims.filter(large), outpatient.filter(large)))


def features_of_cells(
    cells: DataFrame,
    amount: DataFrame,
    bene: DataFrame,
    outpatient: DataFrame,
    batch_id: int = 0,
    death_any_year: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """All features from ``claim_cells`` and ``amount_cells``, which may come from stored tables.

    ``parts`` names the partitions by provider if both are laid out so.
    """
    days = day_counts(cells)
    benes = beneficiary_counts(cells)
    dups = duplicate_days(cells)
    profile = beneficiary_profile(with_beneficiary(cells, bene, death_any_year), parts)

    one = F.lit(1)
    stacked = (
        _stack_row(
            days,
            day_cnt=F.col("cnt"),
            weekend_cnt=F.when(is_weekend(F.col("day")), F.col("cnt")).otherwise(0),
        )
        .unionByName(
            _stack_row(
                benes,
                bene_cnt=F.col("cnt"),
                bene_row=one,
                bene_id_row=F.when(F.col("desynpuf_id").isNotNull(), 1),
            )
        )
        .unionByName(_stack_row(dups.filter("exact + near > 0"), exact=F.col("exact"), near=F.col("near")))
        .unionByName(
            _stack_row(
                profile,
                state_row=F.when(F.col("state_code").isNotNull(), 1),
                after_death=F.col("after_death"),
                death_year=F.col("death_year"),
                burdened=F.col("burdened"),
            )
        )
        .unionByName(
            _stack_row(
                _dated(outpatient).withColumn(YEAR, F.year("clm_from_dt")),
                op_row=one,
                op_pay_row=F.when(F.col("clm_pmt_amt").isNotNull(), 1),
                op_cents=(F.col("clm_pmt_amt") * 100).cast("bigint"),
            )
        )
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    folded = (
        stacked.groupBy(*KEYS)
        .agg(
            F.max("day_cnt").alias("max_claims_in_single_day"),
            *[total(n).alias(n) for n in _STACK],
        )
        .filter("bene_cnt > 0")
    )

    claims_n = F.col("bene_cnt")
    per_bene = F.when(F.col("bene_row") > 0, claims_n / F.col("bene_row")).otherwise(0.0)
    joined = folded.join(amounts(amount), KEYS, "left").join(code_mix(cells), KEYS, "left")
    # At most one row per year and provider.  The row before counts only if it is the year before.
    years = Window.partitionBy(PROVIDER).orderBy(YEAR)
    prior = F.when(F.lag(YEAR).over(years) == F.col(YEAR) - 1, F.lag("bene_cnt").over(years)).otherwise(0)
    joined = joined.withColumn("prior_cnt", prior)
    out = joined.select(
        *KEYS,
        F.lit(batch_id).alias("batch_id"),
        claims_n.alias("total_carrier_claims"),
        F.col("bene_id_row").alias("distinct_beneficiaries"),
        "distinct_hcpcs_codes",
        "distinct_pos_codes",
        F.col("state_row").alias("beneficiaries_per_state"),
        "avg_submitted_to_allowed_ratio",
        "p95_submitted_to_allowed_ratio",
        "avg_submitted_charge",
        "avg_allowed_amt",
        (F.col("weekend_cnt") / claims_n).alias("pct_weekend_claims"),
        "max_claims_in_single_day",
        F.col("after_death").alias("claims_after_bene_death"),
        F.col("death_year").alias("claims_in_bene_death_year"),
        (F.col("burdened") / claims_n).alias("high_chronic_burden_benes_pct"),
        "pct_claims_office",
        "pct_claims_home",
        "pct_claims_nursing_facility",
        per_bene.alias("avg_claims_per_beneficiary"),
        per_bene.alias("carrier_claims_per_bene"),
        "top_hcpcs_code",
        F.coalesce("top_hcpcs_code_share", F.lit(0.0)).alias("top_hcpcs_code_share"),
        F.coalesce("hcpcs_concentration_score", F.lit(0.0)).alias("hcpcs_concentration_score"),
        F.col("exact").alias("exact_duplicate_count"),
        F.col("near").alias("near_duplicate_count"),
        ((F.col("exact") + F.col("near")) / claims_n).alias("duplicate_rate"),
        F.col("prior_cnt").alias("prior_period_claim_count"),
        growth_pct(claims_n, F.col("prior_cnt")).alias("claim_volume_growth_pct"),
        F.col("op_row").alias("total_outpatient_claims"),
        F.coalesce(F.col("op_cents") / F.when(F.col("op_pay_row") > 0, F.col("op_pay_row")) / 100, F.lit(0.0)).alias(
            "avg_outpatient_payment"
        ),
    )
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PROVIDER_FEATURES.fields])


def growth_pct(current: Column, prior: Column) -> Column:
    """Percent change against the prior year; NULL without one."""
    return F.when(prior > 0, (current - prior) / prior * 100)
