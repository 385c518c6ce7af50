"""What the refresh of features keeps of all claims seen so far, so that no batch reads the claims again.

* ``keys``: claim ids, laid out by a hash bucket of the id.  A keyed insert reads the buckets of the incoming ids only.
* ``cells``: claims per (provider, beneficiary, code, day), and ``amounts``: claims and cents per (provider, year, place, ratio);
  both laid out by a hash bucket of the provider.  They add up, so a batch only appends its own cells, and the features of
  the providers it names are folded from their buckets.
* ``days``: claims per day, from which the next batch is cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators import features as fx
from ledgerlark.operators.increments import counts_by_day
from ledgerlark.operators.ranking import first_per_key, join_null_safe
from ledgerlark.schema import RATIO
from ledgerlark.session import materialise
from ledgerlark.sources.batches import COMPACT_AFTER, BatchTable
from ledgerlark.sources.tables import values_of

#: Buckets unless a warehouse or stream names its own number: some hundreds on a large cluster.  Fixed once tables exist.
BUCKETS = 8
PROVIDER_BUCKET, KEY_BUCKET = "provider_bucket", "key_bucket"
CLAIM_ORDER = ("clm_from_dt", "desynpuf_id", fx.PROVIDER)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_TEXT, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
KEYS = _schema(("clm_id", _TEXT), (KEY_BUCKET, _INT))
CELLS = _schema(
    (fx.PROVIDER, _TEXT), ("desynpuf_id", _TEXT), ("primary_hcpcs_cd", _TEXT), ("day", T.DateType()), ("cnt", _LONG), (PROVIDER_BUCKET, _INT)
)
AMOUNTS = _schema(
    (fx.PROVIDER, _TEXT), (fx.YEAR, _INT), ("place_of_service_cd", _TEXT), ("ratio", RATIO),
    *((c, _LONG) for c in ("cnt", "charge_cents", "charge_n", "allowed_cents", "allowed_n")), (PROVIDER_BUCKET, _INT),
)
DAYS = _schema(("day", T.DateType()), ("cnt", _LONG))


def bucket(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def together(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Run small independent jobs at the same time; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


class ClaimState:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, upto: int | None = None):
        """``upto``: the last batch that counts; later folders stem from attempts that failed."""
        self.spark, self.buckets, self.upto = spark, buckets, upto
        self.keys = BatchTable(spark, f"{root}/claim_keys", KEYS, (KEY_BUCKET,))
        self.cells = BatchTable(spark, f"{root}/claim_cells", CELLS, (PROVIDER_BUCKET,), (fx.PROVIDER,))
        self.amounts = BatchTable(spark, f"{root}/amount_cells", AMOUNTS, (PROVIDER_BUCKET,), (fx.PROVIDER,))
        self.days = BatchTable(spark, f"{root}/claim_days", DAYS)

    # --- keeping it up to date -----------------------------------------------------------------

    def _parts(self, claims: DataFrame, with_keys: bool) -> list[tuple[BatchTable, DataFrame]]:
        by_provider = bucket(fx.PROVIDER, self.buckets)
        parts = [
            (self.cells, _typed(fx.claim_cells(claims).withColumn(PROVIDER_BUCKET, by_provider), CELLS)),
            (self.amounts, _typed(fx.amount_cells(claims).withColumn(PROVIDER_BUCKET, by_provider), AMOUNTS)),
            (self.days, _typed(counts_by_day(claims), DAYS)),
        ]
        if with_keys:
            parts.append((self.keys, claims.select("clm_id", bucket("clm_id", self.buckets).alias(KEY_BUCKET))))
        return parts

    def rebuild(self, claims: DataFrame, upto: int = 0) -> None:
        """From all claims, as of batch ``upto``."""
        together(self.spark, *[lambda t=t, d=d: t.replace_all(d, upto) for t, d in self._parts(claims, True)])

    def absorb(self, claims: DataFrame, batch_id: int, with_keys: bool = True, *more: Callable[[], object]) -> None:
        """Add the claims of a batch; run again, it replaces what it wrote.  ``claims`` is read several times."""
        together(self.spark, *[lambda t=t, d=d: t.put(d, batch_id) for t, d in self._parts(claims, with_keys)], *more)

    def known(self, buckets: Sequence[int], batch_id: int) -> DataFrame:
        """Claim ids of batches before this one, of the given buckets."""
        return self.keys.read({KEY_BUCKET: buckets}, before=batch_id)

    def fresh(self, incoming: DataFrame, batch_id: int) -> DataFrame:
        """The first row of each claim id that no batch before this one brought.  A NULL id equals a NULL."""
        one = first_per_key(incoming, ["clm_id"], CLAIM_ORDER).withColumn(KEY_BUCKET, bucket("clm_id", self.buckets))
        one = materialise(one, "incoming-claims")
        known = self.known([b for (b,) in values_of(one, [KEY_BUCKET])], batch_id)
        return materialise(join_null_safe(one, known.select("clm_id"), ["clm_id"], "left_anti").select(*incoming.columns), "fresh-claims")

    def compact(self, after: int = COMPACT_AFTER) -> None:
        """Merge batches where there are ``after`` of them."""
        more = {"after": after, "upto": self.upto}
        self.cells.compact(lambda df: _typed(fx.add_cells(df).withColumn(PROVIDER_BUCKET, bucket(fx.PROVIDER, self.buckets)), CELLS), **more)
        self.amounts.compact(lambda df: _typed(fx.add_amounts(df).withColumn(PROVIDER_BUCKET, bucket(fx.PROVIDER, self.buckets)), AMOUNTS), **more)
        self.days.compact(lambda df: df.groupBy("day").agg(F.sum("cnt").alias("cnt")), **more)
        self.keys.compact(**more)

    # --- reading it ----------------------------------------------------------------------------

    def active(self, claims: DataFrame) -> DataFrame:
        """(provider, bucket) of the providers that claims name, written once for the joins that follow."""
        names = claims.select(fx.PROVIDER).dropna().distinct()
        return materialise(names.withColumn(PROVIDER_BUCKET, bucket(fx.PROVIDER, self.buckets)), "active-providers")

    def _sizes(self, active: DataFrame) -> dict[int, int]:
        """Active providers per bucket; one row per bucket comes to the driver."""
        return {r[PROVIDER_BUCKET]: r["count"] for r in active.groupBy(PROVIDER_BUCKET).count().collect()}

    def history(self, active: DataFrame, sizes: dict[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
        """(cells, amounts) of the active providers; only their buckets are read."""
        sizes = self._sizes(active) if sizes is None else sizes
        buckets, n = {PROVIDER_BUCKET: sorted(sizes)}, sum(sizes.values())
        cells = fx.keep_providers(self.cells.read(buckets, upto=self.upto), active, ("desynpuf_id", "primary_hcpcs_cd", "day"), n)
        amounts = fx.keep_providers(self.amounts.read(buckets, upto=self.upto), active, ("place_of_service_cd", "ratio"), n)
        return fx.add_cells(cells), fx.add_amounts(amounts)

    def features(self, active: DataFrame, bene: DataFrame, outpatient: DataFrame, batch_id: int) -> DataFrame:
        """Features of the active providers, with their bucket."""
        sizes = self._sizes(active)
        cells, amounts = self.history(active, sizes)
        own = fx.keep_providers(outpatient, active, ("desynpuf_id", "clm_from_dt", "clm_pmt_amt"), sum(sizes.values()))
        return fx.features_of_cells(cells, amounts, bene, own, batch_id).withColumn(PROVIDER_BUCKET, bucket(fx.PROVIDER, self.buckets))
