"""Where the tables of one deployment live, and the small append-only state tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.features import PROVIDER
from ledgerlark.operators.increments import SEED_POSITION
from ledgerlark.schema import BENEFICIARY_SUMMARY, CARRIER_CLAIMS, OUTPATIENT_CLAIMS, PROVIDER_FEATURES
from ledgerlark.sources import tables, versions
from ledgerlark.sources.batches import BatchTable
from ledgerlark.sources.claim_state import BUCKETS, PROVIDER_BUCKET, ClaimState

POSITIONS = "claim_type string, last_clm_date date, batch_id int"
RUN_EVENTS = (
    "run_id int, event_at timestamp, seq bigint, status string, model_id bigint, batch_id int,"
    " carrier_claims_processed bigint, outpatient_claims_processed bigint, error_message string"
)
MODELS = (
    "model_id bigint, model_type string, model_version string, trained_at timestamp, training_samples bigint,"
    " n_estimators int, contamination double, avg_anomaly_score double, test_auc_roc double, test_precision double,"
    " test_recall double, test_f1 double, model_path string, notes string"
)
INGESTS = "batch_id int, claims bigint, loaded_at timestamp"
PROMOTIONS = "model_id bigint, model_type string, promoted_at timestamp, seq bigint, notes string"


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def beneficiaries(self) -> DataFrame:
        return versions.read(self.spark, self.path("beneficiary_summary"), BENEFICIARY_SUMMARY)

    def _claims(self, name: str, schema: T.StructType) -> BatchTable:
        stored = T.StructType([*schema.fields, T.StructField(PROVIDER_BUCKET, T.IntegerType())])
        return BatchTable(self.spark, self.path(name), stored, ("claim_year", PROVIDER_BUCKET), (PROVIDER,))

    def carrier_table(self) -> BatchTable:
        return self._claims("carrier_claims", CARRIER_CLAIMS)

    def outpatient_table(self) -> BatchTable:
        return self._claims("outpatient_claims", OUTPATIENT_CLAIMS)

    def carrier(self) -> DataFrame:
        return self.carrier_table().read(upto=self.last_ingest()).select(*CARRIER_CLAIMS.names)

    def outpatient(self, buckets: list[int] | None = None) -> DataFrame:
        """Outpatient claims, of the given provider buckets only."""
        wanted = None if buckets is None else {PROVIDER_BUCKET: buckets}
        return self.outpatient_table().read(wanted).select(*OUTPATIENT_CLAIMS.names)

    def features(self) -> DataFrame:
        return tables.read_or_empty(self.spark, self.path("provider_features"), PROVIDER_FEATURES).select(*PROVIDER_FEATURES.names)

    def last_ingest(self) -> int:
        """Number of the last batch of claims that was added in full; 0 after a full load."""
        return self.state("ingests", INGESTS).agg(F.coalesce(F.max("batch_id"), F.lit(0)).alias("m")).first()["m"]

    def claim_state(self) -> ClaimState:
        """Stored cells, keys and day counts of the carrier claims; made from the claims where they are missing."""
        upto = self.last_ingest()
        state = ClaimState(self.spark, self.path("claim_state"), self.buckets, upto)
        if state.days.upto() < 0 and self.carrier_table().upto() >= 0:
            state.rebuild(self.carrier(), upto)
        return state

    def state(self, name: str, schema: str) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        return tables.read_or_empty(self.spark, self.path(name), empty.schema)

    def add_state(self, name: str, schema: str, row: tuple) -> None:
        tables.append(self.spark.createDataFrame([row], schema).coalesce(1), self.path(name))

    def position(self, claim_type: str = "carrier", seed: str = SEED_POSITION) -> tuple[str, int]:
        """(last processed service date, last batch id); the seed before the first batch."""
        last = (
            self.state("positions", POSITIONS)
            .filter(F.col("claim_type") == claim_type)
            .agg(F.max(F.struct("batch_id", "last_clm_date")).alias("p"))
            .first()["p"]
        )
        return (seed, 0) if last is None else (str(last["last_clm_date"]), int(last["batch_id"]))
