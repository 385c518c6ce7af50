"""Tables that grow by numbered batches.

``base``: everything up to some batch, merged (a published version).  ``delta/batch_id=n``: what batch n added.  A batch that
is run again overwrites its own folder, so it never counts twice.  Rows are laid out by bucket columns, and readers name the
buckets they need: the others are not read.  Compaction merges the deltas into a new base; it costs one pass over the table every
``COMPACT_AFTER`` batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.sources import tables, versions

COMPACT_AFTER = 16


@dataclass(frozen=True)
class BatchTable:
    """``schema`` holds the bucket columns of ``partition_by`` too."""

    spark: SparkSession
    root: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()

    @property
    def _base(self) -> str:
        return f"{self.root}/base"

    @property
    def _delta(self) -> str:
        return f"{self.root}/delta"

    def exists(self) -> bool:
        return tables.path_exists(self.spark, self.root)

    def upto(self) -> int:
        """Last batch that the base holds; -1 without a base."""
        now = versions.current(self.spark, self._base)
        return -1 if now is None else now[1]

    def deltas(self) -> list[int]:
        """Numbers of the batches written after the base."""
        upto = self.upto()
        return sorted(n for f in tables.folders(self.spark, self._delta) if (n := int(f.split("=")[1])) > upto)

    def replace_all(self, df: DataFrame, upto: int) -> None:
        """A new base that holds everything up to a batch; a reader meets the old table or the new one."""
        versions.publish(df.select(*self.schema.names), self._base, self.partition_by, self.cluster_by, upto)
        for f in tables.folders(self.spark, self._delta):
            if int(f.split("=")[1]) <= upto:
                tables.drop_path(self.spark, f"{self._delta}/{f}")

    def put(self, df: DataFrame, batch_id: int) -> None:
        """Write, or write again, what a batch adds."""
        rows = df.select(*self.schema.names)
        if self.partition_by:
            rows = rows.hint("rebalance", *self.partition_by)
        tables.full_refresh(rows, f"{self._delta}/batch_id={batch_id}", self.partition_by)

    def read(self, buckets: Mapping[str, Sequence[int]] | None = None, before: int | None = None, upto: int | None = None) -> DataFrame:
        """All rows, of the named buckets only, and of batches before or up to a number only."""

        def wanted(df: DataFrame) -> DataFrame:
            for column, values in (buckets or {}).items():
                df = df.filter(F.col(column).isin(list(values)))
            return df

        now = versions.current(self.spark, self._base)
        parts = [] if now is None else [wanted(versions.read(self.spark, self._base, self.schema, now[0]))]
        held = -1 if now is None else now[1]
        numbers = (int(f.split("=")[1]) for f in tables.folders(self.spark, self._delta))
        late = sorted(n for n in numbers if n > held and (before is None or n < before) and (upto is None or n <= upto))
        if late:
            paths = [f"{self._delta}/batch_id={n}" for n in late]
            # One scan over the folders; the batch number is not a column of the table.
            rows = self.spark.read.schema(self.schema).option("basePath", self._delta).parquet(*paths)
            parts.append(wanted(rows.select(*self.schema.names)))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        out = parts[0].select(*self.schema.names)
        return out if len(parts) == 1 else out.unionByName(parts[1])

    def compact(self, merge: Callable[[DataFrame], DataFrame] = lambda df: df, after: int = COMPACT_AFTER, upto: int | None = None) -> bool:
        """Merge the deltas into a new base once there are ``after`` of them."""
        late = [n for n in self.deltas() if upto is None or n <= upto]
        if len(late) < max(1, after):
            return False
        self.replace_all(merge(self.read(upto=late[-1])), late[-1])
        return True
