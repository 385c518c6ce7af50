"""Keyed writes without row updates: insert-if-absent and replace-by-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerlark.operators.ranking import first_per_key, join_null_safe


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows to append: the first incoming row per key whose key the target lacks.  A NULL in a key equals a NULL."""
    fresh = first_per_key(incoming, keys, order)
    return join_null_safe(fresh, target.select(*keys), keys, "left_anti").select(*incoming.columns)


def replace_by_key(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with every row whose key is in ``new`` replaced by the new rows.

    ``new`` is read twice: write it first when it is dear to compute.
    """
    kept = join_null_safe(target, new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)
