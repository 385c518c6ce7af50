"""All registered queries and their check SQL."""

from __future__ import annotations

from ledgerlark.checks import (
    cleaning_checks,
    feature_checks,
    increment_checks,
    learning_checks,
    report_checks,
    score_checks,
    sink_checks,
    stream_checks,
)

_MODULES = (feature_checks, cleaning_checks, increment_checks, score_checks, learning_checks, report_checks, stream_checks, sink_checks)


def queries() -> dict:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
