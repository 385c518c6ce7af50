"""Column expressions that turn all-text claim files into typed values (no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.schema import CHRONIC_FLAGS, MONEY, RATIO

# Text that stands for "no code" in a code column, compared in lower case.
EMPTY_CODES = ("", "nan", "none", "0")

_NUMBER = r"(?i)^[+-]?(inf|infinity|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)$"


def date_from_text(c: Column) -> Column:
    """``yyyymmdd`` text, with or without a ``.0`` tail; anything else, or no such day, is NULL."""
    digits = F.substring_index(F.trim(c), ".", 1)
    return F.when(digits.rlike("^[0-9]{8}$"), F.try_to_date(digits, "yyyyMMdd"))


def double_from_text(c: Column) -> Column:
    """Number text as DOUBLE; NULL when it is not a number.

    The pattern keeps out forms only the engine's own cast would take, such as ``1.5d``.
    """
    text = F.trim(c)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def small_int_from_text(c: Column) -> Column:
    """Whole-number text (``12`` or ``12.0``) as SMALLINT, else NULL."""
    number = double_from_text(c)
    return F.when(number == F.floor(number), number.try_cast("smallint"))


def money_from_text(c: Column) -> Column:
    text = F.trim(c)
    return F.when(text.rlike(_NUMBER), text.try_cast(MONEY))


def code_from_text(c: Column) -> Column:
    """Trimmed code; the text ``nan`` is NULL and NULL stays NULL."""
    return F.nullif(F.trim(c), F.lit("nan"))


def first_filled(cols: Sequence[Column]) -> Column:
    """First value that is neither NULL nor blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def money_sum(cols: Sequence[Column]) -> Column:
    """Sum over claim lines; text that is not a number counts as zero."""
    zero = F.lit(0).cast(MONEY)
    return reduce(add, [F.coalesce(money_from_text(c), zero) for c in cols]).cast(MONEY)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, kept at four decimals.

    Four decimals is the stored precision of the ratio; it also bounds the number of distinct values
    a provider can have, which is what makes an exact percentile cheap (see operators.ranking).
    """
    return F.when(denominator > 0, F.round(numerator / denominator, 4).cast(RATIO))


def code_array(cols: Sequence[Column]) -> Column:
    """Distinct codes in column order, without the empty markers."""
    trimmed = F.transform(F.array(*cols), lambda x: F.trim(x))
    kept = F.filter(trimmed, lambda x: x.isNotNull() & ~F.lower(x).isin(*EMPTY_CODES))
    return F.array_distinct(kept)


def present(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """The listed columns that the frame has (wide files may lack trailing ones)."""
    have = set(df.columns)
    return [F.col(n) for n in names if n in have]


def optional(df: DataFrame, name: str) -> Column:
    """The column, or a NULL string when the source lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def chronic_count(flags: Sequence[str] = tuple(CHRONIC_FLAGS.values())) -> Column:
    """How many condition flags equal 1 (2 means no)."""
    return reduce(add, [F.when(F.col(f) == 1, 1).otherwise(0) for f in flags]).cast("int")
