"""Arithmetic with explicit null and zero rules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartframes.columns import Name, col


def ratio_percent(a: Name, b: Name) -> Column:
    """100 * a / b with nulls taken as 0, 0/0 as 0 and x/0 as null."""
    a, b = (F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in (a, b))
    return F.when(b == 0, F.when(a == 0, F.lit(0.0))).otherwise(F.try_divide(100 * a, b))


def sum_across(names: Iterable[Name]) -> Column:
    """Sum of columns in a row, nulls counting as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(n), F.lit(0)) for n in names])


def mean_of(a: Name, b: Name, digits: int | None = None) -> Column:
    """Mean of two columns, null when either is."""
    mean = (col(a) + col(b)) / F.lit(2)
    return mean if digits is None else F.round(mean, digits)


def floor_divide(value: Name, by: float) -> Column:
    """Integer division rounding down."""
    return F.floor(col(value) / F.lit(by))


def convert(value: Name, factor: float = 1.0, divisor: float = 1.0) -> Column:
    """``value * factor / divisor`` as a double."""
    out = col(value).cast("double")
    if factor != 1.0:
        out = out * F.lit(float(factor))
    return out if divisor == 1.0 else out / F.lit(float(divisor))


def percent_columns(names: Iterable[str], suffix: str = "_PCT") -> dict[str, Column]:
    """Columns whose name ends in ``suffix``, as fractions; for ``withColumns``."""
    return {n: col(n).cast("double") / F.lit(100.0) for n in names if n.endswith(suffix)}
