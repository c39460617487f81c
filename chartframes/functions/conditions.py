"""Predicates, choices and recodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartframes.columns import Name, col


def choose(condition: Column, then: Name, otherwise: Name) -> Column:
    """Two-way choice; plain names are columns, wrap literals in ``F.lit``."""
    return F.when(condition, col(then)).otherwise(col(otherwise))


def first_match(*pairs: tuple[Column, object]) -> Column:
    """Value of the first true condition, null when none is."""
    out = F
    for condition, value in pairs:
        out = out.when(condition, value if isinstance(value, Column) else F.lit(value))
    return out


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def within(value: Name, low, high, closed: str = "both") -> Column:
    """Range test; ``closed`` is ``both``, ``left``, ``right`` or ``none``."""
    value = col(value)
    lower = value >= low if closed in ("both", "left") else value > low
    upper = value <= high if closed in ("both", "right") else value < high
    return lower & upper


def same_text(value: Name, text: str) -> Column:
    """Equality that ignores case."""
    return F.upper(col(value)) == text.upper()


def bin_label(value: Name, bins: Sequence[tuple[float | None, float | None, str]], default: str | None = None) -> Column:
    """Label of the range (low, high] the value lies in, as one CASE; None is an open end."""
    value = col(value)
    out = F
    for low, high, label in bins:
        test = F.lit(True)
        if low is not None:
            test = test & (value > low)
        if high is not None:
            test = test & (value <= high)
        out = out.when(value.isNotNull() & test, F.lit(label))
    return F.lit(default) if out is F else out.otherwise(F.lit(default))


def others(value: Name, keep: list[str], label: str = "Others") -> Column:
    """Values outside ``keep``, null among them, become one label."""
    return F.when(col(value).isin(keep), col(value)).otherwise(F.lit(label))


def fill_from(value: Name, *fallbacks: object) -> Column:
    """First non-null of the value and its fallbacks: names are columns, ``F.lit`` gives literals."""
    return F.coalesce(col(value), *[col(f) for f in fallbacks])
