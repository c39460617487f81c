"""Row-wise jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col
from chartframes.functions.cleaning import currency
from chartframes.functions.conditions import bin_label, first_match
from chartframes.functions.numbers import convert
from chartframes.functions.text import wrap_text


def log_size(df: DataFrame, column: str, digits: int = 1, name: str = "size") -> DataFrame:
    """(1 + log10 x - log10 of the smallest x) squared, for the rows with x > 0."""
    known = df.where(col(column) > 0)
    low = known.agg(F.min(F.log10(col(column))).alias("low")).scalar()
    return known.withColumn(name, F.round(F.pow(1 + F.log10(col(column)) - low, F.lit(2)), digits))


def bin_labels(df: DataFrame, column: str, bins: list[tuple], default: str | None = None, name: str = "bin") -> DataFrame:
    """Label of the right-closed range each value lies in."""
    return df.withColumn(name, bin_label(column, bins, default))


def unit_conversion(df: DataFrame, factors: dict[str, tuple[str, float, float]]) -> DataFrame:
    """New columns ``value * factor / divisor`` from ``name: (column, factor, divisor)``."""
    return df.withColumns({n: convert(c, f, d) for n, (c, f, d) in factors.items()})


def feet_and_inches(df: DataFrame, centimetres: str) -> DataFrame:
    """Length in inches, and as whole feet and the remaining inches."""
    # fixed value: inches per centimetre
    inches = convert(centimetres, 0.39370079)
    feet = F.floor(inches / 12)
    return df.withColumns({"total_inches": inches, "feet": feet, "inches": inches - feet * 12})


def company_tiers(
    df: DataFrame,
    key: str,
    currency_columns: dict[str, tuple[float, int]],
    tier_by: str,
    tiers: list[tuple[float, str, int]],
    coords: DataFrame | None = None,
    wrap: tuple[str, int] | None = None,
) -> DataFrame:
    """Currency texts as numbers, a tier label and marker size, wrapped text and coordinates.

    ``currency_columns`` maps a column to (scale, digits). ``tiers`` lists (lower bound, label, size)
    from high to low; a value must exceed the bound. ``coords`` is a table keyed by ``key``.
    """
    clean = df.withColumns({c: currency(c, scale, digits) for c, (scale, digits) in currency_columns.items()})
    out = {
        "tier": first_match(*[(col(tier_by) > bound, label) for bound, label, _ in tiers]),
        "marker_size": first_match(*[(col(tier_by) > bound, size) for bound, _, size in tiers]),
    }
    if wrap is not None:
        out[f"{wrap[0]}_wrapped"] = wrap_text(*wrap)
    tiered = clean.withColumns(out)
    if wrap is not None:
        tiered = tiered.drop(wrap[0])
    return tiered if coords is None else tiered.join(coords, key, "left")
