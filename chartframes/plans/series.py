"""Jobs over time series in long form ``(series, time, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col
from chartframes.functions.numbers import mean_of, ratio_percent
from chartframes.operators import aggregate
from chartframes.operators.ordered import lag_diff, moving_mean, relative_to_first
from chartframes.operators.quantiles import group_quantiles
from chartframes.operators.reshape import pivot_strict
from chartframes.operators.rows import in_groups
from chartframes.session import pin

latest = aggregate.latest


def smoothed_matrix(
    df: DataFrame, time: str, series: str, value: str, window: int, values: list | None = None
) -> DataFrame:
    """Moving mean of each series, one column per series; ``df`` holds one row per series and time."""
    smooth = moving_mean(pin(df.select(col(time), col(series), col(value))), series, time, value, window, "__mean")
    return pivot_strict(smooth, time, series, "__mean", values).orderBy(time)


def pct_change_from_base(
    df: DataFrame, period: str, columns: list[str], ratios: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """Median of each measure per period, as the percentage change from the earliest period.

    ``ratios`` adds measures 100 * a / b, where nulls count as 0, 0/0 is 0 and x/0 is left out.
    """
    measures = {c: col(c).cast("double") for c in columns}
    measures |= {n: ratio_percent(a, b).cast("double") for n, (a, b) in (ratios or {}).items()}
    wide = df.select(col(period), *[m.alias(n) for n, m in measures.items()])
    long = wide.unpivot(period, list(measures), "measure", "__number")
    medians = group_quantiles(long, [period, "measure"], "__number", {"median": 0.5}, "linear")
    changes = relative_to_first(pin(medians), "measure", period, "median", "__ratio")
    percent = changes.withColumn("__pct", F.round((F.col("__ratio") - 1) * 100, 2))
    return pivot_strict(percent, period, "measure", "__pct", list(measures)).orderBy(period)


def yoy_changes(df: DataFrame, time: str, series: str, value: str, min_rise: float) -> DataFrame:
    """Change from one time to the next, for the series that once rose by ``min_rise`` or more."""
    known = pin(df.where(col(value).isNotNull()).select(col(time), col(series), col(value)))
    changes = lag_diff(known, series, time, value, "diff")
    return in_groups(changes, series, F.max("diff") >= min_rise)


def yoy_growth(
    df: DataFrame, time: str, series: str, value: str, min_rise: float, values: list | None = None
) -> DataFrame:
    """The changes with one column per kept series."""
    kept = yoy_changes(df, time, series, value, min_rise)
    return pivot_strict(kept, time, series, "diff", values).orderBy(time)


def derived_average(df: DataFrame, a: str, b: str, digits: int, name: str = "average") -> DataFrame:
    """Mean of two columns in a row, rounded."""
    average: Column = mean_of(a, b, digits)
    return df.withColumn(name, average)
