"""Jobs over calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col, cols
from chartframes.functions.dates import calendar_parts, localize
from chartframes.functions.text import zero_pad
from chartframes.operators.quantiles import iqr_fences
from chartframes.operators.reshape import pivot_strict
from chartframes.operators.skew import attach
from chartframes.sources.tables import weekdays


def monthly_totals(df: DataFrame, ts: str, group: str, value: str, values: list | None = None) -> DataFrame:
    """Totals per month, one column per group, with a ``year_month`` label."""
    months = df.groupBy(F.year(col(ts)).alias("year"), F.month(col(ts)).alias("month"), col(group)).agg(
        F.sum(col(value)).alias("__total")
    )
    wide = pivot_strict(months, ["year", "month"], group, "__total", values)
    label = F.concat(F.col("year").cast("string"), F.lit("_"), zero_pad("month", 2))
    return wide.withColumn("year_month", label).orderBy("year", "month")


def reference_means(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of each column, in one row."""
    return df.agg(*[F.avg(col(c)).alias(c) for c in columns])


def calendar_matrix(df: DataFrame, ts: str, value: str, years: list[int]) -> DataFrame:
    """One row per day of the year, one column per year; ``df`` holds one row per day."""
    parts = calendar_parts(ts)
    days = df.select(
        *[parts[n].alias(n) for n in ("year", "month", "month_name", "day")], col(value).alias("__value")
    )
    wide = pivot_strict(days, ["month", "month_name", "day"], "year", "__value", years, others="drop")
    label = F.concat("month_name", F.lit(" "), F.col("day").cast("string"))
    return wide.withColumn("date", label).orderBy("month", "day")


def weekday_means(
    df: DataFrame, ts: str, value: str, years: list[int], k: float = 1.5, scale: float = 1.0
) -> DataFrame:
    """Mean per weekday and year over the values inside the IQR fences of that weekday and year."""
    parts = calendar_parts(ts)
    days = df.select(parts["year"].alias("year"), parts["day_name"].alias("day_name"), col(value).alias("__value"))
    by = ["year", "day_name"]
    fences = iqr_fences(days, by, "__value", k, rows="__rows").select(*by, "fence_low", "fence_high", "__rows")
    inside = attach(days, fences, by, "__rows").where(F.col("__value").between(F.col("fence_low"), F.col("fence_high")))
    means = inside.groupBy(*by).agg((F.avg("__value") / F.lit(scale)).alias("__mean"))
    wide = pivot_strict(means, "day_name", "year", "__mean", years, others="drop")
    return weekdays(df.sparkSession).join(wide, "day_name", "left").orderBy("day_num")


# fixed values: the grains of a load profile and the aggregate each one uses
_GRAINS = {"date": "sum", "weekday": "sum", "hour": "mean", "week": "sum"}


def load_profiles(
    df: DataFrame,
    ts: str,
    zone: str,
    columns: dict[str, Column | str],
    rate: DataFrame | None = None,
    grain: str = "date",
    scale: float = 1.0,
    weeks: float = 52,
    nonexistent: str = "raise",
) -> DataFrame:
    """Load per date, weekday, hour or ISO week, in long form ``(grain, series, load)``.

    ``ts`` is local time in ``zone``; it is checked against the zone's calendar. ``columns`` maps a
    series to a column or to an expression that merges several. ``rate`` is a table ``(series, per)``;
    each load is divided by ``per`` and multiplied by ``scale``. Weekday sums are divided by ``weeks``.
    """
    if grain not in _GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    parts = calendar_parts(ts)
    key = {"date": col(ts).cast("date"), "weekday": parts["day_num"]}.get(grain)
    key = parts[grain] if key is None else key
    utc = localize(ts, zone, "latest", nonexistent)
    wide = df.select(
        key.alias(grain), utc.alias("__utc"), *[col(v).cast("double").alias(n) for n, v in columns.items()]
    )
    if nonexistent == "null":
        wide = wide.where("__utc IS NOT NULL")
    # counting the UTC times keeps them in the plan, so that every local time is checked
    totals = wide.groupBy(grain).agg(
        F.count("__utc").alias("__checked"),
        *[(F.sum(col(n)) if _GRAINS[grain] == "sum" else F.avg(col(n))).alias(n) for n in columns],
    ).where(F.col("__checked") >= 0)
    long = totals.unpivot(grain, list(columns), "series", "load")
    if rate is not None:
        long = long.join(rate.toDF("series", "__per"), "series", "left")
        long = long.withColumn("load", F.try_divide(F.col("load"), F.col("__per")) * F.lit(scale)).drop("__per")
    if grain == "weekday":
        long = long.withColumn("load", F.col("load") / F.lit(float(weeks)))
        long = long.join(weekdays(df.sparkSession, 0).toDF("day_name", "weekday"), "weekday", "left")
    return long.select(*cols([grain]), *[c for c in long.columns if c != grain])
