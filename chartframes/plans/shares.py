"""Shares, counts and spreads of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartframes.columns import Name, col, cols
from chartframes.functions.cleaning import safe_cast
from chartframes.functions.numbers import sum_across
from chartframes.operators.aggregate import group_shares
from chartframes.operators.fit import distribution
from chartframes.operators.quantiles import group_quantiles, iqr_fences, quartiles_and_median
from chartframes.operators.reshape import pivot_count, pivot_strict, pivot_sum
from chartframes.operators.rows import in_groups, recode
from chartframes.operators.skew import attach, share_of_group
from chartframes.session import pin

group_share = group_shares
iqr_summary = iqr_fences


def iqr_flags(df: DataFrame, value: str, by, k: float = 1.5, truncate: bool = False) -> DataFrame:
    """Each row with the fences of its group and whether it lies outside them."""
    by = cols(by)
    fences = iqr_fences(df, by, value, k, truncate, "__rows").select(
        *[col(k) for k in by], "q1", "q3", "fence_low", "fence_high", "__rows"
    )
    out = attach(df, fences, by, "__rows").drop("__rows")
    outside = (col(value) > F.col("fence_high")) | (col(value) < F.col("fence_low"))
    return out.withColumn("is_outlier", F.coalesce(outside, F.lit(False)))


def interquartile_mean(df: DataFrame, group: str, value: str, min_rows: int, digits: int = 1) -> DataFrame:
    """Mean of the values between the quartiles, for groups with ``min_rows`` values or more."""
    stats = quartiles_and_median(df, group, value, "n", "__rows").where(F.col("n") >= min_rows)
    inner = attach(df.select(col(group), col(value)), stats, group, "__rows", "inner")
    means = (
        inner.where(col(value).between(F.col("q1"), F.col("q3")))
        .groupBy(col(group), "n", "q1", "median", "q3")
        .agg(F.avg(col(value)).alias("average"))
    )
    label = F.concat(col(group).cast("string"), F.lit(": "), F.round("average", digits).cast("string"))
    return means.withColumn("label", label)


def proportion_by_quartile(
    df: DataFrame, columns: dict[str, tuple[str, str]], marker: str | None = None, splits: list[str] | None = None
) -> DataFrame:
    """Mean of wide percent columns per quartile (rows) and split (columns).

    ``columns`` maps each column to its (quartile, split); ``marker`` is the text of a missing cell.
    """
    long = df.select(*[col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "cat", "percent")
    if marker is not None:
        long = long.where(F.col("percent") != marker)
    percent = F.col("percent").cast("double")
    totals = long.groupBy("cat").agg(F.sum(percent).alias("sum"), F.count(percent).alias("n"))
    parts = recode(totals, "cat", {c: q for c, (q, _) in columns.items()}, "quartile")
    parts = recode(parts, "cat", {c: s for c, (_, s) in columns.items()}, "split")
    means = parts.groupBy("quartile", "split").agg(F.try_divide(F.sum("sum"), F.sum("n")).alias("mean"))
    return pivot_strict(means, "quartile", "split", "mean", splits).orderBy("quartile")


def yearly_counts(
    df: DataFrame,
    unit: str,
    period: str,
    periods: list[str],
    combine: dict[str, list[str]],
    null_parts: str = "zero",
) -> DataFrame:
    """Rows per unit and period with a total; ``combine`` adds up part periods into one column.

    With ``null_parts="null"`` a combined period is unknown, and left out of the total, unless all
    of its parts are there. In the result absent counts are 0.
    """
    wide = pivot_count(df, unit, period, periods)
    for name, parts in combine.items():
        if null_parts == "zero":
            joined = sum_across(parts)
        else:
            joined = sum((col(p) for p in parts[1:]), col(parts[0]))
        wide = wide.withColumn("__joined", joined).drop(*parts).withColumnRenamed("__joined", name)
    names = [c for c in wide.columns if c != unit]
    return wide.withColumn("total", sum_across(names)).fillna(0, [*names, "total"])


def per_million(df: DataFrame, unit: str, columns: list[str], population: DataFrame, scale: float = 1e6) -> DataFrame:
    """Counts per ``scale`` residents; ``population`` is a table (unit, residents)."""
    joined = df.join(pin(population.toDF(unit, "__residents")), unit, "left")  # a plain side, which AQE can split
    rates = {c: F.try_divide(F.lit(float(scale)) * col(c), F.col("__residents")) for c in columns}
    return joined.withColumns(rates).select(col(unit), *[col(c) for c in columns])


def decade_share(df: DataFrame, year: Name, group: str, value: str, span: int = 10, values: list | None = None) -> DataFrame:
    """Share of each group's total that falls into each span of years, one column per group."""
    start = F.floor(col(year) / span) * span
    label = F.concat(start.cast("string"), F.lit("s"))
    totals = df.groupBy(label.alias("decade"), col(group)).agg(F.sum(col(value)).alias("__total"))
    shares = share_of_group(pin(totals), group, "__total", "__share")
    return pivot_sum(shares, "decade", group, "__share", values).orderBy("decade")


def count_by_age_and_status(df: DataFrame, age: Name, status: str, statuses: list[str] | None = None) -> DataFrame:
    """Rows per age, one column per status."""
    known = df.where(col(status).isNotNull()).withColumn("age", col(age))
    return pivot_count(known, "age", status, statuses).orderBy("age")


def yield_summary(df: DataFrame, value: str, by: str, mapping: dict | None = None) -> DataFrame:
    """Spread of a text measure per category; cells that are no numbers are left out."""
    numbers = df.withColumn(value, safe_cast(value, "double")).where(col(value).isNotNull())
    return distribution(recode(numbers, by, mapping) if mapping else numbers, value, by)


def percentile_matrix(
    df: DataFrame, label: Name, group: str, value: Name, percentiles: list[int], divisor: float = 365
) -> DataFrame:
    """Percentile rows as published: the percentile is read from the label, the value is days to years.

    It is the label's whole number with an ordinal ending, or else its first whole number. Only groups with all
    percentiles are kept, two rows for one percentile of a group fail the job; long form ``(percentile, group, years)``.
    """
    ordinal, first = (F.regexp_extract(col(label), p, 1) for p in (r"(\d+)(?:st|nd|rd|th)\b", r"(\d+)"))
    number = F.coalesce(F.nullif(ordinal, F.lit("")), first).try_cast("int")
    percentile = F.when(number.isin(percentiles), number)
    years = col(value).cast("double").cast("int") / F.lit(float(divisor))
    rows = pin(df.select(percentile.alias("percentile"), col(group), years.alias("years")).dropna())
    kinds = F.size(F.collect_set("percentile"))  # no more than the percentiles asked for
    twice = F.raise_error(F.lit("percentiles: two rows for one percentile of a group"))
    return in_groups(rows, group, F.when(F.count("*") == kinds, kinds == len(percentiles)).otherwise(twice))


def percentile_table(
    df: DataFrame, label: Name, group: str, value: Name, percentiles: list[int], groups: list | None = None
) -> DataFrame:
    """The percentile matrix with one column per complete group."""
    long = percentile_matrix(df, label, group, value, percentiles)
    return pivot_strict(long, "percentile", group, "years", groups).orderBy("percentile")


def percentile_rows(df: DataFrame, group: str, value: str, percentiles: list[int]) -> DataFrame:
    """Nearest-rank percentiles of raw values in long form ``(group, label, value)``."""
    names = {f"{p}th percentile": p / 100 for p in percentiles}
    wide = group_quantiles(df, group, value, names)
    return wide.unpivot(group, list(names), "label", "value")
