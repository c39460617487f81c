"""Group aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col, cols
from chartframes.operators.columns import pick
from chartframes.operators.ordered import dense_rank
from chartframes.operators.quantiles import group_quantiles
from chartframes.operators.skew import attach
from chartframes.session import pin


def _by(df: DataFrame, keys) -> tuple[list[str], object]:
    keys = cols(keys)
    return keys, df.groupBy(*[col(k) for k in keys])


def sums(df: DataFrame, keys, names: list[str] | None = None, divisor: float | None = None) -> DataFrame:
    """Sums per group, 0 for groups of nulls; all numeric columns unless named; optionally divided."""
    keys, grouped = _by(df, keys)
    names = pick(df, "numeric", exclude=keys) if names is None else cols(names)
    totals = {n: F.coalesce(F.sum(col(n)), F.lit(0)) for n in names}
    if divisor is not None:
        totals = {n: t / F.lit(divisor) for n, t in totals.items()}
    return grouped.agg(*[t.alias(n) for n, t in totals.items()])


def means(df: DataFrame, keys, names: list[str]) -> DataFrame:
    _, grouped = _by(df, keys)
    return grouped.agg(*[F.avg(col(n)).alias(n) for n in cols(names)])


def medians(df: DataFrame, keys, names: list[str]) -> DataFrame:
    """Median of several columns per group, in one pass over the long form."""
    keys, _ = _by(df, keys)
    names = cols(names)
    long = df.select(*[col(k) for k in keys], *[col(n).cast("double").alias(n) for n in names]).unpivot(
        keys, names, "__measure", "__number"
    )
    found = group_quantiles(long, [*keys, "__measure"], "__number", {"median": 0.5}, "linear")
    return found.groupBy(*[col(k) for k in keys]).pivot("__measure", names).agg(F.first("median"))


def counts(df: DataFrame, keys, column: str | dict[str, str | None] | None = None, name: str = "n") -> DataFrame:
    """Rows per group, or its non-null values of ``column``, or several counts from ``name: column``."""
    _, grouped = _by(df, keys)
    wanted = column if isinstance(column, dict) else {name: column}
    return grouped.agg(*[F.count("*" if c is None else col(c)).alias(n) for n, c in wanted.items()])


def extent(df: DataFrame, keys, low: str, high: str | None = None) -> DataFrame:
    """Smallest ``low`` and largest ``high`` per group."""
    _, grouped = _by(df, keys)
    return grouped.agg(F.min(col(low)).alias("first"), F.max(col(high or low)).alias("last"))


def latest(df: DataFrame, time: str, columns: list[str], keys=None) -> DataFrame:
    """Value of each column at the largest ``time``, per group."""
    _, grouped = _by(df, keys)
    return grouped.agg(
        F.max(col(time)).alias(time), *[F.max_by(col(c), col(time)).alias(c) for c in cols(columns)]
    )


def value_counts(
    df: DataFrame,
    column: str,
    add: str | None = None,
    values: list[str] | None = None,
    with_counts: bool = True,
) -> DataFrame:
    """Rows per value, their share of all rows, and the dense rank of the count.

    With ``add``, also each (value, add) pair's share of the rows holding both, one column per entry
    of ``values``; without ``with_counts`` these shares are all there is. The counts come from one
    pass, and what follows works on the counted table.
    """
    pairs = [F.count_if(col(add) == v).alias(v) for v in values or []]
    known = F.count(F.lit(1) if add is None else col(add)).alias("__known")
    grouped = df.where(col(column).isNotNull()).groupBy(col(column))
    cells = pin(grouped.agg(F.count("*").alias("total"), known, *pairs))
    total, both = cells.agg(F.sum("total"), F.sum("__known")).first()
    shares = {v: F.try_divide(col(v), F.lit(both)) for v in values or []}
    if with_counts:
        cells = dense_rank(cells, "total", "rank")
        shares["percentage"] = F.try_divide(F.col("total"), F.lit(total))
    out = cells.withColumns(shares).drop("__known")
    return out if with_counts else out.drop("total")


def crosstab_share(df: DataFrame, base: str, add: str, values: list[str]) -> DataFrame:
    """Each (base, add) pair as a share of all rows holding both, one column per value of ``add``."""
    return value_counts(df, base, add, values, with_counts=False)


def group_shares(df: DataFrame, group: str, answer: str) -> DataFrame:
    """Rows of each answer in a group, the group's total and the percentage."""
    cells = pin(counts(df, [group, answer]))
    totals = cells.groupBy(col(group)).agg(F.sum("n").alias("total"), F.count("*").alias("__rows"))
    shared = attach(cells, totals, group, "__rows").drop("__rows")
    return shared.withColumn("pct", 100 * F.try_divide(F.col("n"), F.col("total")))
