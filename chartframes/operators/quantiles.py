"""Exact quantiles per group, for groups of any size.

Spark's own exact ``percentile`` keeps a group's values in one task's memory. Here equal values are
counted first, on (group, value), which no group can unbalance; a running count over the distinct
values then finds the value at each rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartframes.columns import Name, col, cols
from chartframes.operators.ordered import running_sum
from chartframes.operators.skew import TASK_ROWS, attach, fits_one_task
from chartframes.session import pin


def _at_rank(rank: Column) -> Column:
    return F.min(F.when(F.col("__upto") >= rank, F.col("__value")))


def group_quantiles(
    df: DataFrame,
    keys: Name | list[str] | None,
    value: Name,
    quantiles: dict[str, float],
    method: str = "nearest",
    count: str | None = None,
    rows: str | None = None,
    limit: int | None = TASK_ROWS,
) -> DataFrame:
    """One row per group with a column per entry of ``quantiles``; nulls are ignored.

    ``nearest`` takes the element at index floor(q * (n - 1) + 0.5) of the sorted values.
    ``linear`` interpolates between the neighbours of q * (n - 1); 0.5 gives the usual median.
    ``count`` names a column for the number of non-null values, ``rows`` one for all rows.
    """
    return _quantiles(df, keys, value, {k: (q, method) for k, q in quantiles.items()}, count, rows, limit)


def quartiles_and_median(
    df: DataFrame,
    keys,
    value: Name,
    count: str | None = "n",
    rows: str | None = None,
    limit: int | None = TASK_ROWS,
) -> DataFrame:
    """Nearest-rank ``q1`` and ``q3``, interpolated ``median`` and the count, from one pass."""
    picks = {"q1": (0.25, "nearest"), "median": (0.5, "linear"), "q3": (0.75, "nearest")}
    return _quantiles(df, keys, value, picks, count, rows, limit)


def _quantiles(df, keys, value, picks, count, rows, limit) -> DataFrame:
    keys = cols(keys)
    source = df.select(*[col(k) for k in keys], col(value).alias("__value"))
    group = [col(k) for k in keys]
    counts = source.groupBy(*group, "__value").agg(
        F.count("__value").alias("__count"), F.count("*").alias("__copies")
    )
    if limit:
        counts = pin(counts)  # sized and then ranked; the input is read once
    if fits_one_task(counts, keys, limit):
        whole = Window.partitionBy(*group)
        upto = whole.orderBy("__value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counts.withColumns(
            {"__upto": F.sum("__count").over(upto), "__n": F.sum("__count").over(whole)}
        )
    else:
        ranked = running_sum(counts, keys, ["__value"], "__count", "__upto", 0)
        sizes = ranked.groupBy(*group).agg(F.max("__upto").alias("__n"), F.count("*").alias("__rows"))
        ranked = attach(ranked, sizes, keys, "__rows").drop("__rows")
    ranked = ranked.withColumns(
        {f"__place_{i}": F.lit(float(q)) * (F.col("__n") - 1) for i, (q, _) in enumerate(picks.values())}
    )
    found = []
    for i, (name, (_, method)) in enumerate(picks.items()):
        place = F.col(f"__place_{i}")
        if method == "nearest":
            found.append(_at_rank(F.floor(place + 0.5) + 1).alias(name))
        elif method == "linear":
            low, high = _at_rank(F.floor(place) + 1), _at_rank(F.ceil(place) + 1)
            found.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
        else:
            raise ValueError(f"unknown quantile method {method!r}")
    if count:
        found.append(F.max("__n").alias(count))
    if rows:
        found.append(F.sum("__copies").alias(rows))
    return ranked.groupBy(*group).agg(*found)


def with_group_quantiles(
    df: DataFrame,
    keys,
    value: Name,
    quantiles: dict[str, float],
    method: str = "nearest",
    limit: int | None = TASK_ROWS,
) -> DataFrame:
    """The quantiles of each group on each of its rows."""
    stats = group_quantiles(df, keys, value, quantiles, method, None, "__rows", limit)
    return attach(df, stats, keys, "__rows").drop("__rows")


def iqr_fences(
    df: DataFrame,
    by,
    value: Name,
    k: float = 1.5,
    truncate: bool = False,
    rows: str | None = None,
    limit: int | None = TASK_ROWS,
) -> DataFrame:
    """Count, median, quartiles, IQR and outlier fences of each group.

    ``truncate`` cuts the fences to whole numbers, as whole-number measures want.
    """
    out = quartiles_and_median(df, by, value, "n", rows, limit).withColumn("iqr", F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - k * F.col("iqr"), F.col("q3") + k * F.col("iqr")
    if truncate:
        low, high = low.cast("bigint"), high.cast("bigint")
    return out.withColumns({"fence_low": low, "fence_high": high})
