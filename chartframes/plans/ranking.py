"""Rankings, Pareto curves and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col, cols, ordering
from chartframes.functions.conditions import others
from chartframes.operators import ordered
from chartframes.operators.aggregate import value_counts
from chartframes.operators.rows import recode


def pareto(df: DataFrame, key: str | list[str], value: str, keep: list | None = None) -> DataFrame:
    """Total per key, largest first, with the running percentage; ``keep`` is applied after it."""
    keys = cols(key)
    totals = df.groupBy(*[col(k) for k in keys]).agg(F.sum(col(value)).alias("total"))
    out = ordered.running_share(totals, ["-total", *keys], "total")
    if keep is not None:
        out = out.where(col(keys[0]).isin(keep))
    return out.orderBy(*ordering(["-total", *keys]))


def region_rollup(
    df: DataFrame, key: str, lookup: dict | DataFrame, keep: list[str], value: str, other: str = "Others"
) -> DataFrame:
    """Total per region: keys are recoded by a lookup and regions outside ``keep`` are collapsed."""
    regions = recode(df, key, lookup, "region")
    return regions.groupBy(others("region", keep, other).alias("region")).agg(F.sum(col(value)).alias("total"))


def top_n_per_group(df: DataFrame, group: str, score: str, n: int, order_by: list[str]) -> DataFrame:
    """The n best rows of each group with their rank; ``order_by`` settles equal scores."""
    return ordered.top_n(df, group, [f"-{score}", *order_by], n, "rank")


def top_groups(df: DataFrame, group: str, score: str, n: int) -> DataFrame:
    """The n groups with the highest mean score."""
    means = df.groupBy(col(group)).agg(F.avg(col(score)).alias("mean"))
    return means.orderBy(*ordering(["-mean", group])).limit(n)


def first_item_with_totals(df: DataFrame, key: str, order_by: list[str], columns: list[str], n: int) -> DataFrame:
    """The n keys with most rows, each with the ``columns`` of its first row under ``order_by``.

    The first row is a minimum over (order, columns), so it is found before the shuffle.
    """
    first = F.min_by(F.struct(*[col(c) for c in columns]), F.struct(*[col(o) for o in order_by]))
    items = df.groupBy(col(key)).agg(F.count("*").alias("total"), first.alias("__first"))
    kept = ordered.last_n(items, ["total", f"-{key}"], n)
    return kept.select(col(key), "total", *[F.col("__first").getField(c).alias(c) for c in columns])


def ranked_crosstab(df: DataFrame, base: str, add: str, values: list[str]) -> DataFrame:
    """Count, share and dense rank of each base value, and each (base, add) pair's share of all rows."""
    return value_counts(df, base, add, values).orderBy("total", base)
