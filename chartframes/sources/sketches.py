"""Mergeable sketches of columns: ranks (KLL) and distinct values (HLL), from one pass, for tables that are looked at again."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col
from chartframes.operators.columns import pick

#: Size of the rank sketches: ranks are off by less than half a percent of the rows, mostly.
KLL_SIZE = 800
#: Size of the sketches of distinct values, as a power of two: counts are off by about a percent, mostly.
HLL_SIZE = 14
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def sketches(df: DataFrame) -> DataFrame:
    """One row (column, type, rows, count, ranks, distinct) per column; ranks of numbers only, distinct values of all plain types."""
    numeric = set(pick(df, "numeric"))
    one = []
    for name, kind in df.dtypes:
        number = F.when(~F.isnan(col(name).cast("double")), col(name).cast("double"))
        ranks = F.kll_sketch_agg_double(number, KLL_SIZE) if name in numeric else F.lit(None).cast("binary")
        plain = "<" not in kind and kind not in ("variant", "void")
        distinct = F.hll_sketch_agg(col(name).cast("string"), HLL_SIZE) if plain else F.lit(None).cast("binary")
        one.append(
            F.struct(
                F.lit(name).alias("column"), F.lit(kind).alias("type"), F.count("*").alias("rows"), F.count(col(name)).alias("count"),
                ranks.alias("ranks"), distinct.alias("distinct"),
            )
        )
    return df.agg(F.array(*one).alias("all")).select(F.inline("all"))


def merge_sketches(parts: Iterable[DataFrame]) -> DataFrame:
    """The sketches of all parts together, as if their rows had been sketched at once."""
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    return stacked.groupBy("column", "type").agg(
        F.sum("rows").alias("rows"), F.sum("count").alias("count"), F.kll_merge_agg_double("ranks").alias("ranks"), F.hll_union_agg("distinct").alias("distinct")
    )


def estimates(sketched: DataFrame) -> DataFrame:
    """One row (column, type, count, nulls, q1, median, q3, distinct) per column, estimated from its sketches."""
    some = F.when(F.kll_sketch_get_n_double("ranks") > 0, F.col("ranks"))
    return sketched.select(
        "column", "type", "count", (F.col("rows") - F.col("count")).alias("nulls"),
        *[F.kll_sketch_get_quantile_double(some, F.lit(q)).alias(n) for n, q in QUARTILES.items()],
        F.hll_sketch_estimate("distinct").alias("distinct"),
    )
