"""A look at a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col
from chartframes.operators.columns import pick
from chartframes.operators.selection import Pick, refined_quantiles


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, count, nulls, min and max as text, mean and standard deviation; from one pass.

    Values are compared in their own type and shown as its text, so whole numbers keep all digits.
    """
    numeric = set(pick(df, "numeric"))

    def summary(name: str, kind: str):
        number = col(name).cast("double")
        mean, std = (f(number) if name in numeric else F.lit(None).cast("double") for f in (F.avg, F.stddev))
        ordered = not any(x in kind for x in ("map<", "variant", "interval"))
        value = col(name) if ordered else F.lit(None)
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.count(col(name)).alias("count"),
            F.count_if(col(name).isNull()).alias("nulls"),
            F.min(value).cast("string").alias("min"),
            F.max(value).cast("string").alias("max"),
            mean.alias("mean"),
            std.alias("std"),
        )

    summaries = [summary(n, t) for n, t in df.dtypes]
    return df.agg(F.array(*summaries).alias("all")).select(F.explode("all").alias("one")).select("one.*")


def distinct_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """Exact number of distinct values per column, counted in long form so that no task holds a set."""
    long = df.select(*[col(n).cast("string").alias(n) for n in names]).unpivot([], names, "column", "value")
    values = long.where("value IS NOT NULL").distinct()
    return values.groupBy("column").agg(F.count("*").alias("distinct"))


def describe(df: DataFrame) -> DataFrame:
    """``profile`` with exact quartiles, median and number of distinct values of each column.

    Quartiles are elements (nearest rank), the median interpolates; they are there for numbers, without NaN. Ranks are found by
    refinement and distinct values are counted in long form, so no task holds a column; ``sketches`` estimates both in one
    pass. ``df`` is read several times.
    """
    numeric = pick(df, "numeric")
    clean = df.select(*[F.when(~F.isnan(col(n).cast("double")), col(n)).alias(n) for n in numeric])
    names = ("q1", "median", "q3")
    picks = {f"{k}_{i}": Pick(n, q, m) for i, n in enumerate(numeric) for k, q, m in zip(names, (0.25, 0.5, 0.75), ("nearest", "linear", "nearest"), strict=True)}
    out = profile(df).join(distinct_counts(df, [n for n, kind in df.dtypes if "<" not in kind]), "column", "left")
    if not numeric:
        return out.withColumns({n: F.lit(None).cast("double") for n in names})
    found = refined_quantiles(clean, None, picks)
    each = [F.struct(F.lit(n).alias("column"), *[col(f"{k}_{i}").cast("double").alias(k) for k in names]) for i, n in enumerate(numeric)]
    return out.join(found.select(F.inline(F.array(*each))), "column", "left").withColumn("distinct", F.coalesce("distinct", F.lit(0)))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows, or all if there are fewer: those with the smallest MD5 of seed and ``key``, which has to be unique.

    Every run takes the same rows, whatever the partitions; each task passes on ``n`` rows at most.
    """
    return df.orderBy(F.md5(F.concat_ws("-", F.lit(str(seed)), col(key).cast("string"))), col(key)).limit(n)


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Random rows, each kept with the same chance."""
    return df.sample(fraction=fraction, seed=seed)
