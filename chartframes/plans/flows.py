"""From-to matrices out of an edge list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col
from chartframes.operators.columns import sort_columns
from chartframes.operators.reshape import pivot_strict
from chartframes.operators.rows import in_roles
from chartframes.operators.skew import attach
from chartframes.session import pin


def flow_edges(edges: DataFrame, src: str, dst: str, weight: str, names: DataFrame | None = None) -> DataFrame:
    """Total weight per (from, to) pair; ``names`` is a table (key, label) applied to both ends."""
    totals = edges.groupBy(col(src).alias("from"), col(dst).alias("to")).agg(F.sum(col(weight)).alias("weight"))
    if names is None:
        return totals
    named = in_roles(totals, names.toDF("key", "label"), "key", {"from": "from_", "to": "to_"})
    return named.groupBy(F.col("from_label").alias("from"), F.col("to_label").alias("to")).agg(
        F.sum("weight").alias("weight")
    )


def _matrix(cells: DataFrame, value: str, values: list | None) -> DataFrame:
    wide = pivot_strict(cells, "from", "to", value, values)
    return sort_columns(wide, left=["from"]).orderBy("from")


def flow_matrix(
    edges: DataFrame, src: str, dst: str, weight: str, names: DataFrame | None = None, values: list | None = None
) -> DataFrame:
    """One row per source and one column per target, both in name order."""
    return _matrix(flow_edges(edges, src, dst, weight, names), "weight", values)


def normalised_flow_matrix(
    edges: DataFrame,
    src: str,
    dst: str,
    weight: str,
    period: str | Column,
    names: DataFrame | None = None,
    values: list | None = None,
) -> DataFrame:
    """The flow matrix with 100 * weight / number of periods the source took part in, cut to whole numbers."""
    by_period = pin(
        edges.groupBy(col(src).alias("from"), col(dst).alias("to"), col(period).alias("__period")).agg(
            F.sum(col(weight)).alias("weight")
        )
    )
    cells = flow_edges(by_period, "from", "to", "weight", names)
    part = by_period.select("from", "__period").distinct()
    if names is not None:
        part = in_roles(part, names.toDF("key", "label"), "key", {"from": "from_"})
        part = part.select(F.col("from_label").alias("from"), "__period").distinct()
    years = part.groupBy("from").agg(F.count("__period").alias("__years"))
    years = years.withColumn("__rows", F.col("__years"))  # a source's cells grow with its years
    scaled = attach(cells, years, "from", "__rows").drop("__rows").withColumn(
        "weight", F.floor(F.try_divide(100 * F.col("weight").cast("double"), F.col("__years")))
    )
    return _matrix(scaled, "weight", values)
