"""Types of text columns, inferred from every cell in one pass.

A cell fits a set of types, which is a number with one bit for each; a column fits what all its cells fit. So
the result for several files is the bitwise AND of theirs, and files can be looked at one by one.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartframes.columns import col
from chartframes.sources.files import read_csv

#: Types by bit, narrow ones first: a whole number is also a number, a date is also a time.
LATTICE = ("boolean", "bigint", "double", "date", "timestamp")
_ALL = (1 << len(LATTICE)) - 1
# fixed values: how a cell of each type is written
_WRITTEN = {
    "boolean": r"(?i)^(true|false)$",
    "bigint": r"^[+-]?\d{1,19}$",
    "double": r"(?i)^[+-]?(\d+\.?\d*([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity|nan)$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$",
}


def fits(cell: Column) -> Column:
    """The types a text may be read as, as bits of a number; null for null and empty cells, which fit any."""
    parts = [F.when(cell.rlike(_WRITTEN[kind]) & cell.try_cast(kind).isNotNull(), 1 << i).otherwise(0) for i, kind in enumerate(LATTICE)]
    return F.when(F.length(cell) > 0, reduce(lambda a, b: a.bitwiseOR(b), parts))


def type_masks(text: DataFrame) -> DataFrame:
    """One row (column, position, mask, cells, rows) per text column, from one pass; ``merge_masks`` puts several together."""
    one = [
        F.struct(
            F.lit(name).alias("column"), F.lit(i).alias("position"), F.coalesce(F.bit_and(fits(col(name))), F.lit(_ALL)).alias("mask"),
            F.count(F.when(F.length(col(name)) > 0, 1)).alias("cells"), F.count("*").alias("rows"),
        )
        for i, name in enumerate(text.columns)
    ]
    return text.agg(F.array(*one).alias("all")).select(F.inline("all"))


def merge_masks(parts: Iterable[DataFrame]) -> DataFrame:
    """The masks of all parts together, by name of the column; a column that a part lacks fits any type there."""
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    return stacked.groupBy("column").agg(F.min("position").alias("position"), F.bit_and("mask").alias("mask"), F.sum("cells").alias("cells"), F.sum("rows").alias("rows"))


def inferred_types(masks: DataFrame) -> DataFrame:
    """One row (column, type, cells, rows): the narrowest type that fits all cells of a column.

    That is ``string`` if none does, or if the column has no cells.
    """
    kind = reduce(lambda out, i: F.when(F.col("mask").bitwiseAND(1 << i) != 0, LATTICE[i]).otherwise(out), reversed(range(len(LATTICE))), F.lit("string"))
    kind = F.when(F.col("cells") > 0, kind).otherwise("string")
    return masks.select("column", "position", kind.alias("type"), "cells", "rows")


def infer_types(text: DataFrame) -> DataFrame:
    """One row (column, type, cells, rows) per column of texts, from one pass over all cells."""
    return inferred_types(type_masks(text)).drop("position")


def as_inferred(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """``text`` with its columns read as ``types``; empty cells of other types than text become null."""
    return text.select(*[F.when(F.length(col(n)) > 0, col(n).cast(types[n])).alias(n) if types.get(n, "string") != "string" else col(n) for n in text.columns])


def read_inferred(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV with a header line, each column in the narrowest type that fits all of its cells.

    All cells are looked at, so there is no later cell that does not parse; it takes a pass over the files
    besides the one that reads them. Only the columns' types reach the driver.
    """
    text = read_csv(spark, path, **options)
    types = {r["column"]: r["type"] for r in inferred_types(type_masks(text)).collect()}
    return as_inferred(text, types)
