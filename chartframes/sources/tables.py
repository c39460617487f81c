"""Small literal tables. Built from Arrow, they are local relations whose size Catalyst knows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from chartframes.columns import col

# fixed values: weekday names in calendar order, Sunday first
WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def literal_table(spark: SparkSession, columns: dict[str, list], schema: T.StructType | None = None) -> DataFrame:
    """Table from a dictionary of columns."""
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema) if schema else None))


def mapping_table(spark: SparkSession, mapping: dict, key: str = "key", value: str = "value") -> DataFrame:
    """Two-column table of a dictionary."""
    return literal_table(spark, {key: list(mapping), value: list(mapping.values())})


def weekdays(spark: SparkSession, first: int = 1) -> DataFrame:
    """``day_name`` and ``day_num``, numbered from ``first`` on Sunday."""
    numbers = [first + i for i in range(7)]
    return literal_table(spark, {"day_name": WEEKDAYS, "day_num": numbers})


def unpack_list(df: DataFrame, column: str, kinds: dict[str, str]) -> DataFrame:
    """Turn a list column of texts into one typed column per entry of ``kinds``."""
    parts = {n: F.get(col(column), F.lit(i)).cast(kind) for i, (n, kind) in enumerate(kinds.items())}
    return df.withColumns(parts).drop(column)
