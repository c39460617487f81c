"""Collecting the checks."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Tables:
    """The driver's tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query under ``name`` with its DuckDB statement."""

    def register(query):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = query
        if sql is not None:
            _ORACLES[name] = sql
        return query

    return register


def _run(query, spark: SparkSession, folder: str) -> DataFrame:
    return query(Tables(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(_run, query) for name, query in sorted(_QUERIES.items())}


def oracles() -> dict[str, str]:
    return dict(sorted(_ORACLES.items()))


def keyed(t: Tables, price: int) -> DataFrame:
    """All orders; those up to ``price`` have no customer key, so that customers without a match and null keys occur."""
    return t.orders.withColumn("o_custkey", F.when(F.col("o_totalprice") > price, F.col("o_custkey")))


def cents(name: str | Column) -> Column:
    """Money as an exact decimal, so that the order of addition cannot matter."""
    return (F.col(name) if isinstance(name, str) else name).cast("decimal(18,2)")


def double(*names: str) -> dict[str, Column]:
    """Exact sums as doubles, for ``withColumns``."""
    return {n: F.col(f"`{n}`").cast("double") for n in names}


def rounded(*names: str, digits: int = 6) -> dict[str, Column]:
    """Ratios rounded for comparison, for ``withColumns``."""
    return {n: F.round(F.col(f"`{n}`").cast("double"), digits) for n in names}
