"""Long to wide and back. Work in long form; pivot at the output edge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartframes.columns import col, cols
from chartframes.operators.ordered import row_number
from chartframes.operators.skew import attach
from chartframes.session import pin


#: name of the column for rows whose pivot key is null
NULL_NAME = "null"


def pivot_values(df: DataFrame, on: str) -> list:
    """Distinct values of ``on``, sorted, null last. They become columns, so the number is limited by the session."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = [r.v for r in df.select(col(on).alias("v")).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{on} has more than {limit} values; keep the long form")
    known = sorted(v for v in found if v is not None)
    return known + [None] * (None in found)


def _names(values: list) -> list[str]:
    """Column names of pivot values, as a cast to text gives them."""
    names = [NULL_NAME if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in values]
    if len(set(names)) < len(names):
        raise ValueError(f"two pivot values have the same name among {names}")
    return names


def _pivot(df: DataFrame, index: list[str], on: str, cell: Column, values: list | None, others: str) -> DataFrame:
    """Cells first, one per (index, on), combined before the shuffle; then a column for each value.

    Without ``values`` the cells are pinned, and the values are read from them, so ``df`` is computed once.
    Values outside a given list fail the job, unless ``others`` is "drop".
    """
    if others not in ("fail", "drop"):
        raise ValueError("others is 'fail' or 'drop'")
    cells = df.groupBy(*[col(i) for i in index], col(on).alias("__on")).agg(cell.alias("__cell"))
    if values is None:
        cells = pin(cells)
        values = pivot_values(cells, "__on")
    names = _names(values)
    name = F.coalesce(F.col("__on").cast("string"), F.lit(NULL_NAME))
    if others == "drop":
        cells = cells.where(name.isin(names))
    else:
        message = F.concat(F.lit(f"pivot: a value of {on} that is not in the list: "), name)
        name = F.when(name.isin(names), name).otherwise(F.raise_error(message))
    cells = cells.withColumn("__on", name)
    return cells.groupBy(*[col(i) for i in index]).pivot("__on", names).agg(F.first("__cell"))


def pivot_strict(df: DataFrame, index, on: str, value: str, values: list | None = None, others: str = "fail") -> DataFrame:
    """One cell per (index, on) pair; a pair occurring twice fails the job. A null ``on`` is a column of its own."""
    twice = F.raise_error(F.lit(f"pivot: more than one row for a cell of {on}"))
    cell = F.when(F.count("*") == 1, F.first(col(value))).otherwise(twice)
    return _pivot(df, cols(index), on, cell, values, others)


def pivot_sum(df: DataFrame, index, on: str, value: str, values: list | None = None, others: str = "fail") -> DataFrame:
    """Sum per cell; absent cells are null. A null ``on`` is a column of its own."""
    return _pivot(df, cols(index), on, F.sum(col(value)), values, others)


def pivot_count(df: DataFrame, index, on: str, values: list | None = None, others: str = "fail") -> DataFrame:
    """Rows per cell; absent cells are null. A null ``on`` is a column of its own."""
    return _pivot(df, cols(index), on, F.count(F.lit(1)), values, others)


def unpivot(df: DataFrame, ids, values: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(cols(ids), values, variable, value)


def transpose(df: DataFrame, names: str, header: str = "column", labels: list | None = None) -> DataFrame:
    """Rows become columns named by ``names``; the old column names go to ``header``.

    Unpivot and pivot, so the rows are limited by the number of columns a table may have.
    """
    values = [c for c in df.columns if c != names]
    long = unpivot(df, names, values, header, "__cell")
    return pivot_strict(long, header, names, "__cell", labels)


#: Columns of a sparse pivot that one row holds at most.
BLOCK = 10_000


@dataclass(frozen=True)
class SparsePivot:
    """A pivot with any number of columns: their dictionary, and rows of the cells that are there.

    ``columns`` is (number, value): the pivot's columns in order, null last, numbered from 0. ``rows`` is the index, ``block``, and two
    arrays of equal length, ``numbers`` in ascending order and ``cells``; block b has the columns from b * size up to
    the next block, so no row outgrows ``size`` cells, however many columns there are.
    """

    columns: DataFrame
    rows: DataFrame
    index: tuple[str, ...]
    on: str
    size: int

    def long(self, cell: str = "cell") -> DataFrame:
        """One row (index, on, cell) per cell that is there."""
        each = self.rows.select(*[col(i) for i in self.index], F.inline(F.arrays_zip("numbers", "cells")))
        named = self.columns.select(F.col("number").alias("numbers"), F.col("value").alias(self.on))
        return each.join(named, "numbers").select(*[col(i) for i in self.index], col(self.on), F.col("cells").alias(cell))

    def wide(self, values: list) -> DataFrame:
        """The index and a column for each of some values, null where there is no cell; only their blocks are read.

        The values' numbers reach the driver. Index rows without any of these cells are left out.
        """
        same = self.columns.where(F.col("value").isin([v for v in values if v is not None]) | (F.col("value").isNull() if None in values else F.lit(False)))
        number = {r["value"]: r["number"] for r in same.collect()}
        missing = [v for v in values if v not in number]
        if missing:
            raise ValueError(f"no columns of {self.on}: {missing}")
        near = self.rows.where(F.col("block").isin(sorted({n // self.size for n in number.values()})))
        at = {v: F.array_position("numbers", F.lit(n)) for v, n in number.items()}
        cell = lambda v: F.when(at[v] > 0, F.try_element_at("cells", at[v].cast("int")))
        names = _names(values)
        found = near.select(*[col(i) for i in self.index], *[cell(v).alias(n) for v, n in zip(values, names, strict=True)])
        out = found.groupBy(*[col(i) for i in self.index]).agg(*[F.max(col(n)).alias(n) for n in names])
        return out.dropna("all", subset=names)

    def write(self, path: str) -> None:
        """Rows as Parquet in a folder for each block, so that a reader of a few columns opens theirs only; the dictionary beside them."""
        self.columns.write.parquet(f"{path.rstrip('/')}/columns")
        self.rows.write.partitionBy("block").parquet(f"{path.rstrip('/')}/rows")

    @staticmethod
    def read(spark: SparkSession, path: str, index, on: str, size: int = BLOCK) -> SparsePivot:
        rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
        return SparsePivot(spark.read.parquet(f"{path.rstrip('/')}/columns"), rows.withColumn("block", F.col("block").cast("bigint")), tuple(cols(index)), on, size)


def pivot_sparse(df: DataFrame, index, on: str, value: str, size: int = BLOCK) -> SparsePivot:
    """Sum per cell, for more columns than a table may have.

    Cells are combined before the shuffle and pinned; the values of ``on`` are numbered in order and brought to the cells by
    broadcast while they are few, else by a join that splits hot ones. Only the cells that are there are kept. Neither the
    values nor anything else reaches the driver.
    """
    index = cols(index)
    cells = pin(df.groupBy(*[col(i) for i in index], col(on).alias("__on")).agg(F.sum(col(value)).alias("__cell")))
    values = cells.groupBy(F.col("__on").alias("__on")).agg(F.count("*").alias("__cells"))
    numbered = pin(row_number(values, None, F.col("__on").asc_nulls_last(), "__number").withColumn("__number", F.col("__number") - 1))
    placed = attach(cells, numbered, "__on", "__cells").withColumn("block", F.floor(F.col("__number") / size))
    pairs = F.array_sort(F.collect_list(F.struct(F.col("__number").alias("n"), F.col("__cell").alias("c"))))
    rows = placed.groupBy(*[col(i) for i in index], "block").agg(pairs.alias("__pairs"))
    rows = rows.select(*[col(i) for i in index], "block", F.col("__pairs.n").alias("numbers"), F.col("__pairs.c").alias("cells"))
    return SparsePivot(numbered.select(F.col("__number").alias("number"), F.col("__on").alias("value")), rows, tuple(index), on, size)
