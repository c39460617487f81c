"""Stacking, membership, lookups and one-row-per-key verbs.

Joins carry no broadcast hint: Catalyst broadcasts a side whose size it knows to be small, and AQE
looks again at run time and splits skewed partitions of the other joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartframes.columns import col, cols
from chartframes.operators.skew import attach, join_split
from chartframes.sources.tables import literal_table, mapping_table


def stack(*tables: DataFrame) -> DataFrame:
    """Union by name, keeping duplicates; a missing column is an error."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def stack_tagged(tables: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of tables, each marked with its label in the column ``tag``."""
    return stack(*[table.withColumn(tag, F.lit(label)) for label, table in tables.items()])


def align_frames(frames: dict[str, DataFrame], on: str | list[str]) -> DataFrame:
    """Several tables side by side: one row per label ``on`` that any of them has, null being a label too.

    The other columns are called ``frame column`` with the frame's name in ``frames``, and are null where the frame lacks the
    label. A label that a frame has twice fails the job. The tables are stacked and aggregated by label, so that n tables
    take one shuffle instead of n - 1 outer joins with its own each.
    """
    keys = cols(on)
    parts, seen = [], {}
    for i, (name, frame) in enumerate(frames.items()):
        others = [c for c in frame.columns if c not in keys]
        seen[i] = {c: f"{name} {c}" for c in others}
        row = F.struct(F.lit(True).alias("there"), *[col(c) for c in others])
        parts.append(frame.select(*[col(k) for k in keys], row.alias(f"__{i}")))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = [F.first(f"__{i}", ignorenulls=True).alias(f"__{i}") for i in seen]
    met = stacked.groupBy(*[col(k) for k in keys]).agg(*one, *[F.count(f"__{i}").alias(f"__n{i}") for i in seen])
    twice = reduce(lambda a, b: a | b, [F.col(f"__n{i}") > 1 for i in seen])
    met = met.where(F.when(twice, F.raise_error(F.lit("align: a frame has a label twice")).cast("boolean")).otherwise(True))
    return met.select(*[col(k) for k in keys], *[F.col(f"__{i}")[c].alias(name) for i, names in seen.items() for c, name in names.items()])


def add_row(df: DataFrame, **values: object) -> DataFrame:
    """Append one literal row; columns left out are null."""
    row = {f.name: [values.get(f.name)] for f in df.schema.fields}
    extra = literal_table(df.sparkSession, row, df.schema)
    return df.unionByName(extra)


def with_total_row(df: DataFrame, label: str, text: str = "Total") -> DataFrame:
    """Append a row with the sums of the numeric columns; ``label`` names it, other columns are null."""
    sums = []
    for f in df.schema.fields:
        if f.name == label:
            sums.append(F.lit(text).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            sums.append(F.coalesce(F.sum(col(f.name)), F.lit(0)).alias(f.name))
        else:
            sums.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.unionByName(df.agg(*sums))


def lookup(
    df: DataFrame, table: DataFrame, on: str | list[str], how: str = "left", split_hot: bool = False
) -> DataFrame:
    """Equi-join with a table of names, codes or coordinates; null keys never match.

    ``split_hot`` is for a table too large to broadcast, joined on a key that few values dominate.
    """
    return join_split(df, table, on, how) if split_hot else df.join(table, on, how)


def in_roles(df: DataFrame, table: DataFrame, key: str, roles: dict[str, str], how: str = "left") -> DataFrame:
    """Join the same table once per role: ``roles`` maps a key column of ``df`` to a column prefix."""
    for column, prefix in roles.items():
        renamed = table.withColumnsRenamed(
            {n: column if n == key else f"{prefix}{n}" for n in table.columns}
        )
        df = df.join(renamed, column, how)
    return df


def recode(df: DataFrame, column: str, mapping: dict[str, object] | DataFrame, name: str | None = None) -> DataFrame:
    """Map values by a dictionary or a (key, value) table; a value may be null, unmatched ones stay as they are.

    A key that is twice in the table fails the job.
    """
    table = mapping if isinstance(mapping, DataFrame) else mapping_table(df.sparkSession, mapping)
    table = table.toDF("__from", "__to").where("__from IS NOT NULL")
    if isinstance(mapping, DataFrame):
        twice = F.raise_error(F.lit("recode: a key is twice in the table"))
        table = table.groupBy("__from").agg(F.when(F.count("*") == 1, F.first("__to")).otherwise(twice).alias("__to"))
    table = table.withColumn("__met", F.lit(True))
    joined = df.join(table, col(column) == F.col("__from"), "left")
    mapped = F.when(F.col("__met"), F.col("__to")).otherwise(col(column))
    return joined.withColumn(name or column, mapped).drop("__from", "__to", "__met")


def members(df: DataFrame, keys: str | list[str], of: DataFrame) -> DataFrame:
    """Rows whose key occurs in ``of``."""
    return df.join(of.select(*[col(k) for k in cols(keys)]), cols(keys), "left_semi")


def in_groups(df: DataFrame, keys: str | list[str], test: Column) -> DataFrame:
    """Rows of the groups for which an aggregate test holds, such as ``F.count("*") >= 1000``."""
    keys = cols(keys)
    groups = df.groupBy(*[col(k) for k in keys]).agg(test.alias("__keep"), F.count("*").alias("__rows"))
    kept = groups.where("__keep").dropna(subset=keys).drop("__keep")
    return attach(df, kept, keys, "__rows", "inner").drop("__rows")


def distinct_rows(df: DataFrame, *names: str) -> DataFrame:
    return (df.select(*[col(n) for n in names]) if names else df).distinct()
