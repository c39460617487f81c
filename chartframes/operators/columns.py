"""Choosing, naming and ordering columns. Only the schema is looked at, unless stated otherwise."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartframes.columns import col

_KINDS = {
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "numeric": (T.NumericType,),
    "string": (T.StringType,),
    "temporal": (T.DateType, T.TimestampType, T.TimestampNTZType),
}


def pick(
    df: DataFrame, kind: str | None = None, prefix: str = "", suffix: str = "", exclude: Iterable[str] = ()
) -> list[str]:
    """Names of the columns of a kind (integer, float, numeric, string, temporal) and name pattern."""
    exclude = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if (kind is None or isinstance(f.dataType, _KINDS[kind]))
        and f.name.startswith(prefix)
        and f.name.endswith(suffix)
        and f.name not in exclude
    ]


def select(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Select by plain names."""
    return df.select(*[col(n) for n in names])


def all_except(df: DataFrame, *names: str) -> DataFrame:
    return select(df, [n for n in df.columns if n not in names])


def apply_to(df: DataFrame, names: Iterable[str], function) -> DataFrame:
    """The same expression over several columns."""
    return df.withColumns({n: function(col(n)) for n in names})


def rename(df: DataFrame, names: dict[str, str] | list[str]) -> DataFrame:
    """Rename by mapping, or all columns by position."""
    return df.toDF(*names) if isinstance(names, list) else df.withColumnsRenamed(names)


def sort_columns(df: DataFrame, left: Iterable[str] = (), right: Iterable[str] = ()) -> DataFrame:
    """Columns in name order, with fixed ones at the left and right."""
    left, right = list(left), list(right)
    return select(df, left + sorted(c for c in df.columns if c not in left + right) + right)


def non_null_counts(df: DataFrame, names: Iterable[str] | None = None) -> dict[str, int]:
    """Non-null values per column, from one aggregate over the table."""
    names = list(df.columns if names is None else names)
    row = df.agg(*[F.count(col(n)).alias(str(i)) for i, n in enumerate(names)]).first()
    return dict(zip(names, row))


def drop_empty(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns without any value. Runs one aggregate."""
    keep = set(keep)
    counts = non_null_counts(df)
    return select(df, [n for n in df.columns if n in keep or counts[n] > 0])


def keep_complete(df: DataFrame, n: int, keep: Iterable[str] = ()) -> DataFrame:
    """Keep columns holding exactly ``n`` values. Runs one aggregate."""
    keep = set(keep)
    counts = non_null_counts(df)
    return select(df, [c for c in df.columns if c in keep or counts[c] == n])
