"""Turning raw cells into typed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartframes.columns import Name, col


# fixed values: unsigned types, the signed type that holds them, and their largest number
UNSIGNED = {"uint8": ("smallint", 255), "uint16": ("int", 65535), "uint32": ("bigint", 4294967295)}


def strict_cast(value: Name, kind: str) -> Column:
    """Cast that fails the job on a bad cell, whatever the session's ANSI setting is.

    Besides Spark's types, ``kind`` may be uint8, uint16 or uint32: the next wider signed type,
    holding no number outside the unsigned range.
    """
    value = col(value)
    cast = safe_cast(value, kind)
    message = F.concat(F.lit(f"cannot cast to {kind}: "), value.cast("string"))
    return F.when(value.isNull() | cast.isNotNull(), cast).otherwise(F.raise_error(message))


def safe_cast(value: Name, kind: str) -> Column:
    """Cast that gives null on a bad cell; kinds as for ``strict_cast``."""
    if kind not in UNSIGNED:
        return col(value).try_cast(kind)
    wider, top = UNSIGNED[kind]
    number = col(value).try_cast(wider)
    return F.when(number.between(0, top), number)


def checked_label(value: Name, labels: list[str]) -> Column:
    """The label itself; any value outside the closed set fails the job."""
    value = col(value)
    message = F.concat(F.lit("not one of the labels: "), value)
    return F.when(value.isNull() | value.isin(labels), value).otherwise(F.raise_error(message))


def label_violations(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """Values outside the closed set with their counts."""
    outside = ~col(column).isin(labels)
    return df.where(outside).groupBy(col(column)).agg(F.count("*").alias("n"))


def currency(text: Name, scale: float = 1, digits: int | None = None, strict: bool = True) -> Column:
    """``$1,234.50`` to a number, divided by ``scale`` and rounded."""
    plain = F.translate(col(text), "$,", "")
    number = strict_cast(plain, "double") if strict else safe_cast(plain, "double")
    if scale != 1:
        number = number / F.lit(float(scale))
    return number if digits is None else F.round(number, digits)


def number_or(text: Name, markers: dict[str, object], kind: str = "double") -> Column:
    """Number from text in which some marker texts stand for values (or for null)."""
    text = col(text)
    out = F
    for marker, value in markers.items():
        out = out.when(text == marker, F.lit(value).cast(kind))
    number = strict_cast(F.when(~text.isin(list(markers)), text), kind)
    return number if out is F else out.otherwise(number)


def degrees(text: Name) -> Column:
    """``121.8934°W`` to a signed coordinate: south and west are negative."""
    text = col(text)
    number = strict_cast(F.regexp_extract(text, r"^\s*([-+]?[0-9.]+)", 1), "double")
    return F.when(F.upper(text).rlike("[SW]\\s*$"), -number).otherwise(number)
