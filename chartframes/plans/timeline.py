"""Grouped timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col
from chartframes.functions.text import zero_pad
from chartframes.operators.columns import select
from chartframes.operators.ordered import row_number
from chartframes.operators.skew import TASK_ROWS, attach
from chartframes.session import pin


def timeline(
    df: DataFrame,
    group: str,
    item: str,
    start: str,
    end: str,
    min_years: int,
    carry: dict[str, str] | None = None,
) -> DataFrame:
    """A header row per group, spanning all of its items, above the items in order of their start.

    Groups are numbered by name and items within them, as ``group.item`` with two digits or more for
    the item. Rows shorter than ``min_years`` are dropped after the numbering, so numbers may have
    gaps; groups left with their header alone are dropped. Ties in ``start`` go by item name.
    ``carry`` names further text columns with what to show where they are null; headers have them blank.
    """
    carry = carry or {}
    items = df.select(
        col(group).alias("group"),
        col(item).alias("item"),
        col(start).alias("start"),
        col(end).alias("end"),
        *[F.coalesce(col(n), F.lit(missing)).alias(n) for n, missing in carry.items()],
    )
    years = F.year("end") - F.year("start")
    spans = items.groupBy("group").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.max(years).alias("__longest"),
        F.count("*").alias("__rows"),
    )
    headers = pin(row_number(pin(spans), None, "group", "group_num"))
    largest = headers.agg(F.max("__rows")).first()[0] or 0  # groups are counted already
    numbered = attach(items, pin(headers.select("group", "group_num", "__rows")), "group", "__rows")
    numbered = row_number(numbered, "group", ["start", "item"], "item_num", None if largest <= TASK_ROWS else 0)
    heads = headers.where(F.col("__longest") >= min_years).withColumns(
        {"item": F.concat(F.lit("<b>"), F.upper("group"), F.lit("</b>")), "item_num": F.lit(0)}
        | {n: F.lit("") for n in carry}
    )
    names = ["group", "group_num", "item_num", "item", "start", "end", *carry]
    rows = select(heads, names).unionByName(select(numbered, names))
    number = F.concat(F.col("group_num").cast("string"), F.lit("."), zero_pad("item_num", 2))
    label = F.concat(F.lit("  "), number, F.lit(": "), F.col("item"))
    return rows.withColumns({"duration_years": years, "label": label}).where(F.col("duration_years") >= min_years)
