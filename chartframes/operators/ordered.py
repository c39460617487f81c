"""Row numbers, running totals and moving means under an explicit order.

Every function takes ``order_by`` ending in a unique column, as Spark rows have no order of their own.

Each has two ways. While the largest group is counted to fit one task, it is a plain window. Beyond
that the table is sorted by (keys, order), so that a large group is cut into consecutive segments, one
per sort partition; each segment is numbered on its own and shifted by what the segments before it
hold. The sorted rows are checkpointed first: both branches must see the same segments, also when an
executor is lost between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartframes.columns import Name, col, cols, ordering
from chartframes.operators.skew import TASK_ROWS, attach, sized
from chartframes.session import pin

#: bits of ``monotonically_increasing_id`` that number the rows inside a partition
_ROW_BITS = 33


def _partition(keys: list[str]):
    return Window.partitionBy(*[col(k) for k in keys])


def _segments(df: DataFrame, keys: list[str], order_by) -> DataFrame:
    """Rows sorted by keys and order, pinned, with their segment and position."""
    placed = df.sort(*[col(k).asc_nulls_first() for k in keys], *ordering(order_by)).withColumn(
        "__pos", F.monotonically_increasing_id()
    )
    return pin(placed).withColumn("__seg", F.shiftright("__pos", _ROW_BITS))


def _before(segments: DataFrame, keys: list[str], **totals: Column) -> DataFrame:
    """One row per segment of a group: its first position, row count and what precedes it."""
    summary = segments.groupBy(*[col(k) for k in keys], "__seg").agg(
        F.min("__pos").alias("__first"),
        F.count("*").alias("__seg_rows"),
        *[total.alias(name) for name, total in totals.items()],
    )
    earlier = _partition(keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    return summary.withColumns(
        {name: F.coalesce(F.sum(name).over(earlier), F.lit(0)) for name in totals}
    )


def row_number(
    df: DataFrame,
    keys: Name | list[str] | None,
    order_by,
    name: str = "row_number",
    limit: int | None = TASK_ROWS,
) -> DataFrame:
    """Number the rows of each group from 1; for ``limit`` see ``fits_one_task``."""
    keys = cols(keys)
    df, fits = sized(df, keys, limit)
    if fits:
        number = F.row_number().over(_partition(keys).orderBy(*ordering(order_by)))
        return df.withColumn(name, number.cast("bigint"))
    segments = _segments(df, keys, order_by)
    before = _before(segments, keys, __earlier=F.count("*"))
    numbered = attach(segments, before, [*keys, "__seg"], "__seg_rows")
    return numbered.withColumn(
        name, F.col("__pos") - F.col("__first") + F.col("__earlier") + 1
    ).drop("__pos", "__seg", "__first", "__seg_rows", "__earlier")


def running_sum(
    df: DataFrame,
    keys: Name | list[str] | None,
    order_by,
    value: Name,
    name: str = "running_sum",
    limit: int | None = TASK_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the rows of the group up to this one; null where ``value`` is null."""
    keys = cols(keys)
    df = df.withColumn("__summand", col(value))
    kind = df.select(F.sum("__summand")).schema[0].dataType  # of either way
    upto = (Window.unboundedPreceding, Window.currentRow)
    df, fits = sized(df, keys, limit)
    if fits:
        frame = _partition(keys).orderBy(*ordering(order_by)).rowsBetween(*upto)
        total = F.when(F.col("__summand").isNotNull(), F.sum("__summand").over(frame))
        return df.withColumn(name, total.cast(kind)).drop("__summand")
    segments = _segments(df, keys, order_by)
    before = _before(segments, keys, __earlier=F.coalesce(F.sum("__summand"), F.lit(0)))
    frame = _partition([*keys, "__seg"]).orderBy("__pos").rowsBetween(*upto)
    here = F.when(F.col("__summand").isNotNull(), F.sum("__summand").over(frame))
    local = segments.withColumn("__local", here)
    out = attach(local, before.drop("__first"), [*keys, "__seg"], "__seg_rows")
    return out.withColumn(name, (F.col("__local") + F.col("__earlier")).cast(kind)).drop(
        "__summand", "__pos", "__seg", "__local", "__seg_rows", "__earlier"
    )


def numbered_sum(
    df: DataFrame, keys, order_by, value: Name, number: str = "row_number", total: str = "running_sum", limit: int | None = TASK_ROWS
) -> DataFrame:
    """``row_number`` and ``running_sum`` together, from one sort and one join of what precedes a segment."""
    keys = cols(keys)
    df, fits = sized(df, keys, limit)
    if fits:
        return running_sum(row_number(df, keys, order_by, number, None), keys, order_by, value, total, None)
    df = df.withColumn("__summand", col(value))
    kind = df.select(F.sum("__summand")).schema[0].dataType
    segments = _segments(df, keys, order_by)
    before = _before(segments, keys, __rows_before=F.count("*"), __earlier=F.coalesce(F.sum("__summand"), F.lit(0)))
    frame = _partition([*keys, "__seg"]).orderBy("__pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = segments.withColumn("__local", F.when(F.col("__summand").isNotNull(), F.sum("__summand").over(frame)))
    out = attach(local, before, [*keys, "__seg"], "__seg_rows").withColumns(
        {number: F.col("__pos") - F.col("__first") + F.col("__rows_before") + 1, total: (F.col("__local") + F.col("__earlier")).cast(kind)}
    )
    return out.drop("__summand", "__pos", "__seg", "__local", "__first", "__seg_rows", "__rows_before", "__earlier")


def running_count(df: DataFrame, keys, order_by, value: Name, name: str = "running_count", **kw) -> DataFrame:
    """Number of non-null ``value`` up to this row."""
    seen = F.when(col(value).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return running_sum(df, keys, order_by, seen.cast("bigint"), name, **kw)


def _over_recent(df: DataFrame, keys: list[str], order_by, reach: int, limit: int | None, build) -> DataFrame:
    """Apply ``build(window)`` where each row needs at most ``reach`` rows before it.

    A large group is numbered and cut into blocks; the last ``reach`` rows of a block are also copied
    into the next one, so that every block can be windowed alone.
    """
    df, fits = sized(df, keys, limit)
    if fits:
        return df.withColumns(build(_partition(keys).orderBy(*ordering(order_by))))
    size = max(limit or TASK_ROWS, reach + 1)
    numbered = row_number(df, keys, order_by, "__n", 0)
    block = F.floor((F.col("__n") - 1) / size)
    is_tail = F.pmod(F.col("__n") - 1, F.lit(size)) >= size - reach
    copies = F.when(is_tail, F.array(block, block + 1)).otherwise(F.array(block))
    blocks = numbered.withColumn("__own", block).withColumn("__block", F.explode(copies))
    window = _partition([*keys, "__block"]).orderBy("__n")
    out = blocks.withColumns(build(window)).where(F.col("__own") == F.col("__block"))
    return out.drop("__n", "__own", "__block")


def moving_mean(
    df: DataFrame,
    keys,
    order_by,
    value: Name,
    window: int,
    name: str = "moving_mean",
    limit: int | None = TASK_ROWS,
) -> DataFrame:
    """Mean of the last ``window`` rows; null until all of them are there and not null."""
    value = col(value)

    def build(ordered):
        frame = ordered.rowsBetween(1 - window, 0)
        return {name: F.when(F.count(value).over(frame) == window, F.avg(value).over(frame))}

    return _over_recent(df, cols(keys), order_by, window - 1, limit, build)


def lag_diff(
    df: DataFrame, keys, order_by, value: Name, name: str = "diff", n: int = 1, limit: int | None = TASK_ROWS
) -> DataFrame:
    """``value`` minus ``value`` n rows earlier; null for the first n rows of a group."""
    value = col(value)
    return _over_recent(
        df, cols(keys), order_by, n, limit, lambda ordered: {name: value - F.lag(value, n).over(ordered)}
    )


def relative_to_first(df: DataFrame, keys, time: str, value: str, name: str) -> DataFrame:
    """``value`` over the value at the earliest ``time`` of its group."""
    keys = cols(keys)
    base = df.groupBy(*[col(k) for k in keys]).agg(
        F.min_by(col(value), col(time)).alias("__base"), F.count("*").alias("__base_rows")
    )
    out = attach(df, base, keys, "__base_rows")
    return out.withColumn(name, F.try_divide(col(value).cast("double"), F.col("__base").cast("double"))).drop("__base", "__base_rows")


def running_share(
    df: DataFrame, order_by, value: str, name: str = "cum_pct", limit: int | None = TASK_ROWS
) -> DataFrame:
    """Running percentage of the table total. The table is pinned: aggregate it first."""
    df = pin(df)
    total = df.agg(F.sum(col(value)).alias("total")).scalar()
    out = running_sum(df, None, order_by, value, "__running", limit)
    return out.withColumn(name, 100 * F.try_divide(F.col("__running").cast("double"), total.cast("double"))).drop("__running")


def top_n(df: DataFrame, keys, order_by, n: int, rank: str | None = None) -> DataFrame:
    """The first n rows of each group.

    ``row_number() <= n`` lets Spark keep only n rows per group before the shuffle, up to the n of
    ``spark.sql.optimizer.windowGroupLimitThreshold``; a larger n is numbered by ``row_number``.
    """
    rank_name = rank or "__rank"
    pruned = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= pruned:
        number = F.row_number().over(_partition(cols(keys)).orderBy(*ordering(order_by)))
        ranked = df.withColumn(rank_name, number)
    else:
        ranked = row_number(df, keys, order_by, rank_name)
    kept = ranked.where(F.col(rank_name) <= n)
    return kept if rank else kept.drop(rank_name)


def first_row(df: DataFrame, keys, order_by) -> DataFrame:
    """One row per key: the first under ``order_by``."""
    return top_n(df, keys, order_by, 1)


def last_n(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    """The last n rows of the order, in that order. Takes names, since the order is turned round."""
    turned = [
        col(name[1:]).asc_nulls_last() if name.startswith("-") else col(name).desc_nulls_last()
        for name in order_by
    ]
    return df.orderBy(*turned).limit(n).orderBy(*ordering(order_by))


def dense_rank(df: DataFrame, value: str, name: str = "rank", limit: int | None = TASK_ROWS) -> DataFrame:
    """Rank of ``value`` over the whole table, largest first, equal values sharing a rank."""
    values = df.groupBy(col(value)).agg(F.count("*").alias("__value_rows"))
    ranked = row_number(values, None, F.desc_nulls_last(col(value)), name, limit)
    return attach(df, ranked, value, "__value_rows").drop("__value_rows")
