"""Bringing one row per group back onto the rows of the group, whatever the group sizes are.

A window over ``partitionBy(key)`` puts a whole group into one task. A group may hold a third of the
table, so totals, means and quantiles are aggregated with map-side combine and joined back instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chartframes.columns import col, cols
from chartframes.session import pin

#: measured size up to which a pinned side is broadcast
BROADCAST_BYTES = 64 * 1024 * 1024
#: a group holding more than one in HOT_SHARE rows is hot, so there are fewer than HOT_SHARE hot groups
HOT_SHARE = 1_000
#: rows and bytes up to which a whole group may be ordered inside one task
TASK_ROWS = 2_000_000
TASK_BYTES = 256 * 1024 * 1024
#: rows up to which a table without keys may be
KEYLESS_ROWS = 100_000


#: what a column-wise file grows by when its rows are in memory, for a guess of a group's bytes
UNPACKED = 4
#: nodes of a plan that read a table or cut it down, and nothing else
_PLAIN = {"Project", "Filter", "LogicalRelation", "LogicalRDD", "LocalRelation", "DataSourceV2ScanRelation", "Range"}


def largest_group(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest group and bytes of the widest; both are combined before the shuffle.

    Of a plain scan only the key columns are read, and bytes are a guess from the files' sizes. Windows spill, so a
    group that is wider than it seems takes longer but does no harm.
    """
    keys = [col(k) for k in keys]
    known = _scan_bytes(df)
    rows = df.groupBy(*keys).agg(F.count("*").alias("rows"), (F.sum(_row_bytes(df)) if known is None else F.lit(0)).alias("bytes"))
    most, size, total = rows.agg(F.max("rows"), F.max("bytes"), F.sum("rows")).first()
    if known is not None and total:
        size = known * UNPACKED * most // total
    return most or 0, size or 0


def _nodes(plan) -> list:
    children = plan.children()
    return [plan, *[n for i in range(children.size()) for n in _nodes(children.apply(i))]]


def _is_plain(df: DataFrame) -> bool:
    """Whether reading ``df`` again costs no more than reading its files."""
    return all(n.nodeName() in _PLAIN for n in _nodes(df._jdf.queryExecution().optimizedPlan()))


def _scan_bytes(df: DataFrame) -> int | None:
    """Bytes of the files that a plain scan reads, as its plan knows them; None for anything else."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if not _is_plain(df) or not any(n.nodeName() in ("LogicalRelation", "DataSourceV2ScanRelation") for n in _nodes(plan)):
        return None
    return int(str(plan.stats().sizeInBytes()))


def fits_one_task(df: DataFrame, keys: list[str], limit: int | None = TASK_ROWS) -> bool:
    """Whether every group is small enough for a plain window.

    Groups are counted against ``limit`` and measured against ``TASK_BYTES``; None states that they are
    small by nature and 0 that they are not, both without counting. Without keys the whole table is one
    group, for which ``KEYLESS_ROWS`` is enough.
    """
    if not limit:
        return limit is None
    return _fit(*largest_group(df, keys), keys, limit)


def _fit(rows: int, size: int, keys: list[str], limit: int) -> bool:
    return rows <= (limit if keys else min(limit, KEYLESS_ROWS)) and size <= TASK_BYTES


def sized(df: DataFrame, keys: list[str], limit: int | None = TASK_ROWS) -> tuple[DataFrame, bool]:
    """``fits_one_task``, and the table to go on with: ``df`` is computed once.

    A plain scan is counted by its keys. Anything else is pinned, and while it is written a sketch of its most
    frequent keys and its bytes are observed, so there is no second pass. The sketch never counts too few, and too many
    by less than a thousandth of the rows. It names no key at all if none stands out from its error; each then has less than that.
    """
    if not limit or getattr(df, "_pinned", False) or _is_plain(df):
        return df, fits_one_task(df, keys, limit)
    seen = Observation()
    key = F.xxhash64(*[col(k) for k in keys]) if keys else F.lit(0).cast("bigint")
    widest = F.max(_row_bytes(df))
    top = F.expr("approx_top_k(__key, 1, 10000)")
    marked = df.withColumn("__key", key).observe(seen, top.alias("top"), widest.alias("widest"), F.count(F.lit(1)).alias("rows"))
    pinned = pin(marked.drop("__key"))
    found = seen.get
    most = found["top"][0]["count"] if found["top"] else 0
    rows = min(most + found["rows"] // HOT_SHARE, found["rows"])
    # a group of the widest rows is no larger than this; beyond it the groups are measured
    if rows * (found["widest"] or 0) <= TASK_BYTES:
        return pinned, _fit(rows, 0, keys, limit)
    return pinned, fits_one_task(pinned, keys, limit)


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row: the bytes of its texts and binaries, 16 for each element of a flat array and every other column.

    Of other nested columns the size is not known; they count as more than may be broadcast.
    """
    sizes = []
    for n, kind in df.dtypes:
        if kind in ("string", "binary"):
            sizes.append(F.octet_length(col(n)))
        elif kind in ("array<string>", "array<binary>"):
            sizes.append(F.aggregate(col(n), F.lit(0), lambda a, x: a + 16 + F.coalesce(F.octet_length(x), F.lit(0))))
        elif kind.startswith("array<") and "<" not in kind[6:]:
            sizes.append(16 * F.size(col(n)))
        elif "<" in kind or kind == "variant":
            sizes.append(F.lit(BROADCAST_BYTES + 1))
    return reduce(lambda a, b: a + F.coalesce(b, F.lit(0)).cast("bigint"), sizes, F.lit(16 * len(df.columns)).cast("bigint"))


def _matching(df: DataFrame, other: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """``other`` with its keys renamed, and the condition under which null keys match each other."""
    renamed = other.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    pairs = [df[f"`{k}`"].eqNullSafe(renamed[f"`__key_{k}`"]) for k in keys]
    return renamed, reduce(lambda a, b: a & b, pairs)


def _join(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed, condition = _matching(df, other, keys)
    return df.join(renamed, condition, how).drop(*[f"__key_{k}" for k in keys])


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: str | list[str],
    rows: str,
    how: str = "left",
    limit: int | None = None,
) -> DataFrame:
    """Join ``stats`` (one row per key, null being a key) to ``df``; ``rows`` counts the rows per key.

    ``stats`` is pinned and measured. While it is small it is broadcast, and ``df`` is not shuffled at
    all. Otherwise the hot keys, fewer than ``HOT_SHARE`` by definition, are broadcast to their rows
    and only the remaining rows are shuffled on the key.
    """
    keys = cols(keys)
    stats = pin(stats)
    if not keys:
        return _with_scalars(df, stats)
    size, total = stats.agg(F.sum(_row_bytes(stats)), F.sum(rows)).first()
    if (size or 0) <= (BROADCAST_BYTES if limit is None else limit):
        return _join(df, F.broadcast(stats), keys, how)
    hot = stats.where(col(rows) * HOT_SHARE > F.lit(total))
    hot_rows = _join(df, F.broadcast(hot), keys, "inner")
    hot_keys = F.broadcast(hot.select(*[col(k) for k in keys]))
    cold_rows = _join(_join(df, hot_keys, keys, "left_anti"), stats, keys, how)
    return hot_rows.unionByName(cold_rows)


def _with_scalars(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Statistics of the whole table are one row: put them on every row as scalar subqueries."""
    return df.withColumns({name: stats.select(col(name)).scalar() for name in stats.columns})


def join_split(df: DataFrame, table: DataFrame, keys: str | list[str], how: str = "left", limit: int | None = None) -> DataFrame:
    """Left or inner join of ``df`` with a large ``table`` on keys that few values may dominate.

    The keys of ``df`` are counted first. Without hot ones it is a plain join. Otherwise the rows of
    ``table`` with a hot key are pinned, measured and broadcast to their rows of ``df``, rows of
    ``df`` without a key are set aside, and only the others are shuffled on the key. Should the rows
    of ``table`` with a hot key be too many to broadcast, the hot rows of ``df`` are dealt by a hash of the whole
    row into as many parts as the counts ask for, and the rows of ``table`` they need are copied to each part.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"cannot split a {how} join")
    keys = cols(keys)
    missing = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
    counts = pin(df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("__key_rows")))
    total = counts.agg(F.sum("__key_rows")).first()[0] or 0
    hot = counts.where(F.col("__key_rows") * HOT_SHARE > F.lit(total)).drop("__key_rows")
    if hot.isEmpty():
        return df.join(table, keys, how)
    hot = F.broadcast(hot)
    few = pin(table.join(hot, keys, "left_semi"))
    size = few.agg(F.sum(_row_bytes(few))).first()[0] or 0
    known = df.where(~missing)
    hot_rows = known.join(hot, keys, "left_semi")
    if size <= (BROADCAST_BYTES if limit is None else limit):
        met = hot_rows.join(F.broadcast(few), keys, how)
    else:
        largest = counts.agg(F.max("__key_rows")).first()[0]
        # a part is no larger than a key that is not hot, so there are HOT_SHARE parts at most
        salts = max(-(-largest * HOT_SHARE // total), 2)
        dealt = hot_rows.withColumn("__salt", F.pmod(F.xxhash64(*[col(c) for c in df.columns]), F.lit(salts)).cast("int"))
        copied = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = dealt.join(copied.hint("shuffle_merge"), [*keys, "__salt"], how).drop("__salt")
    parts = [
        met,
        known.join(hot, keys, "left_anti").join(table, keys, how),
    ]
    if how == "left":
        parts.append(df.where(missing).join(F.broadcast(few.limit(0)), keys, how))
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_group_values(df: DataFrame, keys: str | list[str], **values: Column) -> DataFrame:
    """Aggregates of each group on each of its rows: ``with_group_values(df, "k", total=F.sum("x"))``."""
    keys = cols(keys)
    stats = df.groupBy(*[col(k) for k in keys]).agg(
        *[value.alias(name) for name, value in values.items()], F.count("*").alias("__group_rows")
    )
    return attach(df, stats, keys, "__group_rows").drop("__group_rows")


def share_of_group(df: DataFrame, keys: str | list[str], value: str, name: str) -> DataFrame:
    """``value`` as a fraction of its group total; null where the total is zero."""
    out = with_group_values(df, keys, __group_total=F.sum(col(value)))
    return out.withColumn(name, F.try_divide(col(value).cast("double"), F.col("__group_total").cast("double"))).drop("__group_total")
