"""Exact quantiles by refinement: histograms of order-preserving codes, narrowed to the bins that hold the wanted ranks.

Counting every distinct (group, value) shuffles nearly every row of a continuous measure. Here a scan
counts values by the leading bits of their code, so what is shuffled is a few thousand counts per
task; the next scan looks inside the bins that hold a wanted rank only. It is the way for few groups and many
distinct values; for many small groups ``group_quantiles`` needs one scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartframes.columns import Name, col, cols
from chartframes.operators.skew import _matching, attach
from chartframes.session import pin

#: Bits that one scan looks at: a task passes on no more than 2 ** BITS counts per group, column and wanted bin.
BITS = 12
_NAN = (1 << 63) - 1
_LEAST_NORMAL = -1022


@dataclass(frozen=True)
class Pick:
    """A wanted quantile of a column: ``nearest`` is the element at index floor(q * (n - 1) + 0.5), ``linear`` interpolates."""

    column: str
    q: float
    method: str = "nearest"


def _power(e: Column) -> Column:
    """2 ** e for a whole number, exactly."""
    return F.pow(F.lit(2.0), e.cast("double"))


def with_double_codes(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """``df`` with a column of whole numbers in the order of a column of doubles, for each entry (code: column) of ``names``.

    Codes are the numbers' bit patterns: 0 for both zeros, NaN above all. Every step is a projection of its own, for
    none of them is to be computed more than once.
    """
    x = {n: col(v) for n, v in names.items()}
    part = lambda n, k: F.col(f"__{k}_{n}")
    df = df.withColumns({f"__size_{n}": F.abs(v) for n, v in x.items()})
    # the logarithm is rounded, so its whole part may be one off
    df = df.withColumns({f"__guess_{n}": F.greatest(F.least(F.floor(F.log2(part(n, "size"))), F.lit(1023)), F.lit(_LEAST_NORMAL)).cast("int") for n in x})
    df = df.withColumns({f"__power_{n}": _power(part(n, "guess")) for n in x})
    up = {n: (part(n, "size") / 2 >= part(n, "power")) & (part(n, "guess") < 1023) for n in x}
    down = {n: (part(n, "size") < part(n, "power")) & (part(n, "guess") > _LEAST_NORMAL) for n in x}
    df = df.withColumns(
        {f"__e_{n}": part(n, "guess") + F.when(up[n], 1).when(down[n], -1).otherwise(0) for n in x}
        | {f"__share_{n}": part(n, "size") / part(n, "power") * F.when(up[n], 0.5).when(down[n], 2.0).otherwise(1.0) for n in x}
    )
    # numbers below the least normal one share its exponent and have no leading bit
    code = {n: (part(n, "e") - _LEAST_NORMAL).cast("bigint") * F.lit(1 << 52) + (part(n, "share") * F.lit(2.0**52)).try_cast("bigint") for n in x}
    finite = {n: F.when(part(n, "size") < float("inf"), part(n, "e")).isNotNull() for n in x}
    df = df.withColumns({f"__code_{n}": F.when(finite[n], code[n]).when(F.isnan(v), F.lit(_NAN)).when(v.isNotNull(), F.lit(2047 << 52)) for n, v in x.items()})
    signed = {n: F.when((v < 0) & (part(n, "size") > 0), -part(n, "code")).when(v == 0, F.lit(0)).otherwise(part(n, "code")) for n, v in x.items()}
    df = df.withColumns({n: v.cast("bigint") for n, v in signed.items()})
    return df.drop(*[f"__{k}_{n}" for n in x for k in ("size", "guess", "power", "e", "share", "code")])


def double_of(code: Column) -> Column:
    """The double that has a code."""
    size = F.abs(code)
    exponent = F.shiftright(size, 52).cast("int")
    share = (size % F.lit(1 << 52)).cast("double") * F.lit(2.0**-52)
    normal = _power(exponent + F.lit(_LEAST_NORMAL - 1)) * (share + 1)
    x = F.when(exponent == 0, share * F.lit(2.0**_LEAST_NORMAL)).when(exponent == 2047, F.lit(float("inf"))).otherwise(normal)
    return F.when(code == _NAN, F.lit(float("nan"))).when(code < 0, -x).otherwise(x)


def _code(x: Column, kind: str) -> Column:
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return x.cast("bigint")
    if kind == "date":
        return F.unix_date(x).cast("bigint")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(x.cast("timestamp"))
    if kind.startswith("decimal(") and int(kind[8:].split(",")[0]) <= 18:
        scale = int(kind[:-1].split(",")[1])
        return (x * F.lit(10**scale)).cast("bigint")
    if kind in ("float", "double"):
        return x.cast("double")  # which gets a code later
    raise TypeError(f"no quantiles of {kind} by refinement")


def _value(code: Column, kind: str) -> Column:
    if kind == "date":
        return F.date_from_unix_date(code.cast("int"))
    if kind in ("timestamp", "timestamp_ntz"):
        return F.timestamp_micros(code).cast(kind)
    if kind.startswith("decimal("):
        scale = int(kind[:-1].split(",")[1])
        return (code.cast("decimal(38,0)") / F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast(kind)
    return double_of(code).cast(kind) if kind in ("float", "double") else code.cast(kind)


def refined_quantiles(df: DataFrame, keys: Name | list[str] | None, picks: dict[str, Pick], count: str | None = None, bits: int = BITS) -> DataFrame:
    """One row per group with a column per entry of ``picks``; nulls are ignored, null keys are a group of their own.

    ``nearest`` gives an element in the column's own type, ``linear`` a double. ``count`` names a column for the group's rows.
    Whole numbers, decimals of up to 18 digits, floats, dates and times can be picked from; NaN is the largest number. ``df``
    is read once for the extents and once for every ``bits`` bits in which codes of a group still differ, usually
    two or three times: pin it if it is not a plain scan. A group without values has nulls. Nothing but counts and the
    ends of bins is shuffled.
    """
    keys = cols(keys)
    kinds = dict(df.dtypes)
    names = list(dict.fromkeys(p.column for p in picks.values()))
    group = [col(k) for k in keys]
    real = {f"__c{i}": f"__c{i}" for i, n in enumerate(names) if kinds[n] in ("float", "double")}
    codes = df.select(*group, *[_code(col(n), kinds[n]).alias(f"__c{i}") for i, n in enumerate(names)])
    codes = with_double_codes(codes, real) if real else codes

    extents = codes.groupBy(*group).agg(
        F.count("*").alias("__rows"),
        *[f(f"__c{i}").alias(f"__{f.__name__}{i}") for i in range(len(names)) for f in (F.count, F.min, F.max)],
    )
    extents = pin(extents)
    wanted = []
    for j, p in enumerate(picks.values()):
        i = names.index(p.column)
        place = F.lit(float(p.q)) * (F.col(f"__count{i}") - 1)
        ranks = {"nearest": [F.floor(place + 0.5)], "linear": [F.floor(place), F.ceil(place)]}.get(p.method)
        if ranks is None:
            raise ValueError(f"unknown quantile method {p.method!r}")
        wanted += [
            F.struct(
                F.lit(i).alias("__column"), F.lit(j).alias("__pick"), F.lit(side).alias("__side"), r.cast("bigint").alias("__rank"),
                (place - F.floor(place)).alias("__share"), F.col(f"__min{i}").alias("__low"), F.col(f"__max{i}").alias("__high"),
            )
            for side, r in enumerate(ranks)
        ]
    todo = extents.select(*group, "__rows", F.inline(F.array(*wanted))).where("__low IS NOT NULL")
    todo = pin(todo.withColumn("__prefix", F.lit(0).cast("bigint")))
    place = [*keys, "__column", "__prefix"]
    at = [col(k) for k in place]
    each = F.inline(F.array(*[F.struct(F.lit(i).alias("__column"), F.col(f"__c{i}").alias("__code")) for i in range(len(names))]))
    settled = [todo.where("__low = __high")]
    shift = 64
    while True:
        # the bits above the first one in which the ends of some bin differ need no look
        differ = todo.agg(F.bit_or(F.col("__low").bitwiseXOR(F.col("__high")))).first()[0]
        if not differ:
            break
        last, shift = shift, max((differ & ((1 << 64) - 1)).bit_length() - bits, 0)
        open_ = todo.where("__low < __high")
        bins = open_.groupBy(*at).agg(F.max("__rows").alias("__rows"))
        long = codes.select(*group, each).where("__code IS NOT NULL")
        long = long.withColumn("__prefix", F.shiftright("__code", last) if last < 64 else F.lit(0).cast("bigint"))
        inside = attach(long, bins, place, "__rows", "inner")
        counted = inside.groupBy(*at, F.shiftright("__code", shift).alias("__bin")).agg(
            F.count("*").alias("__n"), F.min("__code").alias("__bin_low"), F.max("__code").alias("__bin_high")
        )
        upto = Window.partitionBy(*at).orderBy("__bin")  # 2 ** bits bins at most
        counted, same = _matching(open_, counted.withColumn("__upto", F.sum("__n").over(upto)), place)
        before = F.col("__upto") - F.col("__n")
        met = open_.join(counted, same & (F.col("__rank") >= before) & (F.col("__rank") < F.col("__upto")))
        todo = pin(
            met.select(
                *[open_[f"`{k}`"].alias(k) for k in keys], "__rows", "__column", "__pick", "__side", (F.col("__rank") - before).alias("__rank"),
                "__share", F.col("__bin_low").alias("__low"), F.col("__bin_high").alias("__high"), F.col("__bin").alias("__prefix"),
            )
        )
        settled.append(todo.where("__low = __high"))
    out = []
    for j, (name, p) in enumerate(picks.items()):
        low, high = (_value(F.max(F.when((F.col("__pick") == j) & (F.col("__side") == side), F.col("__low"))), kinds[p.column]) for side in range(2))
        if p.method == "linear":
            low, high = low.cast("double"), high.cast("double")
            low = F.when(low == high, low).otherwise(low + (high - low) * F.max(F.when(F.col("__pick") == j, F.col("__share"))))
        out.append(low.alias(name))
    found = reduce(lambda a, b: a.unionByName(b), settled).groupBy(*group).agg(*out, F.max("__rows").alias("__n"))
    everyone = extents.select(*group, F.col("__rows").alias(count) if count else F.col("__rows"))
    whole = attach(everyone, found, keys, "__n").drop("__n")
    return whole.select(*group, *[col(n) for n in picks], *([col(count)] if count else []))


def refined_medians(df: DataFrame, keys, names: list[str]) -> DataFrame:
    """Interpolated medians of several columns per group, under the columns' names."""
    return refined_quantiles(df, keys, {n: Pick(n, 0.5, "linear") for n in cols(names)})
