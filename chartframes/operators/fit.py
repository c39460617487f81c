"""Least-squares polynomials, histograms and distributions."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartframes.columns import Name, col, cols
from chartframes.operators.quantiles import quartiles_and_median
from chartframes.operators.selection import Pick, refined_quantiles
from chartframes.operators.skew import attach
from chartframes.session import pin


@dataclass(frozen=True)
class Polynomial:
    """Coefficients, constant first, over x scaled from [low, high] to [-1, 1]."""

    low: float
    high: float
    scaled: tuple[float, ...]

    def coefficients(self) -> list[float]:
        """Coefficients of plain x, constant first."""
        centre, half = (self.low + self.high) / 2, (self.high - self.low) / 2
        line = np.polynomial.Polynomial([-centre / half, 1 / half])
        return list(np.polynomial.Polynomial(self.scaled)(line).coef)

    def at(self, x: Name) -> Column:
        """Value at a column."""
        t = _scaled(col(x), self.low, self.high)
        out = F.lit(self.scaled[-1])
        for c in reversed(self.scaled[:-1]):
            out = out * t + F.lit(c)
        return out


def _scaled(x: Column, low: float, high: float) -> Column:
    return (x - F.lit((low + high) / 2)) / F.lit((high - low) / 2)


#: Triangles that are merged by one task.
MERGED = 64
#: Points that a task takes into its triangle at once.
PORTION = 65_536


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The triangle of the QR decomposition of ``rows``: all that a least-squares fit needs to know of them."""
    return np.linalg.qr(rows, mode="r")


def _triangles(points: DataFrame, degree: int, low: float, high: float) -> DataFrame:
    """One row (triangle) per partition of ``points`` (x, y): Chebyshev polynomials of x and y, reduced by QR portion by portion."""
    centre, half = (low + high) / 2, (high - low) / 2

    def reduce_points(batches):
        kept = np.zeros((0, degree + 2))
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
            for at in range(0, len(x), PORTION):
                basis = np.polynomial.chebyshev.chebvander((x[at : at + PORTION] - centre) / half, degree)
                kept = _triangle(np.vstack([kept, np.column_stack([basis, y[at : at + PORTION]])]))
        if len(kept):
            yield pa.RecordBatch.from_pydict({"triangle": pa.array([kept.ravel().tolist()], pa.list_(pa.float64()))})

    return points.mapInArrow(reduce_points, "triangle array<double>")


def _merged(triangles: DataFrame, width: int, parts: int) -> DataFrame:
    """The triangles of ``parts`` groups of triangles, each group merged in one task."""

    def merge(batches):
        kept = np.zeros((0, width))
        for batch in batches:
            for flat in batch.column("triangle").to_pylist():
                kept = _triangle(np.vstack([kept, np.array(flat).reshape(-1, width)]))
        if len(kept):
            yield pa.RecordBatch.from_pydict({"triangle": pa.array([kept.ravel().tolist()], pa.list_(pa.float64()))})

    return triangles.repartition(parts).mapInArrow(merge, "triangle array<double>")


def poly_fit(df: DataFrame, x: str, y: str, degree: int) -> Polynomial:
    """Fit y on x by least squares; rows with a null or NaN are left out.

    Points are reduced by QR within each partition and the triangles of (degree + 2)^2 numbers are merged in a tree, so one
    scan does it after the one for the range of x, and the condition number is not squared, as power sums would. Only
    the last triangles reach the driver. With fewer than degree + 1 different x the shortest of the best polynomials is taken.
    """
    points = df.select(col(x).cast("double").alias("x"), col(y).cast("double").alias("y")).dropna()
    low, high = points.agg(F.min("x"), F.max("x")).first()
    if low is None or low == high:
        raise ValueError("a fit needs at least two different x")
    width = degree + 2
    found = pin(_triangles(points, degree, low, high))
    parts = found.count()
    while parts > MERGED:
        parts = -(-parts // MERGED)
        found = pin(_merged(found, width, parts))
    last = _triangle(np.vstack([np.zeros((0, width)), *[np.array(r["triangle"]).reshape(-1, width) for r in found.collect()]]))
    best = np.linalg.lstsq(last[:, :-1], last[:, -1], rcond=None)[0]
    powers = np.zeros(degree + 1)
    found = np.polynomial.chebyshev.cheb2poly(best)  # drops leading zeros
    powers[: len(found)] = found
    return Polynomial(low, high, tuple(powers.tolist()))


def poly_eval(spark: SparkSession, fit: Polynomial, n: int) -> DataFrame:
    """The fit on ``n`` even steps from the smallest to the largest x."""
    step = (fit.high - fit.low) / (n - 1)
    grid = spark.range(n).select((F.lit(fit.low) + F.col("id") * F.lit(step)).alias("x"))
    return grid.withColumn("y", fit.at("x"))


def histogram(df: DataFrame, column: str, low: float | None = None, high: float | None = None, bins: int = 10) -> DataFrame:
    """Counts in even bins of [low, high], the last one closed; empty bins are kept.

    An end that is left out is the smallest or largest value. Values below ``low`` are counted in bin -1, whose
    ``low`` is null, those above ``high`` in bin ``bins``, whose ``high`` is null; these two bins are there if they are
    not empty. Nulls and NaN are not counted.
    """
    values = df.select(col(column).cast("double").alias("__x")).where("__x IS NOT NULL AND NOT isnan(__x)")
    if low is None or high is None:
        found = values.agg(F.min("__x"), F.max("__x")).first()
        low = (found[0] or 0.0) if low is None else low
        high = (found[1] or 0.0) if high is None else high
    width = (high - low) / bins or 1.0
    place = F.least(F.floor((F.col("__x") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    place = F.when(F.col("__x") < F.lit(low), -1).when(F.col("__x") > F.lit(high), bins).otherwise(place)
    counted = values.groupBy(place.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    filled = grid.join(counted, "bin", "full").withColumn("n", F.coalesce("n", F.lit(0)))
    start = F.lit(float(low)) + F.col("bin") * F.lit(width)
    return filled.withColumns(
        {"low": F.when(F.col("bin") >= 0, start), "high": F.when(F.col("bin") < bins, start + F.lit(width))}
    )


def round_step(low: float, high: float, wanted: int) -> float:
    """The smallest step of the form 1, 2 or 5 times a power of ten that covers [low, high] in at most ``wanted`` bins from a multiple of it."""
    if high == low:
        return 1.0
    power = math.floor(math.log10((high - low) / wanted))
    for factor in (1, 2, 5, 10, 20, 50, 100):
        step = factor * 10.0**power if power >= 0 else factor / 10.0**-power
        if math.floor(high / step) - math.floor(low / step) + 1 <= wanted:
            return step
    return step


def histogram_round(df: DataFrame, column: str, wanted: int = 10) -> DataFrame:
    """Counts (bin, low, high, n) in at most ``wanted`` bins whose ends are round numbers; empty bins between are kept.

    A bin holds its lower end and not its upper one. Nulls, NaN and infinite numbers are not counted; without any number there are no bins.
    """
    finite = df.select(col(column).cast("double").alias("__x")).where("__x IS NOT NULL AND NOT isnan(__x) AND abs(__x) < double('inf')")
    low, high = finite.agg(F.min("__x"), F.max("__x")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin bigint, low double, high double, n bigint")
    step = round_step(low, high, wanted)
    first, last = math.floor(low / step), math.floor(high / step)
    counted = finite.groupBy((F.floor(F.col("__x") / F.lit(step)) - first).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(last - first + 1).withColumnRenamed("id", "bin")
    ends = {n: (F.col("bin") + F.lit(first + d)).cast("double") * F.lit(step) for n, d in (("low", 0), ("high", 1))}
    return grid.join(counted, "bin", "left").withColumns(ends).select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))


# fixed values: bins of dates, in months and days, from small to large
_DATE_STEPS = [("day", 1), ("day", 7), *[("month", n) for n in (1, 3, 6, 12, 24, 60, 120, 240, 600, 1200)]]


def histogram_dates(df: DataFrame, column: str, wanted: int = 12) -> DataFrame:
    """Counts (low, high, n) in at most ``wanted`` bins of a day, a week from Monday, 1, 3 or 6 months, or 1, 2, 5, 10, ... years.

    The finest such bins are taken; they begin at the year 0 and so at round dates. Empty bins between are kept; nulls are not counted. ``low``
    is the first day of a bin, ``high`` the first of the next.
    """
    days = df.select(col(column).cast("date").alias("__d")).where("__d IS NOT NULL")
    first, last = days.agg(F.min("__d"), F.max("__d")).first()
    if first is None:
        return df.sparkSession.createDataFrame([], "low date, high date, n bigint")

    def place(day, unit: str, step: int) -> int:
        if unit == "month":
            return (day.year * 12 + day.month - 1) // step
        return (day.toordinal() - 1) // step  # day 1 of year 1 was a Monday

    unit, step = next(((u, s) for u, s in _DATE_STEPS if place(last, u, s) - place(first, u, s) < wanted), _DATE_STEPS[-1])
    day = F.col("__d")
    months = F.year(day) * 12 + F.month(day) - 1
    number = F.floor(months / step) if unit == "month" else F.floor((F.unix_date(day) + F.lit(719_162)) / step)
    counted = days.groupBy(number.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(place(first, unit, step), place(last, unit, step) + 1).withColumnRenamed("id", "bin")

    def start(bin_: Column) -> Column:
        if unit == "month":
            month = bin_ * step
            return F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1))
        return F.date_from_unix_date((bin_ * step - 719_162).cast("int"))

    filled = grid.join(counted, "bin", "left")
    return filled.select(start(F.col("bin")).alias("low"), start(F.col("bin") + 1).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


#: Points of a density's grid, and how many bandwidths beyond the extent and around a point it reaches.
GRID = 128
BEYOND, REACH = 2.0, 9.0


def density(df: DataFrame, value: str, by, points: int = GRID) -> DataFrame:
    """The curve of each category's distribution: rows (category, point, x, density, bandwidth) on ``points`` even places.

    A Gaussian kernel of bandwidth 0.9 * min(standard deviation, IQR / 1.34) * n^(-1/5) is put on every value; the grid reaches
    ``BEYOND`` bandwidths beyond the smallest and largest value. Values are shared between their two neighbours on the grid
    first (linear binning, one aggregate), so the kernel is summed over bins, not values: each bin is spread to the points within
    ``REACH`` bandwidths. Nulls, NaN and infinite numbers are left out. A category whose values have no spread, or that has one value, has one point
    with a null density, and one without values none; a null category is one of its own.
    """
    by = cols(by)
    keys = [col(k) for k in by]
    x = col(value).cast("double")
    clean = df.select(*keys, x.alias("__x")).where("__x IS NOT NULL AND NOT isnan(__x) AND abs(__x) < double('inf')")
    picks = {"__q1": Pick("__x", 0.25, "linear"), "__q3": Pick("__x", 0.75, "linear")}
    spread = refined_quantiles(clean, by, picks)
    rest = clean.groupBy(*keys).agg(F.min("__x").alias("__min"), F.max("__x").alias("__max"), F.stddev_samp("__x").alias("__std"), F.count("*").alias("__n"))
    stats = attach(rest, spread.withColumn("__one", F.lit(1)), by, "__one").drop("__one")
    iqr = (F.col("__q3") - F.col("__q1")) / 1.34
    # a quarter of equal values makes the IQR say nothing
    width = F.when(iqr > 0, F.least("__std", iqr)).otherwise(F.col("__std")) * 0.9 * F.pow(F.col("__n").cast("double"), F.lit(-0.2))
    stats = stats.withColumn("bandwidth", F.when(width > 0, width))
    start = F.col("__min") - BEYOND * F.col("bandwidth")
    stats = stats.withColumns({"__start": F.coalesce(start, F.col("__min")), "__step": (F.col("__max") - F.col("__min") + 2 * BEYOND * F.col("bandwidth")) / (points - 1)})
    stats = pin(stats.select(*keys, "bandwidth", "__start", "__step", "__n"))
    placed = attach(clean, stats, by, "__n").where("__step IS NOT NULL").withColumn("__at", (F.col("__x") - F.col("__start")) / F.col("__step"))
    left = F.floor("__at")
    shares = F.array(
        F.struct(left.alias("bin"), (1 - (F.col("__at") - left)).alias("weight")), F.struct((left + 1).alias("bin"), (F.col("__at") - left).alias("weight"))
    )
    bins = placed.select(*keys, "bandwidth", "__step", "__n", F.inline(shares)).groupBy(*keys, "bin").agg(
        F.sum("weight").alias("weight"), *[F.first(c).alias(c) for c in ("bandwidth", "__step", "__n")]
    )
    reach = F.ceil(REACH * F.col("bandwidth") / F.col("__step"))
    near = F.sequence(F.greatest(F.col("bin") - reach, F.lit(0)), F.least(F.col("bin") + reach, F.lit(points - 1)))
    far = (F.col("point") - F.col("bin")) * F.col("__step") / F.col("bandwidth")
    kernel = F.col("weight") * F.exp(-far * far / 2)
    curve = bins.withColumn("point", F.explode(near)).groupBy(*keys, "point").agg(F.sum(kernel).alias("__sum"))
    places = stats.withColumn("point", F.explode(F.when(F.col("__step").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint")))))
    both = attach(places, curve.withColumn("__one", F.lit(1)), [*by, "point"], "__one")
    height = F.coalesce("__sum", F.lit(0.0)) / (F.col("__n") * F.col("bandwidth") * math.sqrt(2 * math.pi))
    at = F.col("__start") + F.col("point") * F.coalesce("__step", F.lit(0.0))
    return both.select(*keys, "point", at.alias("x"), F.when(F.col("bandwidth").isNotNull(), height).alias("density"), "bandwidth")


def distribution(df: DataFrame, value: str, by) -> DataFrame:
    """Count, min, quartiles, median, max and mean per category."""
    by = cols(by)
    spread = quartiles_and_median(df, by, value)
    rest = df.groupBy(*[col(k) for k in by]).agg(
        F.min(col(value)).alias("min"),
        F.max(col(value)).alias("max"),
        F.avg(col(value)).alias("mean"),
        F.count("*").alias("__rows"),
    )
    return attach(spread, rest, by, "__rows").drop("__rows")
