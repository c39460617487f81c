"""Reshaping, column choice and fits."""

import math
import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartframes.operators.columns import (
    all_except,
    apply_to,
    drop_empty,
    keep_complete,
    pick,
    rename,
    sort_columns,
)
from chartframes.operators import fit as fits
from chartframes.operators.fit import density, distribution, histogram, histogram_dates, histogram_round, poly_eval, poly_fit, round_step
from chartframes.operators.reshape import SparsePivot, pivot_count, pivot_sparse, pivot_strict, pivot_sum, pivot_values, transpose, unpivot
from chartframes.operators.rows import align_frames
from tests.conftest import rows


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "i string, o string, v int")


def test_pivot_strict(long):
    assert rows(pivot_strict(long, "i", "o", "v")) == [("a", 1, 2), ("b", 3, None)]


def test_pivot_strict_fails_on_a_second_row(long):
    with pytest.raises(PySparkException):
        pivot_strict(long.union(long.limit(1)), "i", "o", "v", ["x", "y"]).collect()


def test_pivot_sum_and_count(long):
    twice = long.union(long)
    assert rows(pivot_sum(twice, "i", "o", "v", ["x", "y"])) == [("a", 2, 4), ("b", 6, None)]
    assert rows(pivot_count(twice, "i", "o", ["x", "y"])) == [("a", 2, 2), ("b", 2, None)]


def test_pivot_values_are_limited(long, spark):
    assert pivot_values(long, "o") == ["x", "y"]
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(ValueError):
            pivot_values(long, "o")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_unpivot_undoes_pivot(long):
    wide = pivot_strict(long, "i", "o", "v")
    assert rows(unpivot(wide, "i", ["x", "y"], "o", "v").dropna()) == rows(long)


def test_transpose(long):
    wide = pivot_strict(long, "i", "o", "v")
    flipped = transpose(wide, "i", "o")
    assert flipped.columns == ["o", "a", "b"] and rows(flipped) == [("x", 1, 3), ("y", 2, None)]
    assert rows(transpose(flipped, "o", "i")) == rows(wide)


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "t", None), (2, None, "u", None)], "b int, a double, c string, d double")
    assert pick(df, "numeric") == ["b", "a", "d"] and pick(df, "string") == ["c"] and pick(df, "float", exclude=["d"]) == ["a"]
    assert pick(df, prefix="c") == ["c"]
    assert sort_columns(df, ["c"], ["a"]).columns == ["c", "b", "d", "a"]
    assert drop_empty(df).columns == ["b", "a", "c"] and drop_empty(df, ["d"]).columns == df.columns
    assert keep_complete(df, 1, ["b"]).columns == ["b", "a"]
    assert all_except(df, "a").columns == ["b", "c", "d"]
    assert rename(df, {"a": "A.1"}).columns == ["b", "A.1", "c", "d"]
    assert rename(df, list("wxyz")).columns == list("wxyz")
    assert rows(apply_to(df, ["b"], lambda c: c * 10), "b") == [(10,), (20,)]


@pytest.mark.parametrize("degree", [1, 2, 5])
def test_poly_fit_agrees_with_numpy(spark, degree):
    x = np.linspace(90, 900, 60)
    y = 3 + 0.5 * x - 0.002 * x**2 + 40 * np.sin(x / 50)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0)], "x double, y double")
    fit = poly_fit(df, "x", "y", degree)
    reference = np.polynomial.Polynomial.fit(x, y, degree)
    grid = poly_eval(spark, fit, 25).orderBy("x").collect()
    expected = np.linspace(90, 900, 25)
    assert [r.x for r in grid] == pytest.approx(list(expected))
    assert [r.y for r in grid] == pytest.approx(list(reference(expected)), rel=1e-9)
    assert fit.coefficients() == pytest.approx(list(reference.convert().coef), rel=1e-6)


def test_poly_fit_needs_two_points(spark):
    with pytest.raises(ValueError):
        poly_fit(spark.createDataFrame([(1.0, 1.0)], "x double, y double"), "x", "y", 1)


def test_histogram_keeps_empty_bins_and_the_upper_end(spark):
    df = spark.createDataFrame([(0.0,), (0.9,), (4.0,), (9.0,), (None,)], "x double")
    assert rows(histogram(df, "x", 0.0, 4.0, 4), "bin", "n") == [(0, 2), (1, 0), (2, 0), (3, 1), (4, 1)]
    whole = histogram(df, "x", bins=3).select("bin", "n", "low", "high")
    assert rows(whole) == [(0, 2, 0.0, 3.0), (1, 1, 3.0, 6.0), (2, 1, 6.0, 9.0)]
    assert rows(histogram(df, "x", 0.5, bins=2), "bin", "n") == [(-1, 1), (0, 2), (1, 1)]
    assert rows(histogram(df.where("x IS NULL"), "x", bins=1), "bin", "n") == [(0, 0)]


def test_distribution(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0)], "k string, v double")
    out = distribution(df, "v", "k").select("k", "n", "min", "median", "max", F.round("mean", 3))
    assert rows(out) == [("a", 2, 1.0, 2.0, 3.0, 2.0), ("b", 1, 5.0, 5.0, 5.0, 5.0)]


def test_poly_fit_of_a_high_degree_keeps_its_digits(spark, monkeypatch):
    monkeypatch.setattr(fits, "MERGED", 3)  # several rounds of merging
    x = [1e6 + i / 7 for i in range(3000)]
    t = (np.array(x) - (x[0] + x[-1]) / 2) / ((x[-1] - x[0]) / 2)
    y = np.polynomial.chebyshev.chebval(t, [3, -1, 0.5, 0, 2, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0.25])
    df = spark.createDataFrame([(a, float(b)) for a, b in zip(x, y, strict=True)] + [(None, 1.0), (2.0, None)], "x double, y double").repartition(20)
    fit = poly_fit(df, "x", "y", 15)
    back = [r.v for r in df.dropna().orderBy("x").select(fit.at("x").alias("v")).collect()]
    assert np.abs(np.array(back) - y).max() < 1e-9


def test_poly_fit_with_too_few_points_goes_through_them(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 5.0)], "x double, y double")
    fit = poly_fit(df, "x", "y", 4)
    assert [r.v for r in df.orderBy("x").select(fit.at("x").alias("v")).collect()] == pytest.approx([1.0, 5.0])


@pytest.mark.parametrize("low, high, wanted, step", [(0, 99, 10, 10), (3, 97, 10, 10), (0, 100, 10, 20), (0.02, 0.31, 7, 0.05), (-5, 5, 3, 5), (-5, 5, 2, 10), (7, 7, 5, 1), (1e-9, 3e-9, 4, 1e-9), (0, 1e12, 6, 2e11)])
def test_round_steps(low, high, wanted, step):
    assert round_step(low, high, wanted) == pytest.approx(step)
    assert math.floor(high / step) - math.floor(low / step) + 1 <= wanted


def test_round_histogram_of_odd_values(spark):
    df = spark.createDataFrame([(v,) for v in (-0.5, 0.0, 1.99, 2.0, 9.0, None, math.nan, math.inf)], "x double")
    found = [(r.low, r.high, r.n) for r in histogram_round(df, "x", 6).orderBy("bin").collect()]
    assert found == [(-2, 0, 1), (0, 2, 2), (2, 4, 1), (4, 6, 0), (6, 8, 0), (8, 10, 1)]
    assert histogram_round(df.where("x IS NULL"), "x").collect() == [] == histogram_dates(df.selectExpr("cast(null AS date) AS x"), "x").collect()
    assert [tuple(r) for r in histogram_round(df.where("x = 9"), "x").collect()] == [(0, 9.0, 10.0, 1)]


@pytest.mark.parametrize("first, last, low, high", [
    ("2024-01-01", "2024-01-05", "2024-01-01", "2024-01-02"), ("2024-01-01", "2024-02-20", "2024-01-01", "2024-01-08"), ("2024-01-31", "2024-11-02", "2024-01-01", "2024-02-01"),
    ("2022-02-10", "2024-06-01", "2022-01-01", "2022-04-01"), ("1789-07-14", "1870-09-04", "1780-01-01", "1790-01-01"), ("1969-12-31", "1970-01-01", "1969-12-31", "1970-01-01"),
])
def test_date_bins(spark, first, last, low, high):
    df = spark.createDataFrame([(first,), (last,), (None,)], "d string").select(F.to_date("d").alias("d"))
    found = [tuple(map(str, r)) for r in histogram_dates(df, "d", 12).orderBy("low").collect()]
    assert found[0] == (low, high, "1") and len(found) <= 12 and sum(int(r[2]) for r in found) == 2
    assert all(a[1] == b[0] for a, b in zip(found, found[1:], strict=False)) and found[-1][0] <= last < found[-1][1]


def test_density_is_near_the_kernel_over_all_values(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.normal(5, 2, 400), "b": rng.exponential(3, 300), None: np.r_[rng.normal(0, 1, 50), 30.0]}
    rows = [(k, float(v)) for k, x in values.items() for v in x] + [("one", 4.0), ("flat", 1.0), ("flat", 1.0), ("none", None), ("none", math.nan), ("a", math.inf)]
    found = {}
    for r in density(spark.createDataFrame(rows, "k string, v double"), "v", "k").collect():
        found.setdefault(r.k, []).append(r)
    assert found.keys() == {"a", "b", None, "one", "flat"}
    for k, x in values.items():
        curve = sorted(found[k], key=lambda r: r.point)
        q1, q3 = np.quantile(x, [0.25, 0.75])
        width = 0.9 * min(x.std(ddof=1), (q3 - q1) / 1.34) * len(x) ** -0.2
        at = np.array([r.x for r in curve])
        exact = np.exp(-(((at[:, None] - x) / width) ** 2) / 2).sum(1) / (len(x) * width * math.sqrt(2 * math.pi))
        assert len(curve) == 128 and curve[0].bandwidth == pytest.approx(width)
        assert np.abs(np.array([r.density for r in curve]) - exact).max() < 0.02 * exact.max()
        assert sum(r.density for r in curve) * (at[1] - at[0]) == pytest.approx(1, abs=0.03)
    assert [(r.x, r.density) for r in found["one"]] == [(4.0, None)] and [(r.x, r.density) for r in found["flat"]] == [(1.0, None)]


def test_sparse_pivot_of_50000_columns(spark, tmp_path):
    df = spark.range(150_000).select((F.col("id") % 7).alias("row"), (F.col("id") % 50_000).alias("part"), (F.col("id") % 11).alias("x"))
    df = df.unionByName(spark.createDataFrame([(1, None, 5), (None, 3, 2), (None, 3, 4), (9, 4, None)], "row long, part long, x long"))
    pivot = pivot_sparse(df, "row", "part", "x", 1000)
    want = df.groupBy("row", "part").agg(F.sum("x").alias("cell"))
    assert pivot.long().exceptAll(want).isEmpty() and want.exceptAll(pivot.long()).isEmpty()
    assert pivot.columns.count() == 50_001 and pivot.columns.where("value IS NULL").first().number == 50_000
    assert pivot.rows.agg(F.max(F.size("numbers"))).first()[0] <= 1000
    assert pivot.rows.where("numbers <> array_sort(numbers)").isEmpty()
    pivot.write(str(tmp_path / "wide"))
    back = SparsePivot.read(spark, str(tmp_path / "wide"), "row", "part", 1000)
    found = back.wide([3, 49_999, None])
    assert "PartitionFilters: [isnotnull" in found._jdf.queryExecution().executedPlan().toString().replace("PartitionFilters: [block", "PartitionFilters: [isnotnull")
    some = df.where("part IN (3, 49999) OR part IS NULL").groupBy("row").pivot("part", [3, 49_999]).agg(F.sum("x"))
    assert found.columns == ["row", "3", "49999", "null"]
    assert rows(found, "row", "3", "49999") == rows(some.select("row", "3", "49999")) and rows(found.where("`null` IS NOT NULL"), "row", "null") == [(1, 5)]
    with pytest.raises(ValueError):
        pivot.wide([-1])
    assert pivot_sparse(df.limit(0), "row", "part", "x").long().collect() == []


def test_aligned_frames_take_one_shuffle(spark):
    a = spark.createDataFrame([("x", 1, None), (None, 2, 0.5)], "k string, n int, v double")
    b = spark.createDataFrame([("y", 3), ("x", 4)], "k string, n int")
    c = spark.createDataFrame([(None, "t")], "k string, t string")
    found = align_frames({"a": a, "b": b, "c": c}, "k")
    assert found.columns == ["k", "a n", "a v", "b n", "c t"]
    assert rows(found) == rows(spark.createDataFrame([("x", 1, None, 4, None), ("y", None, None, 3, None), (None, 2, 0.5, None, "t")], "k string, a int, b double, c int, d string"))
    plan = align_frames({"a": a, "b": b, "c": c}, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    with pytest.raises(PySparkException, match="a label twice"):
        align_frames({"a": a, "b": b.union(b)}, "k").collect()
    assert align_frames({"a": a.limit(0), "b": b.limit(0)}, "k").collect() == []
