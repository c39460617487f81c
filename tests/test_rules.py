"""Null, zero and cast rules."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartframes.columns import col, ordering
from chartframes.functions import (
    bin_label,
    checked_label,
    currency,
    degrees,
    fill_from,
    first_match,
    floor_divide,
    mean_of,
    number_or,
    others,
    percent_columns,
    ratio_percent,
    safe_cast,
    strict_cast,
    sum_across,
    within,
)
from chartframes.operators.aggregate import counts, sums
from chartframes.operators.rows import add_row, stack, with_total_row
from tests.conftest import rows


def values(spark, schema, data, *expressions):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*expressions).collect()]


def test_ratio_repairs_nulls_and_zeros(spark):
    data = [(1.0, 2.0), (None, 2.0), (0.0, 0.0), (None, None), (3.0, 0.0), (3.0, None)]
    found = values(spark, "a double, b double", data, ratio_percent("a", "b"))
    assert found == [(50.0,), (0.0,), (0.0,), (0.0,), (None,), (None,)]


def test_sum_across_counts_nulls_as_zero(spark):
    assert values(spark, "a int, b int", [(1, None), (None, None), (2, 3)], sum_across(["a", "b"])) == [(1,), (0,), (5,)]


def test_mean_of_two_is_null_when_either_is(spark):
    assert values(spark, "a double, b double", [(1.0, None), (1.0, 2.0)], mean_of("a", "b", 1)) == [(None,), (1.5,)]


def test_sum_of_an_all_null_group_is_zero(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", 2)], "k string, v int")
    assert rows(sums(df, "k", ["v"])) == [("x", 0), ("y", 2)]


def test_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, None), ("y", 2)], "k string, v int")
    assert rows(counts(df, "k")) == [("y", 1), (None, 2)]
    assert rows(counts(df, "k", "v")) == [("y", 1), (None, 1)]


def test_strict_cast_fails_and_safe_cast_gives_null(spark):
    text = spark.createDataFrame([("7",), ("1,234",)], "t string")
    assert [r[0] for r in text.select(safe_cast("t", "int")).collect()] == [7, None]
    with pytest.raises(PySparkException):
        text.select(strict_cast("t", "int")).collect()


def test_unsigned_kinds(spark):
    data = [(0,), (255,), (256,), (-1,), (None,)]
    assert values(spark, "x int", data, safe_cast("x", "uint8"), safe_cast("x", "uint16")) == [
        (0, 0), (255, 255), (None, 256), (None, None), (None, None)
    ]
    with pytest.raises(PySparkException):
        values(spark, "x int", [(-1,)], strict_cast("x", "uint16"))


def test_float_to_int_truncates(spark):
    assert values(spark, "x double", [(-7.9,), (7.9,)], strict_cast("x", "int")) == [(-7,), (7,)]


def test_closed_labels(spark):
    assert values(spark, "t string", [("a",), (None,)], checked_label("t", ["a", "b"])) == [("a",), (None,)]
    with pytest.raises(PySparkException):
        values(spark, "t string", [("c",)], checked_label("t", ["a", "b"]))


def test_currency(spark):
    assert values(spark, "t string", [("$1,234,567.50",), (None,)], currency("t"), currency("t", 1e6, 1)) == [
        (1234567.5, 1.2),
        (None, None),
    ]
    with pytest.raises(PySparkException):
        values(spark, "t string", [("n/a",)], currency("t"))
    assert values(spark, "t string", [("n/a",)], currency("t", strict=False)) == [(None,)]


def test_marker_texts(spark):
    found = values(spark, "t string", [("NA",), ("12",), (None,)], number_or("t", {"NA": 0}, "int"))
    assert found == [(0,), (12,), (None,)]
    with pytest.raises(PySparkException):
        values(spark, "t string", [("many",)], number_or("t", {"NA": 0}, "int"))


def test_degrees(spark):
    data = [("37.3319°N",), ("121.8934°W",), ("33.9°S",), ("-5.5",)]
    assert values(spark, "t string", data, degrees("t")) == [(37.3319,), (-121.8934,), (-33.9,), (-5.5,)]


def test_bins_are_closed_on_the_right(spark):
    bins = [(0, 5, "0-5"), (5, 10, "5-10"), (90, None, "> 90")]
    data = [(0.0,), (5.0,), (5.1,), (10.0,), (50.0,), (90.0,), (90.1,), (None,)]
    found = values(spark, "x double", data, bin_label("x", bins, "UNDEFINED"))
    undefined = ("UNDEFINED",)
    assert found == [undefined, ("0-5",), ("5-10",), ("5-10",), undefined, undefined, ("> 90",), undefined]


def test_within(spark):
    data = [(5,), (10,)]
    assert values(spark, "x int", data, within("x", 5, 10), within("x", 5, 10, "right"), within("x", 5, 10, "left"), within("x", 5, 10, "none")) == [
        (True, False, True, False),
        (True, True, False, False),
    ]


def test_others_takes_null_in(spark):
    assert values(spark, "t string", [("a",), ("b",), (None,)], others("t", ["a"])) == [("a",), ("Others",), ("Others",)]


def test_first_match_without_otherwise_is_null(spark):
    x = F.col("x")
    assert values(spark, "x int", [(5,), (1,)], first_match((x > 4, "high"), (x > 2, "mid"))) == [("high",), (None,)]


def test_fill_from(spark):
    data = [(None, "b"), (None, None), ("a", "b")]
    assert values(spark, "x string, y string", data, fill_from("x", "y", F.lit("none"))) == [("b",), ("none",), ("a",)]


def test_floor_divide_and_percent_columns(spark):
    assert values(spark, "y int", [(1999,), (-1,)], floor_divide("y", 10)) == [(199,), (-1,)]
    df = spark.createDataFrame([(50, 1)], "a_PCT int, b int")
    assert rows(df.withColumns(percent_columns(df.columns))) == [(0.5, 1)]


def test_nulls_sort_first_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [r.x for r in df.orderBy(*ordering("x")).collect()] == [None, 1, 2]
    assert [r.x for r in df.orderBy(*ordering("-x")).collect()] == [None, 2, 1]


def test_names_with_dots_and_brackets(spark):
    df = spark.createDataFrame([(1, 2)], "`2024 Pop.` int, `Market Cap [M$]` int")
    assert rows(df.select(col("2024 Pop."), col("Market Cap [M$]"))) == [(1, 2)]


def test_stack_rejects_other_columns(spark):
    with pytest.raises(PySparkException):
        stack(spark.range(1), spark.range(1).toDF("other")).collect()


def test_add_row_and_total_row(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 2, None)], "k string, n int, x double")
    assert rows(add_row(df, k="DC", n=9)) == [("DC", 9, None), ("a", 1, 0.5), ("b", 2, None)]
    assert rows(with_total_row(df, "k"))[0] == ("Total", 3, 0.5)
