"""Exact quantiles against a sort in Python."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chartframes.operators.quantiles import (
    group_quantiles,
    iqr_fences,
    quartiles_and_median,
    with_group_quantiles,
)
from tests.conftest import rows

WAYS = [None, 5, 0]


def nearest(values, q):
    values = sorted(v for v in values if v is not None)
    return values[math.floor(q * (len(values) - 1) + 0.5)] if values else None


def median(values):
    values = sorted(v for v in values if v is not None)
    half = (len(values) - 1) / 2
    return (values[math.floor(half)] + values[math.ceil(half)]) / 2 if values else None


@pytest.mark.parametrize("n", [1, 2, 4, 5])
def test_small_groups(spark, n):
    df = spark.createDataFrame([(float(i),) for i in range(n)], "v double")
    found = group_quantiles(df, None, "v", {"q1": 0.25, "q3": 0.75}).first()
    assert tuple(found) == (nearest(range(n), 0.25), nearest(range(n), 0.75))


@pytest.mark.parametrize("limit", WAYS)
def test_skewed_groups(spark, limit):
    draw = random.Random(3)
    data = [("hot", draw.randrange(40)) for _ in range(200)]
    data += [(draw.choice(["a", "b", None]), draw.choice([None, draw.randrange(1000)])) for _ in range(150)]
    data += [("empty", None)] * 3
    df = spark.createDataFrame(data, "k string, v int")
    out = quartiles_and_median(df, "k", "v", rows="all", limit=limit)
    expected = []
    for k in ("hot", "a", "b", None, "empty"):
        v = [x for key, x in data if key == k]
        known = [x for x in v if x is not None]
        expected.append((k, nearest(v, 0.25), median(v), nearest(v, 0.75), len(known), len(v)))
    found = {r.k: tuple(r) for r in out.select("k", "q1", "median", "q3", "n", "all").collect()}
    assert found == {e[0]: e for e in expected}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30), st.floats(0, 1))
def test_any_probability(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert group_quantiles(df, None, "v", {"x": q}, limit=None).first().x == nearest(values, q)


def test_linear_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double")
    assert group_quantiles(df, None, "v", {"x": 0.75}, "linear").first().x == 3.0
    with pytest.raises(ValueError):
        group_quantiles(df, None, "v", {"x": 0.5}, "midpoint")


def test_quantiles_on_rows_keep_every_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None), (None, 7)], "k string, v int")
    found = rows(with_group_quantiles(df, "k", "v", {"m": 0.5}))
    assert found == [("a", 1, 3), ("a", 3, 3), ("b", None, None), (None, 7, 7)]


def test_fences(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 100)], "v int")
    found = iqr_fences(df, None, "v").first()
    assert (found.q1, found.median, found.q3, found.iqr) == (2, 3.0, 4, 2)
    assert (found.fence_low, found.fence_high) == (-1.0, 7.0)
    cut = iqr_fences(df, None, "v", k=0.25, truncate=True).first()
    assert (cut.fence_low, cut.fence_high) == (1, 4)
