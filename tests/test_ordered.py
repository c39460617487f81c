"""Order-dependent operators, each way against a plain Python loop, with one group holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from chartframes.operators.ordered import (
    dense_rank,
    first_row,
    lag_diff,
    last_n,
    moving_mean,
    numbered_sum,
    relative_to_first,
    row_number,
    running_count,
    running_share,
    running_sum,
    top_n,
)
from tests.conftest import rows

WAYS = [None, 7, 0]


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows: a third in group "hot", some in the null group, shuffled, with null values."""
    draw = random.Random(5)
    keys = ["hot"] * 200 + [None] * 40 + [f"k{draw.randrange(30)}" for _ in range(360)]
    data = [(k, i, draw.choice([None, draw.randrange(100)])) for i, k in enumerate(keys)]
    draw.shuffle(data)
    return spark.createDataFrame(data, "k string, id int, v int").repartition(5)


def groups(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.id):
        out.setdefault(r.k, []).append(r)
    return out


@pytest.mark.parametrize("limit", WAYS)
def test_row_number(skewed, limit):
    expected = sorted((r.id, n) for g in groups(skewed).values() for n, r in enumerate(g, 1))
    assert rows(row_number(skewed, "k", "id", "n", limit), "id", "n") == expected


@pytest.mark.parametrize("limit", WAYS)
def test_row_number_of_the_whole_table_downwards(skewed, limit):
    found = rows(row_number(skewed, None, "-id", "n", limit), "id", "n")
    assert found == [(i, 600 - i) for i in range(600)]


@pytest.mark.parametrize("limit", WAYS)
def test_running_sum_and_count(skewed, limit):
    total, count, expected = {}, {}, []
    for k, g in groups(skewed).items():
        for r in g:
            total[k] = total.get(k, 0) + (r.v or 0)
            count[k] = count.get(k, 0) + (r.v is not None)
            expected.append((r.id, total[k], count[k]))
    summed = running_sum(skewed, "k", "id", F.coalesce("v", F.lit(0)), "s", limit)
    found = running_count(summed, "k", "id", "v", "c", limit=limit)
    assert rows(found, "id", "s", "c") == sorted(expected)


@pytest.mark.parametrize("limit", WAYS)
def test_running_sum_is_null_where_the_value_is(skewed, limit):
    total, expected = {}, []
    for k, g in groups(skewed).items():
        for r in g:
            total[k] = total.get(k, 0) + (r.v or 0)
            expected.append((r.id, None if r.v is None else total[k]))
    assert rows(running_sum(skewed, "k", "id", "v", "s", limit), "id", "s") == sorted(expected)


@pytest.mark.parametrize("limit", WAYS)
def test_moving_mean(skewed, limit):
    expected = []
    for g in groups(skewed).values():
        for i, r in enumerate(g):
            last = [x.v for x in g[max(0, i - 2) : i + 1]]
            whole = len(last) == 3 and None not in last
            expected.append((r.id, round(sum(last) / 3, 9) if whole else None))
    found = moving_mean(skewed, "k", "id", "v", 3, "m", limit)
    assert rows(found, "id", F.round("m", 9)) == sorted(expected)


@pytest.mark.parametrize("limit", WAYS)
@pytest.mark.parametrize("n", [1, 10])
def test_lag_diff(skewed, limit, n):
    expected = []
    for g in groups(skewed).values():
        for i, r in enumerate(g):
            before = g[i - n].v if i >= n else None
            expected.append((r.id, None if r.v is None or before is None else r.v - before))
    assert rows(lag_diff(skewed, "k", "id", "v", "d", n, limit), "id", "d") == sorted(expected)


def test_relative_to_first(skewed):
    found = {r.id: r.x for r in relative_to_first(skewed.withColumn("v", F.col("id") + 1.0), "k", "id", "v", "x").collect()}
    for g in groups(skewed).values():
        for r in g:
            assert found[r.id] == pytest.approx((r.id + 1) / (g[0].id + 1))


def test_top_n_and_first_row(skewed):
    expected = sorted(r.id for g in groups(skewed).values() for r in g[-3:])
    assert [r[0] for r in rows(top_n(skewed, "k", "-id", 3), "id")] == expected
    firsts = sorted(g[0].id for g in groups(skewed).values())
    assert [r[0] for r in rows(first_row(skewed, "k", "id"), "id")] == firsts


def test_top_n_prunes_before_the_shuffle(skewed):
    plan = top_n(skewed, "k", "-id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_n_beyond_the_pruning_limit(spark):
    df = spark.range(3000).withColumn("k", F.lit(1))
    assert top_n(df, "k", "id", 1500).count() == 1500


def test_last_n(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 7)], "id int, v int")
    assert [r.id for r in last_n(df, ["v", "id"], 2).collect()] == [2, 4]
    assert [r.id for r in last_n(df, ["-v", "id"], 2).collect()] == [1, 2]


@pytest.mark.parametrize("limit", [None, 0])
def test_dense_rank(spark, limit):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", None)], "k string, n int")
    assert rows(dense_rank(df, "n", "r", limit), "k", "r") == [("a", 2), ("b", 1), ("c", 2), ("d", 3)]


@pytest.mark.parametrize("limit", [None, 0])
def test_running_share_ends_at_100(spark, limit):
    df = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 2.0)], "k string, v double")
    assert rows(running_share(df, ["-v", "k"], "v", "p", limit), "k", "p") == [("a", 50.0), ("b", 80.0), ("c", 100.0)]


@pytest.mark.parametrize("kind", ["decimal(18,2)", "int", "bigint", "float", "double", "decimal(38,4)"])
def test_both_ways_of_a_running_sum_have_one_schema(spark, kind):
    df = spark.range(20).select("id", (F.col("id") % 2).alias("k"), F.col("id").cast(kind).alias("v"))
    ways = [running_sum(df, "k", "id", "v", limit=limit) for limit in (None, 0, 5)]
    assert len({w.schema.simpleString() for w in ways}) == 1
    assert rows(ways[0]) == rows(ways[1]) == rows(ways[2])


@pytest.mark.parametrize("limit", [None, 0])
def test_number_and_sum_from_one_sort(spark, limit):
    df = spark.createDataFrame([(i % 3 if i % 5 else None, i, i * 2 if i % 7 else None) for i in range(60)], "k int, t int, x int")
    want = running_sum(row_number(df, "k", "t", "n"), "k", "t", "x", "s")
    found = numbered_sum(df, "k", "t", "x", "n", "s", limit)
    assert found.dtypes == want.dtypes and rows(found) == rows(want)
