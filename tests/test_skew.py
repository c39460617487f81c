"""Attaching group values, on each of the ways."""

import pytest
from pyspark.sql import functions as F

from chartframes.operators import skew
from chartframes.operators.rows import in_groups
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third under one key, 10 under null, the rest under 1,990 small keys."""
    key = F.when(F.col("id") < 1000, 0).when(F.col("id") < 1010, None).otherwise(F.col("id") - 1000)
    return spark.range(3000).withColumn("k", key).repartition(6)


@pytest.fixture(scope="module")
def stats(skewed):
    return skewed.groupBy("k").agg(F.sum("id").alias("s"), F.count("*").alias("n"))


@pytest.mark.parametrize("limit", [None, 0])
def test_attach_keeps_every_row_and_matches_null(skewed, stats, limit):
    out = skew.attach(skewed, stats, "k", "n", limit=limit)
    found = {r.id: (r.k, r.s, r.n) for r in out.collect()}
    assert out.count() == 3000 and len(found) == 3000
    assert found[5] == (0, sum(range(1000)), 1000)
    assert found[1005] == (None, sum(range(1000, 1010)), 10)
    assert found[2500] == (1500, 2500, 1)


@pytest.mark.parametrize("limit", [None, 0])
def test_attach_inner_drops_other_keys(skewed, stats, limit):
    large = stats.where("n >= 10")
    assert skew.attach(skewed, large, "k", "n", "inner", limit).count() == 1010


@pytest.mark.parametrize("limit", [None, 0])
def test_attach_left_keeps_unknown_keys(skewed, stats, limit):
    assert skew.attach(skewed, stats.where("n >= 10"), "k", "n", "left", limit).where("s IS NULL").count() == 1990


def test_hot_keys_are_broadcast_and_the_others_are_not(skewed, stats):
    plan = skew.attach(skewed, stats, "k", "n", limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("strategy=broadcast") == 2


def test_small_stats_leave_the_rows_where_they_are(skewed, stats):
    plan = skew.attach(skewed, stats, "k", "n")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_values_of_the_whole_table(skewed):
    out = skew.with_group_values(skewed, [], total=F.count("*"), top=F.max("id"))
    assert out.select("total", "top").distinct().collect() == [(3000, 2999)]


def test_shares_of_a_group_add_up(skewed):
    out = skew.share_of_group(skewed.withColumn("v", F.col("id") + 1), "k", "v", "share")
    sums = [r.s for r in out.groupBy("k").agg(F.sum("share").alias("s")).collect()]
    assert sums == pytest.approx([1.0] * len(sums))


def test_fits_one_task(skewed):
    assert skew.largest_group(skewed, ["k"])[0] == 1000
    assert skew.largest_group(skewed, [])[0] == 3000
    assert skew.largest_group(skewed.limit(0), ["k"]) == (0, 0)
    assert skew.fits_one_task(skewed, ["k"], 1000)
    assert not skew.fits_one_task(skewed, ["k"], 999)
    wide = skewed.withColumn("t", F.repeat(F.lit("x"), 1000))
    assert skew.largest_group(wide, ["k"])[1] >= 1_000_000
    assert skew.fits_one_task(skewed, ["k"], None) and not skew.fits_one_task(skewed, ["k"], 0)


def test_in_groups_never_keeps_null_keys(skewed):
    assert rows(in_groups(skewed, "k", F.count("*") >= 10).select("k").distinct()) == [(0,)]


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_split_is_a_join(spark, skewed, how, limit):
    table = spark.range(0, 1500, 2).selectExpr("id AS k", "id * 10 AS x").union(spark.sql("SELECT NULL, 7"))
    split = skew.join_split(skewed, table, "k", how, limit)
    assert rows(split, "id", "k", "x") == rows(skewed.join(table, "k", how), "id", "k", "x")


def test_join_split_broadcasts_hot_keys_only(spark, skewed):
    table = spark.range(2000).selectExpr("id AS k", "id * 10 AS x")
    plan = skew.join_split(skewed, table, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan and "LeftSemi" in plan
    even = skewed.where("k > 0")
    assert "Union" not in skew.join_split(even, table, "k")._jdf.queryExecution().optimizedPlan().toString()


def test_join_split_deals_hot_keys_whose_rows_are_too_many_to_broadcast(spark, skewed):
    table = spark.range(60).selectExpr("id % 3 AS k", "id AS x")
    split = skew.join_split(skewed, table, "k", "inner", 0)
    assert "__salt" in split._jdf.queryExecution().analyzed().toString()
    assert rows(split, "id", "k", "x") == rows(skewed.join(table, "k"), "id", "k", "x")


def test_sizes_of_nested_rows(spark):
    df = spark.sql("SELECT array_repeat(1.5F, 1000) AS a, X'0102' AS b, array('xyz', NULL) AS s, CAST(NULL AS array<int>) AS n")
    assert df.select(skew._row_bytes(df)).first()[0] == 4 * 16 + 16_000 + 2 + 35
    nested = spark.sql("SELECT map(1, 2) AS m")
    assert nested.select(skew._row_bytes(nested)).first()[0] > skew.BROADCAST_BYTES


def test_join_split_refuses_other_kinds(spark, skewed):
    with pytest.raises(ValueError):
        skew.join_split(skewed, skewed, "k", "full")


def test_a_table_is_computed_once_for_sizes_and_window(spark):
    from chartframes.operators.ordered import row_number, running_sum

    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    df = spark.range(0, 5000, 1, 4).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("x")).mapInPandas(count, "id long, k long, x double")
    for limit in (skew.TASK_ROWS, 100):  # the window, and the sort
        seen.value = 0
        found = running_sum(row_number(df, "k", "id", "n", limit), "k", "id", "x", "s", None)
        assert found.agg(F.max("n"), F.count("*")).first() == (715, 5000)
        assert seen.value == 5000


def test_sizes_of_a_plain_scan_come_from_its_keys(spark, tables, monkeypatch):
    scans = []
    whole = skew._row_bytes
    monkeypatch.setattr(skew, "_row_bytes", lambda df: scans.append(df) or whole(df))
    rows, size = skew.largest_group(tables.orders, ["o_orderstatus"])
    assert rows == tables.orders.groupBy("o_orderstatus").count().agg(F.max("count")).first()[0] and size > 0 and not scans
    df, fits = skew.sized(tables.orders.where("o_orderkey > 3"), ["o_orderstatus"])
    assert fits and not scans and skew._is_plain(df)


def test_observed_sizes_hold_null_keys_and_empty_tables(spark):
    base = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), "id").repartition(3)
    for df, limit, fits in [(base, 1100, True), (base, 900, False), (base.where("false"), 1, True), (base, None, True), (base, 0, False)]:
        assert skew.sized(df, ["k"], limit)[1] is fits
    wide = base.withColumn("t", F.repeat(F.lit("x"), 200_000))
    assert skew.sized(wide, [], 10_000_000)[1] is False
    assert skew.sized(wide.limit(100), [], 10_000_000)[1] is True


def test_observed_sizes_of_many_even_keys(spark):
    """The sketch holds some 12,000 keys; of more that are all alike it names none."""
    from chartframes.operators.ordered import row_number, running_count

    base = spark.range(60_000).select((F.col("id") % 20_000).alias("k"), "id").repartition(3)
    assert skew.sized(base, ["k"], 60)[1] is True
    assert skew.sized(base, ["k"], 2)[1] is False
    hot = base.withColumn("k", F.when(F.col("id") >= 59_000, -1).otherwise(F.col("k")))
    assert skew.sized(hot, ["k"], 900)[1] is False
    numbered = running_count(row_number(base, "k", "id", "n"), "k", "id", F.when(F.col("id") < 30_000, 1), "seen")
    assert numbered.groupBy("n").agg(F.count("*"), F.sum("seen")).orderBy("n").collect() == [(1, 20_000, 20_000), (2, 20_000, 30_000), (3, 20_000, 30_000)]
