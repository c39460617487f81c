"""N and O: windows, sorting and top-k."""

from pyspark.sql import functions as F

from chartframes.columns import ordering
from chartframes.functions import flag
from chartframes.operators.ordered import (
    dense_rank,
    lag_diff,
    last_n,
    moving_mean,
    relative_to_first,
    row_number,
    running_count,
    running_share,
    running_sum,
    top_n,
)
from chartframes.operators.quantiles import group_quantiles, with_group_quantiles
from chartframes.operators.selection import Pick, refined_quantiles
from chartframes.operators.skew import with_group_values
from chartframes.plans import top_groups
from checks.registry import cents, check, double, rounded


@check(
    "n01_partition_sum",
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(sum(CAST(l_quantity AS DECIMAL(18,2)))
       OVER (PARTITION BY l_suppkey) AS DOUBLE) AS total FROM lineitem""",
)
def n01(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity")
    out = with_group_values(lines, "l_suppkey", total=F.sum(cents("l_quantity")).cast("double"))
    return out.drop("l_suppkey", "l_quantity")


@check("n02_partition_count", "SELECT o_orderkey, count(o_orderkey) OVER (PARTITION BY o_custkey) AS n FROM orders")
def n02(t):
    out = with_group_values(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", n=F.count("o_orderkey"))
    return out.drop("o_custkey")


@check(
    "n03_partition_mean_median",
    """SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS mean,
       round(median(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS median FROM orders""",
)
def n03(t):
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    means = with_group_values(orders, "o_orderpriority", mean=F.avg("o_totalprice"))
    out = with_group_quantiles(means, "o_orderpriority", "o_totalprice", {"median": 0.5}, "linear")
    return out.select("o_orderkey", "mean", "median").withColumns(rounded("mean", "median", digits=4))


RUNNING = """SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total FROM orders"""


@check("n04_running_sum", RUNNING)
def n04(t):
    out = running_sum(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], cents("o_totalprice"), "total")
    return out.select("o_orderkey", F.col("total").cast("double").alias("total"))


@check("n04_running_sum_spread", RUNNING)
def n04_spread(t):
    out = running_sum(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], cents("o_totalprice"), "total", limit=5)
    return out.select("o_orderkey", F.col("total").cast("double").alias("total"))


@check(
    "n05_running_count",
    """SELECT o_orderkey, row_number() OVER w AS number, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) OVER
       (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS filled
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def n05(t):
    order = ["o_orderdate", "o_orderkey"]
    numbered = row_number(t.orders, "o_custkey", order, "number")
    filled = F.when(F.col("o_orderstatus") == "F", F.lit(1))
    return running_count(numbered, "o_custkey", order, filled, "filled").select("o_orderkey", "number", "filled")


@check(
    "n06_running_share",
    """WITH p AS (SELECT p_brand, sum(CAST(p_retailprice AS DECIMAL(18,2))) AS total FROM part GROUP BY p_brand)
       SELECT p_brand, round(100 * CAST(sum(total) OVER (ORDER BY total DESC, p_brand ROWS UNBOUNDED PRECEDING) AS DOUBLE)
       / CAST(sum(total) OVER () AS DOUBLE), 6) AS cum_pct FROM p""",
)
def n06(t):
    totals = t.part.groupBy("p_brand").agg(F.sum(cents("p_retailprice")).alias("total"))
    return running_share(totals, ["-total", "p_brand"], "total").select("p_brand", F.round("cum_pct", 6).alias("cum_pct"))


NEAREST = """WITH r AS (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS rn,
      count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
    SELECT o_orderpriority, max(CASE WHEN rn = floor(0.25::DOUBLE * (n - 1) + 0.5) + 1 THEN o_totalprice END) AS q1,
      max(CASE WHEN rn = floor(0.9::DOUBLE * (n - 1) + 0.5) + 1 THEN o_totalprice END) AS q9 FROM r GROUP BY o_orderpriority"""


@check("n08_quantile_nearest", NEAREST)
def n08(t):
    return group_quantiles(t.orders, "o_orderpriority", "o_totalprice", {"q1": 0.25, "q9": 0.9})


@check("n08_quantile_nearest_spread", NEAREST)
def n08_spread(t):
    return group_quantiles(t.orders, "o_orderpriority", "o_totalprice", {"q1": 0.25, "q9": 0.9}, limit=100)


@check("n08_quantile_refined", NEAREST)
def n08_refined(t):
    return refined_quantiles(t.orders, "o_orderpriority", {"q1": Pick("o_totalprice", 0.25), "q9": Pick("o_totalprice", 0.9)})


@check(
    "n08_quantile_on_rows",
    f"SELECT o_orderkey, q1, q9 FROM orders JOIN ({NEAREST}) USING (o_orderpriority)",
)
def n08_rows(t):
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    out = with_group_quantiles(orders, "o_orderpriority", "o_totalprice", {"q1": 0.25, "q9": 0.9})
    return out.select("o_orderkey", "q1", "q9")


DAILY = """SELECT CAST(ts AS DATE) AS day, event_type, sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS total
    FROM events GROUP BY ALL"""


def daily(t):
    days = t.events.groupBy(F.col("ts").cast("date").alias("day"), "event_type")
    return days.agg(F.sum(cents("value")).cast("double").alias("total"))


@check(
    "n09_moving_mean",
    f"""SELECT CAST(day AS VARCHAR) AS day, event_type, CASE WHEN count(total) OVER w = 7 THEN round(avg(total) OVER w, 6) END AS mean
        FROM ({DAILY}) WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS 6 PRECEDING)""",
)
def n09(t):
    out = moving_mean(daily(t), "event_type", "day", "total", 7, "mean")
    return out.select(F.col("day").cast("string").alias("day"), "event_type", F.round("mean", 6).alias("mean"))


@check(
    "n09_moving_mean_spread",
    """SELECT o_orderkey, CASE WHEN count(*) OVER w = 5 THEN round(avg(o_totalprice) OVER w, 4) END AS mean FROM orders
       WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS 4 PRECEDING)""",
)
def n09_spread(t):
    out = moving_mean(t.orders, "o_orderpriority", ["o_orderdate", "o_orderkey"], "o_totalprice", 5, "mean", limit=100)
    return out.select("o_orderkey", F.round("mean", 4).alias("mean"))


@check(
    "n10_lag_diff",
    f"""SELECT CAST(day AS VARCHAR) AS day, event_type, round(total - lag(total) OVER (PARTITION BY event_type ORDER BY day), 6) AS diff
        FROM ({DAILY})""",
)
def n10(t):
    out = lag_diff(daily(t), "event_type", "day", "total")
    return out.select(F.col("day").cast("string").alias("day"), "event_type", F.round("diff", 6).alias("diff"))


@check(
    "n11_relative_to_first",
    f"""SELECT CAST(day AS VARCHAR) AS day, event_type,
        round((total / first_value(total) OVER (PARTITION BY event_type ORDER BY day) - 1) * 100, 2) AS pct FROM ({DAILY})""",
)
def n11(t):
    out = relative_to_first(daily(t), "event_type", "day", "total", "ratio")
    pct = F.round((F.col("ratio") - 1) * 100, 2)
    return out.select(F.col("day").cast("string").alias("day"), "event_type", pct.alias("pct"))


@check(
    "n12_dense_rank",
    "SELECT p_brand, n, dense_rank() OVER (ORDER BY n DESC) AS rank FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)",
)
def n12(t):
    return dense_rank(t.part.groupBy("p_brand").agg(F.count("*").alias("n")), "n")


@check(
    "n13_offset_from_min",
    "SELECT o_orderkey, round(log10(o_totalprice) - (SELECT min(log10(o_totalprice)) FROM orders), 6) AS above FROM orders",
)
def n13(t):
    low = t.orders.agg(F.min(F.log10("o_totalprice"))).scalar()
    return t.orders.select("o_orderkey", F.round(F.log10("o_totalprice") - low, 6).alias("above"))


@check(
    "o01_sort",
    """SELECT year(o_orderdate) AS year, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2""",
)
def o01(t):
    table = t.orders.groupBy(F.year("o_orderdate").alias("year"), "o_custkey").agg(F.count("*").alias("n"))
    return table.orderBy(*ordering(["year", "-n", "o_custkey"]))


@check("o02_head", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 15")
def o02(t):
    return t.part.orderBy(*ordering(["-p_retailprice", "p_partkey"])).limit(15).select("p_partkey", "p_retailprice")


@check("o03_tail", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey DESC LIMIT 10")
def o03(t):
    return last_n(t.part.select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], 10)


@check(
    "o04_top_per_group",
    """SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank
       FROM part QUALIFY rank <= 10""",
)
def o04(t):
    return top_n(t.part, "p_brand", ["-p_retailprice", "p_partkey"], 10, "rank").select("p_brand", "p_partkey", "rank")


@check(
    "o05_best_groups",
    "SELECT p_brand, round(avg(p_retailprice), 6) AS mean FROM part GROUP BY p_brand ORDER BY avg(p_retailprice) DESC LIMIT 10",
)
def o05(t):
    return top_groups(t.part, "p_brand", "p_retailprice", 10).withColumns(rounded("mean"))
