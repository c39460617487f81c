"""A: group aggregates."""

from pyspark.sql import functions as F

from chartframes.operators.aggregate import (
    counts,
    crosstab_share,
    extent,
    group_shares,
    latest,
    means,
    medians,
    sums,
    value_counts,
)
from chartframes.functions import flag, sum_across
from chartframes.operators.columns import pick
from chartframes.operators.ordered import first_row
from chartframes.operators.rows import distinct_rows, with_total_row
from chartframes.operators.selection import refined_medians
from chartframes.sources.profile import profile
from checks.registry import cents, check, double, keyed, rounded


def exact(df, *names):
    return df.withColumns({n: cents(n) for n in names})


@check(
    "a01_group_sum",
    """SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity FROM lineitem GROUP BY ALL""",
)
def a01(t):
    names = ["l_extendedprice", "l_quantity"]
    return sums(exact(t.lineitem, *names), ["l_returnflag", "l_linestatus"], names).withColumns(double(*names))


@check(
    "a02_sum_all_numeric",
    """SELECT l_returnflag, CAST(sum(l_orderkey) AS BIGINT) AS l_orderkey, CAST(sum(l_partkey) AS BIGINT) AS l_partkey,
       CAST(sum(l_suppkey) AS BIGINT) AS l_suppkey, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice,
       CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS l_discount,
       CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS l_tax FROM lineitem GROUP BY l_returnflag""",
)
def a02(t):
    floats = pick(t.lineitem, "float")
    return sums(exact(t.lineitem, *floats), "l_returnflag").withColumns(double(*floats))


@check(
    "a03_len_and_count",
    """SELECT c_mktsegment, count(*) AS n, count(o_orderkey) AS orders FROM customer
       LEFT JOIN (SELECT * REPLACE (CASE WHEN o_totalprice > 400000 THEN o_custkey END AS o_custkey) FROM orders) ON c_custkey = o_custkey GROUP BY c_mktsegment""",
)
def a03(t):
    large = keyed(t, 400000)
    joined = t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return counts(joined, "c_mktsegment", {"n": None, "orders": "o_orderkey"})


@check(
    "a04_mean",
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS o_totalprice FROM orders GROUP BY o_orderpriority""",
)
def a04(t):
    return means(t.orders, "o_orderpriority", "o_totalprice").withColumns(rounded("o_totalprice", digits=4))


@check(
    "a05_median_all",
    """SELECT l_returnflag, round(median(l_quantity), 6) AS l_quantity, round(median(l_extendedprice), 6) AS l_extendedprice,
       round(median(l_discount), 6) AS l_discount, round(median(l_tax), 6) AS l_tax FROM lineitem GROUP BY l_returnflag""",
)
def a05(t):
    names = pick(t.lineitem, "float")
    return medians(t.lineitem, "l_returnflag", names).withColumns(rounded(*names))


@check(
    "a05_median_refined",
    """SELECT l_returnflag, l_linestatus, round(median(l_quantity), 6) AS l_quantity, round(median(l_extendedprice), 6) AS l_extendedprice,
       round(median(l_discount), 6) AS l_discount, round(median(l_partkey), 6) AS l_partkey FROM lineitem GROUP BY ALL""",
)
def a05_refined(t):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]
    return refined_medians(t.lineitem, ["l_returnflag", "l_linestatus"], names).withColumns(rounded(*names))


@check(
    "a06_scaled_sum",
    """SELECT dayofweek(ts) AS day_num, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / 52, 6) AS value
       FROM events GROUP BY 1""",
)
def a06(t):
    days = t.events.select((F.dayofweek("ts") - 1).alias("day_num"), cents("value").alias("value"))
    return sums(days, "day_num", "value", divisor=52.0).withColumns(rounded("value"))


@check(
    "a07_min_max",
    """SELECT c_mktsegment, CAST(min(o_orderdate) AS VARCHAR) AS first, CAST(max(o_orderdate) AS VARCHAR) AS last
       FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment""",
)
def a07(t):
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    out = extent(joined, "c_mktsegment", "o_orderdate")
    return out.withColumns({c: F.col(c).cast("string") for c in ("first", "last")})


@check(
    "a08_global_scalars",
    """SELECT o_orderkey, o_totalprice > (SELECT avg(o_totalprice) FROM orders) AS above_mean,
       round(o_totalprice - (SELECT max(o_totalprice) FROM orders), 2) AS below_max FROM orders""",
)
def a08(t):
    mean = t.orders.agg(F.avg("o_totalprice")).scalar()
    top = t.orders.agg(F.max("o_totalprice")).scalar()
    return t.orders.select(
        "o_orderkey",
        (F.col("o_totalprice") > mean).alias("above_mean"),
        F.round(F.col("o_totalprice") - top, 2).alias("below_max"),
    )


@check("a09_distinct", "SELECT DISTINCT year(o_orderdate) AS year, o_orderstatus FROM orders")
def a09(t):
    return distinct_rows(t.orders.withColumn("year", F.year("o_orderdate")), "year", "o_orderstatus")


@check("u04_distinct_all", "SELECT DISTINCT * FROM (SELECT l_orderkey, l_linenumber FROM lineitem)")
def u04(t):
    return distinct_rows(t.lineitem.select("l_orderkey", "l_linenumber"))


@check(
    "a10_one_per_key",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def a10(t):
    first = first_row(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))


@check(
    "a11_value_counts",
    """SELECT event_type, count(*) AS total, round(count(*) / sum(count(*)) OVER (), 6) AS percentage,
       dense_rank() OVER (ORDER BY count(*) DESC) AS rank FROM events GROUP BY event_type""",
)
def a11(t):
    return value_counts(t.events, "event_type").withColumns(rounded("percentage"))


@check(
    "a12_crosstab",
    """SELECT p_brand, round(count(*) FILTER (l_returnflag = 'A') / any_value(n), 8) AS "A",
       round(count(*) FILTER (l_returnflag = 'N') / any_value(n), 8) AS "N",
       round(count(*) FILTER (l_returnflag = 'R') / any_value(n), 8) AS "R"
       FROM lineitem JOIN part ON l_partkey = p_partkey, (SELECT count(*) AS n FROM lineitem) GROUP BY p_brand""",
)
def a12(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return crosstab_share(joined, "p_brand", "l_returnflag", ["A", "N", "R"]).withColumns(rounded("A", "N", "R", digits=8))


@check(
    "a13_sum_horizontal",
    """SELECT c_custkey, coalesce(f, 0) + coalesce(o, 0) + coalesce(p, 0) AS total FROM customer LEFT JOIN (
         SELECT o_custkey, nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS f, nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS o,
                nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS p FROM orders GROUP BY o_custkey
       ) ON c_custkey = o_custkey""",
)
def a13(t):
    wide = t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).count()
    joined = t.customer.join(wide, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", sum_across(["F", "O", "P"]).alias("total"))


@check(
    "a14_null_count",
    """WITH j AS (SELECT c_custkey, o_orderkey FROM customer
         LEFT JOIN (SELECT * REPLACE (CASE WHEN o_totalprice > 450000 THEN o_custkey END AS o_custkey) FROM orders) ON c_custkey = o_custkey)
       SELECT 'c_custkey' AS "column", count(*) - count(c_custkey) AS nulls FROM j
       UNION ALL SELECT 'o_orderkey', count(*) - count(o_orderkey) FROM j""",
)
def a14(t):
    large = keyed(t, 450000)
    joined = t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return profile(joined.select("c_custkey", "o_orderkey")).select("column", "nulls")


@check(
    "a15_flag_sums",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS win,
       count(*) FILTER (o_orderstatus <> 'F') AS loss FROM orders GROUP BY o_orderpriority""",
)
def a15(t):
    flags = t.orders.select(
        "o_orderpriority",
        flag(F.col("o_orderstatus") == "F").alias("win"),
        flag(F.col("o_orderstatus") != "F").alias("loss"),
    )
    return sums(flags, "o_orderpriority")


@check(
    "a16_totals_row",
    """SELECT coalesce(l_returnflag, 'Total') AS l_returnflag, count(*) AS n,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag)""",
)
def a16(t):
    table = t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum(cents("l_quantity")).alias("qty"))
    return with_total_row(table, "l_returnflag").withColumns(double("qty"))


@check(
    "o06_latest",
    """SELECT o_orderpriority, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice,
       arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_orderpriority""",
)
def o06(t):
    return latest(t.orders, "o_orderkey", ["o_totalprice", "o_orderstatus"], "o_orderpriority")


@check(
    "n07_share_in_group",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY CAST(ts AS DATE)) AS BIGINT) AS total,
       round(100 * count(*) / sum(count(*)) OVER (PARTITION BY CAST(ts AS DATE)), 6) AS pct FROM events
       GROUP BY CAST(ts AS DATE), event_type""",
)
def n07(t):
    days = t.events.select(F.col("ts").cast("date").cast("string").alias("day"), "event_type")
    return group_shares(days, "day", "event_type").withColumns(rounded("pct"))
