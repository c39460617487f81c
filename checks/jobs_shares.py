"""K: shares, counts and spreads."""

from pyspark.sql import functions as F

from chartframes.operators.reshape import transpose
from chartframes.operators.rows import recode
from chartframes.plans import (
    count_by_age_and_status,
    decade_share,
    group_share,
    interquartile_mean,
    iqr_flags,
    iqr_summary,
    per_million,
    percentile_table,
    proportion_by_quartile,
    yearly_counts,
    yield_summary,
)
from chartframes.plans.shares import percentile_matrix, percentile_rows
from checks.registry import cents, check, double, rounded

QUARTILES = """SELECT year, o_orderpriority, max(n) AS n, median(o_totalprice) AS median,
      max(CASE WHEN rn = floor(0.25::DOUBLE * (n - 1) + 0.5) + 1 THEN o_totalprice END) AS q1,
      max(CASE WHEN rn = floor(0.75::DOUBLE * (n - 1) + 0.5) + 1 THEN o_totalprice END) AS q3
    FROM (SELECT year(o_orderdate) AS year, o_orderpriority, o_totalprice, row_number() OVER w AS rn,
      count(*) OVER (PARTITION BY year(o_orderdate), o_orderpriority) AS n FROM orders
      WINDOW w AS (PARTITION BY year(o_orderdate), o_orderpriority ORDER BY o_totalprice)) GROUP BY ALL"""


def yearly(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderpriority", "o_totalprice")


@check(
    "k03_iqr_summary",
    f"""SELECT year, o_orderpriority, n, round(median, 4) AS median, q1, q3, round(q3 - q1, 4) AS iqr,
        CAST(trunc(q1 - 0.5 * (q3 - q1)) AS BIGINT) AS fence_low, CAST(trunc(q3 + 0.5 * (q3 - q1)) AS BIGINT) AS fence_high
        FROM ({QUARTILES})""",
)
def k03(t):
    out = iqr_summary(yearly(t), ["year", "o_orderpriority"], "o_totalprice", k=0.5, truncate=True)
    return out.withColumns(rounded("median", "iqr", digits=4))


@check(
    "k03_iqr_flags",
    f"""SELECT o_orderkey, o_totalprice > q3 + 0.4::DOUBLE * (q3 - q1) OR o_totalprice < q1 - 0.4::DOUBLE * (q3 - q1) AS is_outlier
        FROM orders o JOIN ({QUARTILES}) q ON q.year = year(o.o_orderdate) AND q.o_orderpriority = o.o_orderpriority""",
)
def k03_flags(t):
    out = iqr_flags(yearly(t), "o_totalprice", ["year", "o_orderpriority"], k=0.4)
    return out.select("o_orderkey", "is_outlier")


@check(
    "k08_group_share",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY CAST(ts AS DATE)) AS BIGINT) AS total,
       round(100 * count(*) / sum(count(*)) OVER (PARTITION BY CAST(ts AS DATE)), 6) AS pct FROM events
       GROUP BY CAST(ts AS DATE), event_type""",
)
def k08(t):
    days = t.events.select(F.col("ts").cast("date").cast("string").alias("day"), "event_type")
    return group_share(days, "day", "event_type").withColumns(rounded("pct"))


@check(
    "k08_group_share_recoded",
    """SELECT o_orderpriority, CASE o_orderstatus WHEN 'P' THEN 'O' ELSE o_orderstatus END AS status, count(*) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS total,
       round(100 * count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 6) AS pct FROM orders
       GROUP BY o_orderpriority, 2""",
)
def k08_recoded(t):
    answers = recode(t.orders, "o_orderstatus", {"P": "O"}, "status")
    return group_share(answers, "o_orderpriority", "status").withColumns(rounded("pct"))


@check(
    "k09_interquartile_mean",
    """WITH r AS (SELECT l_suppkey, l_extendedprice AS v, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS rn,
         count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem),
       q AS (SELECT l_suppkey, max(n) AS n, median(v) AS median,
         max(CASE WHEN rn = floor(0.25::DOUBLE * (n - 1) + 0.5) + 1 THEN v END) AS q1,
         max(CASE WHEN rn = floor(0.75::DOUBLE * (n - 1) + 0.5) + 1 THEN v END) AS q3 FROM r GROUP BY 1 HAVING max(n) >= 590)
       SELECT l_suppkey, q.n, q1, round(median, 4) AS median, q3, round(avg(v), 4) AS average,
         l_suppkey || ': ' || round(avg(v), 1) AS label FROM r JOIN q USING (l_suppkey) WHERE v BETWEEN q1 AND q3
       GROUP BY l_suppkey, q.n, q1, median, q3""",
)
def k09(t):
    return interquartile_mean(t.lineitem, "l_suppkey", "l_extendedprice", 590).withColumns(
        rounded("median", "average", digits=4)
    )


@check(
    "k10_proportion_by_quartile",
    """SELECT 'Q1' AS quartile, round(avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 6) AS "Female",
       round(avg(l_extendedprice), 6) AS "Male" FROM lineitem UNION ALL
       SELECT 'Q2', round(avg(l_discount), 6), round(avg(l_tax), 6) FROM lineitem""",
)
def k10(t):
    wide = t.lineitem.select(
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("string")).otherwise("NULL").alias("pb1Female"),
        F.col("l_extendedprice").alias("pb1Male"),
        F.col("l_discount").alias("pb2Female"),
        F.col("l_tax").alias("pb2Male"),
    )
    columns = {f"pb{q}{s}": (f"Q{q}", s) for q in (1, 2) for s in ("Female", "Male")}
    out = proportion_by_quartile(wide, columns, "NULL", ["Female", "Male"])
    return out.withColumns(rounded("Female", "Male"))


NATION_YEARS = """SELECT n_name, year(o_orderdate) AS year, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey"""
YEARS = [str(y) for y in range(1995, 2002)]
SLICES = [s for y in YEARS for s in ([f"{y}_F", f"{y}_OP"] if y == "2000" else [y])]


def nation_slices(t):
    """Orders per nation and year, the year 2000 in two parts."""
    year = F.year("o_orderdate").cast("string")
    part = F.when(F.col("o_orderstatus") == "F", "2000_F").otherwise("2000_OP")
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select("n_name", F.when(year == "2000", part).otherwise(year).alias("slice"))


_EACH = ", ".join(f'count(*) FILTER (year = {y}) AS "{y}"' for y in YEARS)
COUNTS = f"SELECT n_name, {_EACH}, count(*) AS total FROM ({NATION_YEARS}) GROUP BY n_name"


@check("k21_yearly_counts", COUNTS)
def k21(t):
    return yearly_counts(nation_slices(t), "n_name", "slice", SLICES, {"2000": ["2000_F", "2000_OP"]})


# a year whose parts are not both there is unknown, and shown as 0
_WHOLE = ", ".join(f'count(*) FILTER (year = {y}) AS "{y}"' for y in YEARS if y != "2000")
STRICT = f"""SELECT n_name, {_WHOLE},
    CASE WHEN bool_or(year = 2000 AND o_orderstatus = 'F') AND bool_or(year = 2000 AND o_orderstatus <> 'F')
      THEN count(*) FILTER (year = 2000) ELSE 0 END AS "2000" FROM ({NATION_YEARS}) GROUP BY n_name"""

_RATES = ", ".join(f'round(1000.0 * "{y}" / c, 6)::DOUBLE AS "{y}"' for y in YEARS)
RATES = f"""SELECT n_name, {_RATES} FROM ({STRICT}) JOIN (SELECT n_name, count(*)::DOUBLE AS c FROM customer
    JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name) USING (n_name)"""


def rates(t):
    table = yearly_counts(nation_slices(t), "n_name", "slice", SLICES, {"2000": ["2000_F", "2000_OP"]}, "null")
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").count()
    out = per_million(table, "n_name", YEARS, people, 1000)
    return out.withColumns(rounded(*YEARS))


@check("k21_per_million", RATES)
def k21_rates(t):
    return rates(t)


@check(
    "k21_per_million_transposed",
    "SELECT year, "
    + ", ".join(f"max(v) FILTER (n_name = 'NATION_{i}') AS NATION_{i}" for i in range(25))
    + f""" FROM (UNPIVOT ({RATES}) ON {', '.join(f'"{y}"' for y in YEARS)} INTO NAME year VALUE v) GROUP BY year""",
)
def k21_transposed(t):
    return transpose(rates(t), "n_name", "year", [f"NATION_{i}" for i in range(25)])


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@check(
    "k22_decade_share",
    """WITH s AS (SELECT (year(o_orderdate) // 5 * 5) || 's' AS decade, p_type, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS q
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
       w AS (SELECT decade, p_type, q / sum(q) OVER (PARTITION BY p_type) AS v FROM s)
       SELECT decade, """
    + ", ".join(f"round(max(v) FILTER (p_type = '{n}'), 6) AS \"{n}\"" for n in TYPES)
    + " FROM w GROUP BY decade",
)
def k22(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    lines = joined.select(F.year("o_orderdate").alias("year"), "p_type", cents("l_quantity").alias("quantity"))
    return decade_share(lines, "year", "p_type", "quantity", 5, TYPES).withColumns(rounded(*TYPES))


@check(
    "k26_count_by_age_and_status",
    """SELECT CAST(l_quantity AS INTEGER) AS age, nullif(count(*) FILTER (l_returnflag = 'A'), 0)::DOUBLE AS "A",
       nullif(count(*) FILTER (l_returnflag = 'N'), 0)::DOUBLE AS "N", nullif(count(*) FILTER (l_returnflag = 'R'), 0)::DOUBLE AS "R"
       FROM lineitem GROUP BY 1""",
)
def k26(t):
    out = count_by_age_and_status(t.lineitem, F.col("l_quantity").cast("int"), "l_returnflag", ["A", "N", "R"])
    return out.withColumns(double("A", "N", "R"))


@check(
    "k29_yield_summary",
    """WITH v AS (SELECT CASE p_type WHEN 'PROMO' THEN 'Promotion' ELSE p_type END AS p_type, p_retailprice AS v FROM part WHERE p_size > 5),
       r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY v) AS rn, count(*) OVER (PARTITION BY p_type) AS n FROM v)
       SELECT p_type, max(n) AS n, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, round(median(v), 6) AS median,
         max(CASE WHEN rn = floor(0.25::DOUBLE * (n - 1) + 0.5) + 1 THEN v END) AS q1,
         max(CASE WHEN rn = floor(0.75::DOUBLE * (n - 1) + 0.5) + 1 THEN v END) AS q3 FROM r GROUP BY p_type""",
)
def k29(t):
    text = F.when(F.col("p_size") > 5, F.col("p_retailprice").cast("string")).otherwise("na")
    raw = t.part.select("p_type", text.alias("yield"))
    return yield_summary(raw, "yield", "p_type", {"PROMO": "Promotion"}).withColumns(rounded("mean", "median"))


PERCENTILES = [10, 25, 50, 75, 90]


def _percentiles(percentiles=PERCENTILES) -> str:
    picks = ", ".join(
        f"CAST(max(CASE WHEN rn = floor({p / 100}::DOUBLE * (n - 1) + 0.5) + 1 THEN v END) AS DOUBLE) AS p{p}" for p in percentiles
    )
    return f"""SELECT p_brand, {picks} FROM (SELECT p_brand, p_retailprice AS v,
        row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice) AS rn, count(*) OVER (PARTITION BY p_brand) AS n
        FROM part) GROUP BY p_brand"""


@check(
    "k33_percentile_matrix",
    f"""SELECT p_brand, CAST(replace(name, 'p', '') AS INTEGER) AS percentile, round(trunc(v) / 365, 6) AS years
        FROM (UNPIVOT ({_percentiles()}) ON {', '.join(f'p{p}' for p in PERCENTILES)} INTO NAME name VALUE v)""",
)
def k33_long(t):
    rows = percentile_rows(t.part, "p_brand", "p_retailprice", PERCENTILES)
    return percentile_matrix(rows, "label", "p_brand", "value", PERCENTILES).withColumns(rounded("years"))


@check(
    "k33_percentiles_5_25",
    f"""SELECT p_brand, CAST(replace(name, 'p', '') AS INTEGER) AS percentile, round(trunc(v) / 365, 6) AS years
        FROM (UNPIVOT ({_percentiles([5, 25])}) ON p5, p25 INTO NAME name VALUE v)""",
)
def k33_near(t):
    rows = percentile_rows(t.part, "p_brand", "p_retailprice", [5, 25])
    return percentile_matrix(rows, "label", "p_brand", "value", [5, 25]).withColumns(rounded("years"))


BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@check(
    "k33_percentile_table",
    "SELECT CAST(replace(name, 'p', '') AS INTEGER) AS percentile, "
    + ", ".join(f"round(trunc(max(v) FILTER (p_brand = '{b}')) / 365, 6) AS \"{b}\"" for b in BRANDS)
    + f" FROM (UNPIVOT ({_percentiles()}) ON {', '.join(f'p{p}' for p in PERCENTILES)} INTO NAME name VALUE v) GROUP BY 1",
)
def k33(t):
    rows = percentile_rows(t.part, "p_brand", "p_retailprice", PERCENTILES)
    return percentile_table(rows, "label", "p_brand", "value", PERCENTILES, BRANDS).withColumns(rounded(*BRANDS))
