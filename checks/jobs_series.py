"""K: time series."""

from pyspark.sql import functions as F

from chartframes.plans import derived_average, latest, pct_change_from_base, smoothed_matrix, yoy_growth
from chartframes.operators.reshape import pivot_sum
from chartframes.plans.series import yoy_changes
from checks.registry import cents, check, double, rounded

TYPES = ["click", "error", "purchase", "signup", "view"]


@check(
    "k11_pct_change_from_base",
    """WITH v AS (SELECT year(o_orderdate) AS year, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS filled,
         CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS open,
         CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_totalprice END AS part, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS whole
         FROM orders),
       m AS (SELECT year, median(filled) AS filled, median(open) AS open,
         median(CASE WHEN whole = 0 THEN CASE WHEN part = 0 THEN 0.0::DOUBLE END ELSE 100 * part / whole END) AS ratio FROM v GROUP BY year),
       b AS (SELECT * FROM m ORDER BY year LIMIT 1)
       SELECT m.year, round((m.filled / b.filled - 1) * 100, 2) AS filled, round((m.open / b.open - 1) * 100, 2) AS open,
         round((m.ratio / b.ratio - 1) * 100, 2) AS ratio FROM m, b""",
)
def k11(t):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    wide = t.orders.select(
        F.year("o_orderdate").alias("year"),
        F.when(status == "F", price).alias("filled"),
        F.when(status == "O", price).alias("open"),
        F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(price).alias("part"),
        F.when(status == "P", 0).otherwise(F.col("o_custkey")).alias("whole"),
    )
    return pct_change_from_base(wide, "year", ["filled", "open"], {"ratio": ("part", "whole")})


@check(
    "k20_smoothed_matrix",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v FROM events GROUP BY ALL),
       s AS (SELECT day, event_type, CASE WHEN count(*) OVER w = 7 THEN avg(v) OVER w END AS m FROM d
         WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS 6 PRECEDING))
       SELECT CAST(day AS VARCHAR) AS day, """
    + ", ".join(f"round(max(m) FILTER (event_type = '{n}'), 6) AS \"{n}\"" for n in TYPES)
    + " FROM s GROUP BY day",
)
def k20(t):
    days = t.events.groupBy(F.col("ts").cast("date").alias("day"), "event_type")
    daily = days.agg(F.sum(cents("value")).cast("double").alias("total"))
    out = smoothed_matrix(daily, "day", "event_type", "total", 7, TYPES)
    return out.withColumns(rounded(*TYPES) | {"day": F.col("day").cast("string")})


def nation_years(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy(F.year("o_orderdate").alias("year"), "n_name").agg(F.count("*").alias("n"))


CHANGES = """WITH y AS (SELECT year(o_orderdate) AS year, n_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
    d AS (SELECT year, n_name, n, n - lag(n) OVER (PARTITION BY n_name ORDER BY year) AS diff FROM y)
    SELECT year, n_name, n, CAST(diff AS DOUBLE) AS diff FROM d
    WHERE n_name IN (SELECT n_name FROM d GROUP BY n_name HAVING max(diff) >= 10)"""


@check("k30_yoy_changes", CHANGES)
def k30_long(t):
    return yoy_changes(nation_years(t), "year", "n_name", "n", 10).withColumns(double("diff"))


@check(
    "k30_yoy_growth",
    f"""WITH c AS ({CHANGES}) SELECT year, count(*) AS series, CAST(max(diff) AS DOUBLE) AS largest FROM c GROUP BY year""",
)
def k30(t):
    wide = yoy_growth(nation_years(t), "year", "n_name", "n", 10)
    series = [c for c in wide.columns if c != "year"]
    return wide.select(
        "year", F.lit(len(series)).alias("series"), F.greatest(*series, F.lit(None)).cast("double").alias("largest")
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def monthly_priorities(t):
    months = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderpriority", cents("o_totalprice").alias("price")
    )
    return pivot_sum(months, "month", "o_orderpriority", "price", PRIORITIES).withColumns(double(*PRIORITIES))


_SUMS = ", ".join(f"CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderpriority = '{p}') AS DOUBLE) AS \"{p}\"" for p in PRIORITIES)
MONTHS = f"SELECT strftime(o_orderdate, '%Y-%m') AS month, {_SUMS} FROM orders GROUP BY 1"


@check("k32_derived_average", f"""SELECT *, round(("1-URGENT" + "2-HIGH") / 2, 1) AS average FROM ({MONTHS})""")
def k32(t):
    return derived_average(monthly_priorities(t), "1-URGENT", "2-HIGH", 1)


@check("k32_latest", f"""SELECT * FROM ({MONTHS}) ORDER BY month DESC LIMIT 1""")
def k32_latest(t):
    return latest(monthly_priorities(t), "month", PRIORITIES)
