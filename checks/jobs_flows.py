"""K: flow matrices, timelines and calendars."""

from pyspark.sql import functions as F

from chartframes.functions import calendar_parts
from chartframes.operators.reshape import pivot_strict
from chartframes.plans import (
    calendar_matrix,
    flow_edges,
    flow_matrix,
    load_profiles,
    monthly_totals,
    normalised_flow_matrix,
    reference_means,
    timeline,
    weekday_means,
)
from checks.registry import cents, check, double, rounded

NATIONS = [f"NATION_{i}" for i in range(25)]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
YEARS = list(range(1995, 2002))


def sales(t):
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = t.orders.join(places, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderdate", "r_name", "n_name", cents("o_totalprice").alias("price"))


MONTHLY = (
    "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, "
    + ", ".join(f"CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (r_name = '{r}') AS DOUBLE) AS \"{r}\"" for r in REGIONS)
    + """, strftime(date_trunc('month', o_orderdate), '%Y_%m') AS year_month FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY year(o_orderdate),
    month(o_orderdate), date_trunc('month', o_orderdate)"""
)


@check("k01_monthly_totals", MONTHLY)
def k01(t):
    return monthly_totals(sales(t), "o_orderdate", "r_name", "price", REGIONS).withColumns(double(*REGIONS))


@check("k02_reference_means", "SELECT " + ", ".join(f'round(avg("{r}"), 2) AS "{r}"' for r in REGIONS) + f" FROM ({MONTHLY})")
def k02(t):
    months = monthly_totals(sales(t), "o_orderdate", "r_name", "price", REGIONS).withColumns(double(*REGIONS))
    return reference_means(months, REGIONS).withColumns(rounded(*REGIONS, digits=2))


def edges(t):
    joined = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select(
        "c_nationkey", "s_nationkey", F.year("o_orderdate").alias("year"), cents("l_extendedprice").alias("price")
    )


EDGES = """SELECT a.n_name AS src, b.n_name AS dst, year(o_orderdate) AS year, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON a.n_nationkey = c_nationkey JOIN nation b ON b.n_nationkey = s_nationkey"""


def names(t):
    return t.nation.select("n_nationkey", "n_name")


@check("k23_flow_edges", f'SELECT src AS "from", dst AS "to", CAST(sum(price) AS DOUBLE) AS weight FROM ({EDGES}) GROUP BY src, dst')
def k23_edges(t):
    return flow_edges(edges(t), "c_nationkey", "s_nationkey", "price", names(t)).withColumns(double("weight"))


@check(
    "k23_flow_matrix",
    'SELECT src AS "from", '
    + ", ".join(f"CAST(sum(price) FILTER (dst = '{n}') AS DOUBLE) AS {n}" for n in NATIONS)
    + f" FROM ({EDGES}) GROUP BY src",
)
def k23(t):
    return flow_matrix(edges(t), "c_nationkey", "s_nationkey", "price", names(t), NATIONS).withColumns(double(*NATIONS))


@check(
    "k23_normalised_flow_matrix",
    f"WITH e AS ({EDGES}), y AS (SELECT src, count(DISTINCT year) AS years FROM e GROUP BY src), "
    "w AS (SELECT src, dst, floor(100 * sum(price)::DOUBLE / any_value(years)) AS v FROM e JOIN y USING (src) GROUP BY src, dst) "
    'SELECT src AS "from", ' + ", ".join(f"CAST(max(v) FILTER (dst = '{n}') AS DOUBLE) AS {n}" for n in NATIONS) + " FROM w GROUP BY src",
)
def k23_normalised(t):
    matrix = normalised_flow_matrix(edges(t), "c_nationkey", "s_nationkey", "price", "year", names(t), NATIONS)
    return matrix.withColumns(double(*NATIONS))


def daily(t):
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day"))
    return days.agg(F.sum(cents("o_totalprice")).cast("double").alias("total"))


DAILY = """SELECT CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1"""


@check(
    "k24_calendar_matrix",
    "SELECT month(day) AS month, strftime(day, '%b') AS month_name, day(day) AS day, strftime(day, '%b') || ' ' || day(day) AS date, "
    + ", ".join(f"max(total) FILTER (year(day) = {y}) AS \"{y}\"" for y in YEARS)
    + f" FROM ({DAILY}) GROUP BY 1, 2, 3, 4",
)
def k24(t):
    return calendar_matrix(daily(t), "day", "total", YEARS)


@check(
    "k24_weekday_means",
    f"""WITH d AS (SELECT year(day) AS year, strftime(day, '%a') AS day_name, dayofweek(day) + 1 AS day_num, total FROM ({DAILY})),
        r AS (SELECT *, row_number() OVER (PARTITION BY year, day_name ORDER BY total) AS rn,
          count(*) OVER (PARTITION BY year, day_name) AS n FROM d),
        q AS (SELECT year, day_name, max(CASE WHEN rn = floor(0.25::DOUBLE * (n - 1) + 0.5) + 1 THEN total END) AS q1,
          max(CASE WHEN rn = floor(0.75::DOUBLE * (n - 1) + 0.5) + 1 THEN total END) AS q3 FROM r GROUP BY year, day_name),
        k AS (SELECT d.* FROM d JOIN q USING (year, day_name)
          WHERE total BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1))
        SELECT day_name, day_num, """
    + ", ".join(f"round(avg(total) FILTER (year = {y}) / 1000000, 6) AS \"{y}\"" for y in YEARS)
    + " FROM k GROUP BY day_name, day_num",
)
def k24_weekdays(t):
    return weekday_means(daily(t), "day", "total", YEARS, scale=1e6).withColumns(rounded(*[str(y) for y in YEARS]))


@check(
    "k28_timeline",
    """WITH i AS (SELECT c_mktsegment AS grp, c_name AS item, min(o_orderdate) AS s, max(o_orderdate) AS e
         FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL),
       g AS (SELECT grp, min(s) AS s, max(e) AS e, row_number() OVER (ORDER BY grp) AS group_num FROM i GROUP BY grp),
       a AS (SELECT grp, group_num, 0 AS item_num, '<b>' || upper(grp) || '</b>' AS item, s, e FROM g
         UNION ALL SELECT i.grp, group_num, row_number() OVER (PARTITION BY i.grp ORDER BY i.s, item), item, i.s, i.e
         FROM i JOIN g ON g.grp = i.grp),
       k AS (SELECT *, year(e) - year(s) AS duration_years FROM a WHERE year(e) - year(s) >= 6)
       SELECT grp AS "group", group_num, item_num, item, CAST(s AS VARCHAR) AS start, CAST(e AS VARCHAR) AS "end", duration_years,
         '  ' || group_num || '.' || CASE WHEN item_num < 10 THEN '0' ELSE '' END || item_num || ': ' || item AS label
       FROM k WHERE grp IN (SELECT grp FROM k WHERE item_num > 0)""",
)
def k28(t):
    spans = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_mktsegment", "c_name")
    items = spans.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    out = timeline(items, "c_mktsegment", "c_name", "first", "last", 6)
    return out.withColumns({c: F.col(c).cast("string") for c in ("start", "end")})


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def only(*types: str):
    return F.when(F.col("event_type").isin(*types), F.col("value"))


def residents(t):
    return t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("per"))


def _profile(key: str, name: str, aggregate: str, extra: str = "", scale: str = "1000") -> str:
    series = {s: f"CASE WHEN event_type = '{s}' THEN value END" for s in EVENT_TYPES}
    parts = [
        f"SELECT {key} AS {name}, '{s}' AS series, round({aggregate}({v}) / any_value((SELECT count(DISTINCT user_id) FROM events "
        f"WHERE event_type = '{s}')) * {scale}, 3) AS load{extra} FROM events GROUP BY ALL"
        for s, v in series.items()
    ]
    return " UNION ALL ".join(parts)


def profiles(t, grain):
    out = load_profiles(t.events, "ts", "US/Eastern", {n: only(n) for n in EVENT_TYPES}, residents(t), grain, 1000.0)
    return out.withColumns(rounded("load", digits=3))


@check("k31_load_by_date", _profile("CAST(CAST(ts AS DATE) AS VARCHAR)", "date", "sum"))
def k31_date(t):
    return profiles(t, "date").withColumn("date", F.col("date").cast("string"))


@check("k31_load_by_weekday", _profile("dayofweek(ts)", "weekday", "sum", ", strftime(ts, '%a') AS day_name", "1000 / 52"))
def k31_weekday(t):
    return profiles(t, "weekday")


@check("k31_load_by_hour", _profile("hour(ts)", "hour", "avg"))
def k31_hour(t):
    return profiles(t, "hour")


@check("k31_load_by_week", _profile("week(ts)", "week", "sum"))
def k31_week(t):
    return profiles(t, "week")


@check(
    "k31_merged_columns",
    """SELECT hour(ts) AS hour, round(avg(value), 4) AS deals FROM events GROUP BY 1""",
)
def k31_merged(t):
    long = load_profiles(t.events, "ts", "US/Eastern", {"deals": only(*EVENT_TYPES)}, grain="hour")
    return pivot_strict(long, "hour", "series", "load", ["deals"]).withColumns(rounded("deals", digits=4))


@check("k31_time_parts", "SELECT event_id, hour(ts) AS hour, dayofweek(ts) AS day_num, week(ts) AS week FROM events")
def k31_parts(t):
    parts = calendar_parts("ts")
    return t.events.select("event_id", *[parts[n].alias(n) for n in ("hour", "day_num", "week")])
