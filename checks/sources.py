"""S: sources and sinks."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from chartframes.operators.aggregate import sums
from chartframes.operators.columns import pick
from chartframes.session import scratch_path
from chartframes.sources import (
    cached_source,
    describe,
    infer_types,
    mapping_table,
    profile,
    read_csv,
    read_lenient,
    read_parquet,
    read_tagged,
    read_two_row_header,
    sample_n,
    unpack_list,
    weekdays,
    write_csv,
)
from chartframes.sources.profile import distinct_counts
from chartframes.sources.tables import literal_table
from checks.registry import cents, check, double, rounded


@check("s01_read_csv", "SELECT * FROM customer")
def s01(t):
    path = scratch_path(t.spark, "customer")
    write_csv(t.customer, path)
    return read_csv(t.spark, path, t.customer.schema.simpleString()[len("struct<"):-1].replace(":", " "))


@check(
    "s01_infer_types",
    """WITH k AS (SELECT MAP {'BIGINT': 'bigint', 'INTEGER': 'bigint', 'DOUBLE': 'double', 'VARCHAR': 'string', 'BOOLEAN': 'boolean', 'DATE': 'date', 'TIMESTAMP': 'timestamp'} AS m),
       o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS gaps, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS day,
         CAST(o_orderdate AS TIMESTAMP) AS moment, o_totalprice > 100000 AS late, CASE WHEN o_orderkey = 7 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS mixed,
         CASE WHEN false THEN 'x' END AS nothing, CASE WHEN o_orderkey % 2 = 0 THEN 1.5::DOUBLE ELSE 2 END AS either FROM orders)
       SELECT 'o_orderkey' AS "column", any_value(m[typeof(o_orderkey)]) AS type, count(o_orderkey) AS cells, count(*) AS rows FROM o, k
       UNION ALL SELECT 'gaps', any_value(m[typeof(gaps)]), count(gaps), count(*) FROM o, k
       UNION ALL SELECT 'o_totalprice', any_value(m[typeof(o_totalprice)]), count(o_totalprice), count(*) FROM o, k
       UNION ALL SELECT 'o_orderstatus', any_value(m[typeof(o_orderstatus)]), count(o_orderstatus), count(*) FROM o, k
       UNION ALL SELECT 'day', any_value(m[typeof(day)]), count(day), count(*) FROM o, k
       UNION ALL SELECT 'moment', any_value(m[typeof(moment)]), count(moment), count(*) FROM o, k
       UNION ALL SELECT 'late', any_value(m[typeof(late)]), count(late), count(*) FROM o, k
       UNION ALL SELECT 'mixed', any_value(m[typeof(mixed)]), count(mixed), count(*) FROM o, k
       UNION ALL SELECT 'nothing', any_value(m[typeof(nothing)]), count(nothing), count(*) FROM o, k
       UNION ALL SELECT 'either', any_value(m[typeof(either)]), count(either), count(*) FROM o, k""",
)
def s01_types(t):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    columns = {
        "o_orderkey": key, "gaps": F.when(key % 3 == 0, F.col("o_custkey")), "o_totalprice": price, "o_orderstatus": F.col("o_orderstatus"), "day": F.col("o_orderdate").cast("date"),
        "moment": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "late": price > 100000, "mixed": F.when(key == 7, "x").otherwise(F.col("o_custkey").cast("string")),
        "nothing": F.lit(None).cast("string"), "either": F.when(key % 2 == 0, "1.5").otherwise("2"),
    }
    path = scratch_path(t.spark, "types")
    write_csv(t.orders.select(*[c.alias(n) for n, c in columns.items()]), path)
    return infer_types(read_csv(t.spark, path))


@check(
    "s02_lost_cells",
    """SELECT 'price' AS "column", count(*) FILTER (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%') AS lost, count(*) AS rows FROM orders
       UNION ALL SELECT 'day', count(*) FILTER (o_orderstatus = 'F'), count(*) FROM orders""",
)
def s02_lost(t):
    price = F.when(F.col("o_orderpriority").startswith("1"), "n/a").when(F.col("o_orderpriority").startswith("2"), "12 orders").otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(F.col("o_orderstatus") == "F", "soon").when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
    path, lost = scratch_path(t.spark, "lost"), Observation()
    write_csv(t.orders.select("o_orderkey", price.alias("price"), day.alias("day")), path)
    kept = read_lenient(t.spark, path, {"price": "double", "day": "date"}, lost)
    kept = cached_source(t.spark, scratch_path(t.spark, "kept"), lambda: kept)  # the one pass over the file
    counts = mapping_table(t.spark, dict(lost.get), "column", "lost")
    return counts.withColumn("rows", kept.agg(F.count("*").alias("rows")).scalar())


@check(
    "s02_read_lenient",
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderpriority LIKE '1%' THEN 'n/a' WHEN o_orderpriority LIKE '2%'
       THEN '12 orders' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS price, o_orderstatus FROM orders""",
)
def s02(t):
    text = (
        F.when(F.col("o_orderpriority").startswith("1"), "n/a")
        .when(F.col("o_orderpriority").startswith("2"), "12 orders")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    path = scratch_path(t.spark, "mixed")
    write_csv(t.orders.select("o_orderkey", text.alias("price"), "o_orderstatus"), path)
    return read_lenient(t.spark, path, {"o_orderkey": "bigint", "price": "double"})


@check("s03_lazy_scan", "SELECT event_type, count(*) AS n FROM events WHERE value > 50 GROUP BY event_type")
def s03(t):
    lazy = read_parquet(t.spark, f"{t.folder}/events.parquet")
    return lazy.where("value > 50").groupBy("event_type").agg(F.count("*").alias("n"))


@check(
    "s05_read_tagged",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS season, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def s05(t):
    path = scratch_path(t.spark, "by_year")
    orders = t.orders.withColumn("year", F.year("o_orderdate"))
    orders.write.partitionBy("year").options(header=True).csv(path)
    years = [str(y) for y in range(1995, 2002)]
    slices = {y: f"{path}/year={y}" for y in years}
    stacked = read_tagged(t.spark, slices, "season", lambda d: d.withColumn("total", cents("o_totalprice")))
    return stacked.groupBy("season").agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"))


@check(
    "s06_literal_table",
    """SELECT dayname(ts)[1:3] AS day_name, dayofweek(ts) + 1 AS day_num, count(*) AS n FROM events GROUP BY 1, 2""",
)
def s06(t):
    days = t.events.select(F.date_format("ts", "E").alias("day_name"))
    return days.join(weekdays(t.spark), "day_name").groupBy("day_name", "day_num").agg(F.count("*").alias("n"))


@check(
    "s06_unpack_list",
    """SELECT c_mktsegment, CASE c_mktsegment WHEN 'FURNITURE' THEN 1 WHEN 'HOUSEHOLD' THEN 1 WHEN 'MACHINERY' THEN 2
       WHEN 'BUILDING' THEN 2 ELSE 3 END AS "row", CASE c_mktsegment WHEN 'FURNITURE' THEN 1 WHEN 'HOUSEHOLD' THEN 2
       WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 1 END AS col, count(*) AS n FROM customer GROUP BY 1, 2, 3""",
)
def s06_unpack(t):
    places = [["FURNITURE", "1", "1"], ["HOUSEHOLD", "1", "2"], ["MACHINERY", "2", "1"], ["BUILDING", "2", "2"], ["AUTOMOBILE", "3", "1"]]
    grid = unpack_list(literal_table(t.spark, {"info": places}), "info", {"c_mktsegment": "string", "row": "int", "col": "int"})
    return t.customer.join(grid, "c_mktsegment").groupBy("c_mktsegment", "row", "col").agg(F.count("*").alias("n"))


@check(
    "r06_mapping_table",
    """SELECT event_type, CASE event_type WHEN 'view' THEN 'V' WHEN 'click' THEN 'C' WHEN 'signup' THEN 'S'
       WHEN 'purchase' THEN 'P' ELSE 'E' END AS code, count(*) AS n FROM events GROUP BY 1, 2""",
)
def r06(t):
    codes = mapping_table(t.spark, {"view": "V", "click": "C", "signup": "S", "purchase": "P", "error": "E"}, "event_type", "code")
    return t.events.join(codes, "event_type").groupBy("event_type", "code").agg(F.count("*").alias("n"))


@check(
    "s07_two_row_header",
    """SELECT p_partkey AS "Part", p_retailprice AS "PRICE ($)", CAST(p_size AS DOUBLE) AS "SIZE (cm)" FROM part""",
)
def s07(t):
    head, body = scratch_path(t.spark, "head"), scratch_path(t.spark, "body")
    names = ["Part", "Retail price", "Size"]
    rows = {"Part": ["", None], "Retail price": ["($)", "PRICE"], "Size": ["(cm)", "SIZE"]}
    write_csv(literal_table(t.spark, rows).coalesce(1), head)
    write_csv(t.part.select("p_partkey", "p_retailprice", "p_size").toDF(*names), body)
    return read_two_row_header(t.spark, head, {"Part": "bigint"}, more=[body])


@check(
    "s08_cached_source",
    """SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders GROUP BY o_orderpriority""",
)
def s08(t):
    path = scratch_path(t.spark, "totals")

    def build():
        return t.orders.groupBy("o_orderpriority").agg(F.sum(cents("o_totalprice")).cast("double").alias("total"))

    cached_source(t.spark, path, build)
    return cached_source(t.spark, path, build)


@check(
    "s09_profile",
    """WITH c AS (SELECT * FROM customer)
       SELECT 'c_custkey' AS "column", 'bigint' AS type, count(c_custkey) AS count, count(*) - count(c_custkey) AS nulls,
              CAST(min(c_custkey) AS VARCHAR) AS min, CAST(max(c_custkey) AS VARCHAR) AS max,
              round(avg(c_custkey), 4) AS mean, round(stddev(c_custkey), 4) AS std, count(DISTINCT c_custkey) AS "distinct" FROM c
       UNION ALL SELECT 'c_name', 'string', count(c_name), count(*) - count(c_name), min(c_name), max(c_name), NULL, NULL,
              count(DISTINCT c_name) FROM c
       UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey), count(*) - count(c_nationkey),
              CAST(min(c_nationkey) AS VARCHAR), CAST(max(c_nationkey) AS VARCHAR),
              round(avg(c_nationkey), 4), round(stddev(c_nationkey), 4), count(DISTINCT c_nationkey) FROM c
       UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal), count(*) - count(c_acctbal),
              CAST(min(c_acctbal) AS VARCHAR), CAST(max(c_acctbal) AS VARCHAR), round(avg(c_acctbal), 4), round(stddev(c_acctbal), 4),
              count(DISTINCT c_acctbal) FROM c
       UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment), count(*) - count(c_mktsegment), min(c_mktsegment),
              max(c_mktsegment), NULL, NULL, count(DISTINCT c_mktsegment) FROM c""",
)
def s09(t):
    customer = t.customer
    out = profile(customer).join(distinct_counts(customer, customer.columns), "column", "left")
    return out.withColumns(rounded("mean", "std", digits=4))


@check(
    "s09_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{k}' AS type, count({c}) AS count, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
        {f'round(avg({c}), 4)' if n else 'NULL::DOUBLE'} AS mean, {f'round(stddev({c}), 4)' if n else 'NULL::DOUBLE'} AS std, count(DISTINCT {c}) AS "distinct",
        {f'(SELECT max({c}) FILTER (rn = floor(0.25 * (n - 1) + 0.5) + 1) FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS n FROM p WHERE {c} IS NOT NULL))::DOUBLE' if n else 'NULL::DOUBLE'} AS q1,
        {f'round(median({c}), 6)' if n else 'NULL::DOUBLE'} AS median,
        {f'(SELECT max({c}) FILTER (rn = floor(0.75 * (n - 1) + 0.5) + 1) FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS n FROM p WHERE {c} IS NOT NULL))::DOUBLE' if n else 'NULL::DOUBLE'} AS q3
        FROM p"""
        for c, k, n in [("p_partkey", "bigint", True), ("p_type", "string", False), ("p_size", "int", True), ("p_retailprice", "double", True), ("rare", "int", True)]
    ).join(["WITH p AS (SELECT p_partkey, p_type, p_size, p_retailprice, CASE WHEN p_size > 40 THEN p_size END AS rare FROM part) ", ""]),
)
def s09_describe(t):
    part = t.part.select("p_partkey", "p_type", "p_size", "p_retailprice", F.when(F.col("p_size") > 40, F.col("p_size")).alias("rare"))
    return describe(part).withColumns(rounded("mean", "std", digits=4) | rounded("median"))


@check("s09_sample_n", "SELECT * FROM customer ORDER BY md5('42-' || c_custkey), c_custkey LIMIT 100")
def s09_sample_n(t):
    return sample_n(t.customer, 100, "c_custkey", 42)


@check(
    "p04_pick_by_type",
    """SELECT l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice,
       CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS l_discount,
       CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS l_tax FROM lineitem GROUP BY l_returnflag""",
)
def p04(t):
    names = pick(t.lineitem, "float")
    exact = t.lineitem.withColumns({n: cents(n) for n in names})
    return sums(exact, "l_returnflag", names).withColumns(double(*names))
