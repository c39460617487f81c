"""R: reshaping."""

from pyspark.sql import functions as F

from chartframes.operators.reshape import pivot_count, pivot_sparse, pivot_strict, pivot_sum, transpose, unpivot
from checks.registry import cents, check, double, rounded

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def region_years(t):
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    sales = t.orders.join(places, F.col("o_custkey") == F.col("c_custkey"))
    years = sales.groupBy("r_name", F.year("o_orderdate").alias("year"))
    return years.agg(F.sum(cents("o_totalprice")).cast("double").alias("total"))


REGION_YEARS = """SELECT r_name, year(o_orderdate) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""


@check(
    "r01_pivot_strict",
    "SELECT year, " + ", ".join(f"max(total) FILTER (r_name = '{r}') AS \"{r}\"" for r in REGIONS) + f" FROM ({REGION_YEARS}) GROUP BY year",
)
def r01(t):
    return pivot_strict(region_years(t), "year", "r_name", "total")


@check(
    "r01_pivot_null_key",
    "SELECT year, " + ", ".join(f"max(total) FILTER (r_name = '{r}') AS \"{r}\"" for r in REGIONS if r != "ASIA")
    + f", max(total) FILTER (r_name = 'ASIA') AS \"null\" FROM ({REGION_YEARS}) GROUP BY year",
)
def r01_null(t):
    cells = region_years(t).withColumn("r_name", F.nullif("r_name", F.lit("ASIA")))
    return pivot_strict(cells, "year", "r_name", "total")


@check(
    "r02_pivot_sum_null_key",
    """SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS DOUBLE) AS "F",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS DOUBLE) AS "O",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P') AS DOUBLE) AS "null" FROM orders GROUP BY 1""",
)
def r02_null(t):
    prices = t.orders.select("o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status"), cents("o_totalprice").alias("price"))
    return pivot_sum(prices, "o_orderpriority", "status", "price", ["F", "O", None]).withColumns(double("F", "O", "null"))


@check(
    "r03_pivot_count_null_key",
    """SELECT c_mktsegment, count(*) FILTER (c_nationkey < 5) AS low, count(*) FILTER (c_nationkey >= 5) AS "null"
       FROM customer GROUP BY 1""",
)
def r03_null(t):
    return pivot_count(t.customer.withColumn("side", F.when(F.col("c_nationkey") < 5, "low")), "c_mktsegment", "side")


@check(
    "r02_pivot_sum",
    """SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS DOUBLE) AS "F",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS DOUBLE) AS "O",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P') AS DOUBLE) AS "P" FROM orders GROUP BY 1""",
)
def r02(t):
    prices = t.orders.withColumn("price", cents("o_totalprice"))
    return pivot_sum(prices, "o_orderpriority", "o_orderstatus", "price", ["F", "O", "P"]).withColumns(double("F", "O", "P"))


@check(
    "r03_pivot_count",
    """SELECT c_mktsegment, count(*) FILTER (c_nationkey < 5) AS low, count(*) FILTER (c_nationkey >= 5) AS high
       FROM customer GROUP BY 1""",
)
def r03(t):
    marked = t.customer.withColumn("side", F.when(F.col("c_nationkey") < 5, "low").otherwise("high"))
    return pivot_count(marked, "c_mktsegment", "side", ["low", "high"])


@check(
    "r04_unpivot",
    """SELECT measure, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total FROM
       (UNPIVOT lineitem ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME measure VALUE amount) GROUP BY measure""",
)
def r04(t):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    long = unpivot(t.lineitem.select(*names), [], names, "measure", "amount")
    return long.groupBy("measure").agg(F.sum(cents("amount")).cast("double").alias("total"))


@check(
    "r05_transpose",
    "SELECT CAST(year AS VARCHAR) AS year, " + ", ".join(f"max(total) FILTER (r_name = '{r}') AS \"{r}\"" for r in REGIONS) + f" FROM ({REGION_YEARS}) GROUP BY year",
)
def r05(t):
    wide = pivot_strict(region_years(t), "r_name", "year", "total")
    return transpose(wide, "r_name", "year")


@check(
    "r05_round_trip",
    f"SELECT r_name, CAST(year AS VARCHAR) AS year, round(total, 2) AS total FROM ({REGION_YEARS})",
)
def r05_back(t):
    wide = pivot_strict(region_years(t), "r_name", "year", "total")
    years = [c for c in wide.columns if c != "r_name"]
    return unpivot(wide, "r_name", years, "year", "total").withColumns(rounded("total", digits=2))


@check(
    "r02_pivot_sparse",
    """SELECT l_returnflag, l_suppkey, CASE WHEN l_quantity < 50 THEN l_partkey END AS part, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
       FROM lineitem GROUP BY ALL""",
)
def r02_sparse(t):
    lines = t.lineitem.select("l_returnflag", "l_suppkey", F.when(F.col("l_quantity") < 50, F.col("l_partkey")).alias("part"), cents("l_quantity").alias("quantity"))
    return pivot_sparse(lines, ["l_returnflag", "l_suppkey"], "part", "quantity", 100).long("quantity").withColumns(double("quantity"))


@check(
    "r02_pivot_sparse_columns",
    """SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_partkey = 3) AS DOUBLE) AS "3", CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_partkey = 150) AS DOUBLE) AS "150"
       FROM lineitem WHERE l_partkey IN (3, 150) GROUP BY 1""",
)
def r02_sparse_columns(t):
    lines = t.lineitem.select("l_suppkey", "l_partkey", cents("l_quantity").alias("quantity"))
    return pivot_sparse(lines, "l_suppkey", "l_partkey", "quantity", 100).wide([3, 150]).withColumns(double("3", "150"))
