"""K: rankings, Pareto curves and roll-ups."""

from pyspark.sql import functions as F

from chartframes.functions import bold_label
from chartframes.operators.aggregate import counts
from chartframes.plans import (
    first_item_with_totals,
    pareto,
    ranked_crosstab,
    region_rollup,
    top_groups,
    top_n_per_group,
)
from checks.registry import cents, check, double, rounded

REVENUE = """SELECT n_name, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS total
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name"""

CURVE = f"""SELECT n_name, CAST(total AS DOUBLE) AS total,
    round(100 * CAST(sum(total) OVER (ORDER BY total DESC, n_name ROWS UNBOUNDED PRECEDING) AS DOUBLE)
    / CAST(sum(total) OVER () AS DOUBLE), 6) AS cum_pct FROM ({REVENUE})"""


def revenue_lines(t):
    revenue = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    return (
        t.lineitem.select("l_suppkey", revenue.alias("revenue"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )


@check("k06_pareto", CURVE)
def k06(t):
    return pareto(revenue_lines(t), "n_name", "revenue").withColumns(double("total") | rounded("cum_pct"))


@check("k06_pareto_kept", f"SELECT * FROM ({CURVE}) WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_19')")
def k06_kept(t):
    kept = pareto(revenue_lines(t), "n_name", "revenue", ["NATION_1", "NATION_7", "NATION_19"])
    return kept.withColumns(double("total") | rounded("cum_pct"))


@check(
    "k07_region_rollup",
    """SELECT CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN r_name ELSE 'Others' END AS region,
       CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total FROM supplier
       LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def k07(t):
    balances = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "n_name", cents("s_acctbal").alias("balance")
    )
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    return region_rollup(balances, "n_name", regions, ["ASIA", "EUROPE"], "balance").withColumns(double("total"))


@check(
    "k16_top_per_group",
    """SELECT p_brand, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank
       FROM part QUALIFY rank <= 10""",
)
def k16(t):
    best = top_n_per_group(t.part, "p_brand", "p_retailprice", 10, ["p_partkey"])
    return best.select("p_brand", "p_partkey", "p_retailprice", "rank")


@check(
    "k16_top_groups",
    """SELECT p_type, round(avg(p_retailprice), 6) AS mean FROM (SELECT p_type, p_retailprice FROM part
         QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) <= 10)
       GROUP BY p_type ORDER BY avg(p_retailprice) DESC, p_type LIMIT 3""",
)
def k16_groups(t):
    best = top_n_per_group(t.part, "p_type", "p_retailprice", 10, ["p_partkey"])
    return top_groups(best, "p_type", "p_retailprice", 3).withColumns(rounded("mean"))


@check(
    "k17_first_item",
    """WITH f AS (SELECT o_custkey, count(*) AS total, arg_min(o_orderkey, o_orderkey) AS o_orderkey,
         arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey)
       SELECT o_custkey, total, o_orderkey, '<b>' || o_custkey || '</b><br>' || o_orderpriority AS label
       FROM f ORDER BY total DESC, o_custkey LIMIT 10""",
)
def k17(t):
    first = first_item_with_totals(t.orders, "o_custkey", ["o_orderkey"], ["o_orderkey", "o_orderpriority"], 10)
    return first.select("o_custkey", "total", "o_orderkey", bold_label("o_custkey", "o_orderpriority").alias("label"))


@check(
    "k27_ranked_crosstab",
    """WITH j AS (SELECT p_brand, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey),
       c AS (SELECT p_brand, count(*) AS total, count(*) FILTER (l_returnflag = 'A') AS a,
         count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM j GROUP BY p_brand),
       s AS (SELECT sum(total) AS all_rows FROM c)
       SELECT p_brand, total, round(total / all_rows, 8) AS percentage, dense_rank() OVER (ORDER BY total DESC) AS rank,
         round(a / all_rows, 8) AS "A", round(n / all_rows, 8) AS "N", round(r / all_rows, 8) AS "R" FROM c, s""",
)
def k27(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    out = ranked_crosstab(joined, "p_brand", "l_returnflag", ["A", "N", "R"])
    return out.withColumns(rounded("percentage", "A", "N", "R", digits=8))


@check("k26_counts", "SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity")
def k26_counts(t):
    return counts(t.lineitem, "l_quantity")
