"""P: projection and schema verbs."""

from pyspark.sql import functions as F

from chartframes.operators.columns import (
    all_except,
    apply_to,
    drop_empty,
    keep_complete,
    rename,
    select,
    sort_columns,
)
from chartframes.operators.ordered import row_number
from chartframes.operators.reshape import pivot_sum
from chartframes.operators.rows import in_groups
from checks.registry import cents, check, double


@check("p01_select_reorder", "SELECT p_brand, p_partkey FROM part")
def p01(t):
    return select(t.part, ["p_brand", "p_partkey"])


@check(
    "p02_add_columns",
    """SELECT p_partkey, p_size * 2 AS double_size, p_size + 1 AS p_size FROM part""",
)
def p02(t):
    added = t.part.withColumns({"double_size": F.col("p_size") * 2, "p_size": F.col("p_size") + 1})
    return added.select("p_partkey", "double_size", "p_size")


@check(
    "p03_same_expression",
    """SELECT l_orderkey, l_partkey, l_linenumber, round(l_discount * 100, 2) AS l_discount,
       round(l_tax * 100, 2) AS l_tax FROM lineitem""",
)
def p03(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_discount", "l_tax")
    return apply_to(lines, ["l_discount", "l_tax"], lambda c: F.round(c * 100, 2))


@check("p05_all_except", "SELECT * EXCLUDE (s_name, s_acctbal) FROM supplier")
def p05(t):
    return all_except(t.supplier, "s_name", "s_acctbal")


@check("p06_rename", 'SELECT c_custkey AS id, c_name AS "Customer Name.", c_acctbal AS "Balance [M$]" FROM customer')
def p06(t):
    by_map = rename(t.customer.select("c_custkey", "c_name", "c_acctbal"), {"c_custkey": "id", "c_name": "name"})
    return rename(by_map, ["id", "Customer Name.", "Balance [M$]"])


@check("p07_drop", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def p07(t):
    return t.customer.drop("c_nationkey", "c_mktsegment")


@check("p08_sort_columns", "SELECT s_name, s_acctbal, s_nationkey, s_suppkey FROM supplier")
def p08(t):
    return sort_columns(t.supplier, left=["s_name"], right=["s_suppkey"])


@check(
    "p09_row_number",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_num FROM orders",
)
def p09(t):
    return row_number(t.orders.select("o_orderkey", "o_totalprice"), None, ["-o_totalprice", "o_orderkey"], "row_num").drop("o_totalprice")


@check(
    "p09_row_number_spread",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_num FROM orders",
)
def p09_spread(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return row_number(orders, None, ["-o_totalprice", "o_orderkey"], "row_num", limit=1000).drop("o_totalprice")


def status_matrix(t):
    prices = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderstatus", cents("o_totalprice").alias("price"))
    wide = pivot_sum(prices, "year", "o_orderstatus", "price", ["F", "O", "P", "X"])
    return wide.withColumns(double("F", "O", "P", "X"))


@check(
    "p10_drop_empty",
    """SELECT year(o_orderdate) AS year,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS DOUBLE) AS "F",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS DOUBLE) AS "O",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P') AS DOUBLE) AS "P"
       FROM orders GROUP BY 1""",
)
def p10(t):
    return drop_empty(status_matrix(t))


@check(
    "p11_keep_complete",
    """SELECT year(o_orderdate) AS year,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS DOUBLE) AS "F",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS DOUBLE) AS "O",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P') AS DOUBLE) AS "P"
       FROM orders GROUP BY 1""",
)
def p11(t):
    return keep_complete(status_matrix(t), 7, keep=["year"])


@check(
    "p12_keep_series",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
       (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING max(o_totalprice) < 400000)""",
)
def p12(t):
    return in_groups(t.orders, "o_custkey", F.max("o_totalprice") < 400000).select("o_orderkey", "o_custkey")


@check("p13_literal", "SELECT c_custkey, 'UNDEFINED' AS bin, 0 AS size FROM customer")
def p13(t):
    return t.customer.select("c_custkey", F.lit("UNDEFINED").alias("bin"), F.lit(0).alias("size"))


@check("p14_alias", "SELECT s_suppkey AS supplier, s_acctbal AS balance FROM supplier")
def p14(t):
    return t.supplier.select(F.col("s_suppkey").alias("supplier"), F.col("s_acctbal").alias("balance"))
