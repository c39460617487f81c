"""F, J and U: filters, joins and stacking."""

from pyspark.sql import functions as F

from chartframes.functions import fill_from, same_text, within
from chartframes.operators.aggregate import value_counts
from chartframes.operators.ordered import row_number
from chartframes.operators.rows import add_row, align_frames, in_groups, in_roles, lookup, members, recode, stack, stack_tagged
from chartframes.operators.skew import with_group_values
from checks.registry import cents, check, keyed


@check("f01_compare", "SELECT * FROM lineitem WHERE l_quantity > 45 AND l_shipdate >= TIMESTAMP '1998-01-01'")
def f01(t):
    return t.lineitem.where(F.col("l_quantity") > 45).where("l_shipdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00'")


@check("f02_all_of", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 100000 AND o_orderpriority <> '5-LOW'")
def f02(t):
    tests = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000) & (F.col("o_orderpriority") != "5-LOW")
    return t.orders.where(tests).select("o_orderkey")


@check("f03_in_list", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def f03(t):
    return t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@check("f03_not_in_list", "SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def f03_not(t):
    return t.customer.where(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")


@check(
    "f04_range",
    """SELECT count(*) FILTER (l_quantity BETWEEN 10 AND 20) AS both_ends,
       count(*) FILTER (l_quantity > 10 AND l_quantity <= 20) AS right_end FROM lineitem""",
)
def f04(t):
    return t.lineitem.agg(
        F.count_if(within("l_quantity", 10, 20)).alias("both_ends"),
        F.count_if(within("l_quantity", 10, 20, "right")).alias("right_end"),
    )


@check(
    "f05_drop_nulls",
    """SELECT c_custkey, o_orderkey FROM customer JOIN (SELECT * REPLACE (CASE WHEN o_totalprice > 450000 THEN o_custkey END AS o_custkey) FROM orders) ON c_custkey = o_custkey""",
)
def f05(t):
    large = keyed(t, 450000)
    joined = t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.dropna(subset=["o_orderkey"]).select("c_custkey", "o_orderkey")


@check(
    "f06_patterns",
    """SELECT p_partkey, regexp_matches(p_name, 'o+l?d') AS has, starts_with(p_name, 'small') AS begins,
       ends_with(p_brand, '1') AS ends FROM part""",
)
def f06(t):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        name.rlike("o+l?d").alias("has"),
        name.startswith("small").alias("begins"),
        F.col("p_brand").endswith("1").alias("ends"),
    )


@check("f07_or_not", "SELECT o_orderkey FROM orders WHERE (o_totalprice > 400000 OR o_totalprice < 5000) AND NOT o_orderstatus = 'P'")
def f07(t):
    far = (F.col("o_totalprice") > 400000) | (F.col("o_totalprice") < 5000)
    return t.orders.where(far & ~(F.col("o_orderstatus") == "P")).select("o_orderkey")


@check("f08_ignore_case", "SELECT event_id FROM events WHERE upper(event_type) = 'PURCHASE'")
def f08(t):
    return t.events.where(same_text("event_type", "Purchase")).select("event_id")


@check(
    "f09_row_position",
    "SELECT o_orderkey FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) - 1 > 1",
)
def f09(t):
    numbered = row_number(t.orders.select("o_orderkey"), None, "o_orderkey", "index")
    return numbered.where(F.col("index") - 1 > 1).select("o_orderkey")


@check(
    "j01_left_join",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * REPLACE (CASE WHEN o_totalprice > 450000 THEN o_custkey END AS o_custkey) FROM orders)
       ON c_custkey = o_custkey""",
)
def j01(t):
    large = keyed(t, 450000).withColumnRenamed("o_custkey", "c_custkey")
    return lookup(t.customer, large, "c_custkey").select("c_custkey", "o_orderkey")


@check(
    "j02_inner_join",
    """SELECT p_type, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""",
)
def j02(t):
    joined = lookup(t.lineitem.withColumnRenamed("l_partkey", "p_partkey"), t.part, "p_partkey", "inner")
    return joined.groupBy("p_type").agg(F.count("*").alias("n"), F.sum(cents("l_quantity")).cast("double").alias("qty"))


@check(
    "j01_left_join_split",
    """SELECT e.event_id, l.quality, l.toxic FROM events e LEFT JOIN labels l ON l.doc_id = e.user_id""",
)
def j01_split(t):
    labels = t.labels.withColumnRenamed("doc_id", "user_id")
    return lookup(t.events, labels, "user_id", split_hot=True).select("event_id", "quality", "toxic")


@check(
    "j02_inner_join_split",
    """SELECT s_nationkey, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey""",
)
def j02_split(t):
    suppliers = t.supplier.withColumnRenamed("s_suppkey", "l_suppkey")
    joined = lookup(t.lineitem, suppliers, "l_suppkey", "inner", split_hot=True)
    return joined.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.sum(cents("l_quantity")).cast("double").alias("qty"))


@check(
    "j03_right_join",
    """SELECT c_custkey, c_name, o_orderkey FROM (SELECT * REPLACE (CASE WHEN o_totalprice > 450000 THEN o_custkey END AS o_custkey) FROM orders)
       RIGHT JOIN customer ON c_custkey = o_custkey""",
)
def j03(t):
    large = keyed(t, 450000).withColumnRenamed("o_custkey", "c_custkey")
    return lookup(large, t.customer, "c_custkey", "right").select("c_custkey", "c_name", "o_orderkey")


@check(
    "j04_two_roles",
    """SELECT a.n_name AS from_n_name, b.n_name AS to_n_name, count(*) AS n FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
       JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation a ON a.n_nationkey = c_nationkey
       LEFT JOIN nation b ON b.n_nationkey = s_nationkey GROUP BY 1, 2""",
)
def j04(t):
    flows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count("*").alias("n"))
    )
    names = t.nation.select("n_nationkey", "n_name")
    named = in_roles(flows, names, "n_nationkey", {"c_nationkey": "from_", "s_nationkey": "to_"})
    return named.select("from_n_name", "to_n_name", "n")


@check(
    "j05_small_lookup",
    "SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
)
def j05(t):
    nations = t.nation.withColumnsRenamed({"n_nationkey": "s_nationkey", "n_regionkey": "r_regionkey"})
    return lookup(lookup(t.supplier, nations, "s_nationkey"), t.region, "r_regionkey").select("s_suppkey", "n_name", "r_name")


@check(
    "j06_membership",
    """SELECT o_orderkey FROM orders WHERE o_custkey IN
       (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 12)""",
)
def j06(t):
    return in_groups(t.orders, "o_custkey", F.count("*") >= 12).select("o_orderkey")


@check("j06_members", "SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def j06_members(t):
    nations = t.supplier.where("s_acctbal > 5000").withColumnRenamed("s_nationkey", "c_nationkey")
    return members(t.customer, "c_nationkey", nations).select("c_custkey")


@check(
    "j07_rate_per_element",
    """SELECT o_orderkey, round(o_totalprice / n, 6) AS per_order FROM orders
       JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) ON k = o_custkey""",
)
def j07(t):
    per = F.round(F.col("o_totalprice") / F.col("n"), 6)
    return with_group_values(t.orders, "o_custkey", n=F.count("*")).select("o_orderkey", per.alias("per_order"))


@check(
    "j08_join_counts",
    """SELECT p_brand, count(*) AS total, count(*) FILTER (l_returnflag = 'R') AS returned
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
)
def j08(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    returned = F.count_if(F.col("l_returnflag") == "R").alias("returned")
    return joined.groupBy("p_brand").agg(F.count("*").alias("total"), returned)


@check(
    "c08_recode_null",
    """SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'clicked' ELSE event_type END AS event_type
       FROM events""",
)
def c08_null(t):
    return recode(t.events, "event_type", {"view": None, "click": "clicked"}).select("event_id", "event_type")


@check(
    "c08_recode",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'clicked' ELSE event_type END AS event_type
       FROM events""",
)
def c08(t):
    return recode(t.events.select("event_id", "event_type"), "event_type", {"view": "seen", "click": "clicked"})


@check(
    "d02_state_abbreviation",
    "SELECT c_custkey, n_nationkey AS code FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def d02(t):
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    codes = t.nation.select("n_name", F.col("n_nationkey").cast("string"))
    return recode(named, "n_name", codes, "code").select("c_custkey", F.col("code").cast("int").alias("code"))


@check(
    "c05_fill_from",
    """SELECT c_custkey, coalesce(o_orderpriority, c_mktsegment) AS label, coalesce(o_orderstatus, 'None') AS status
       FROM customer LEFT JOIN (SELECT * REPLACE (CASE WHEN o_totalprice > 450000 THEN o_custkey END AS o_custkey) FROM orders) ON c_custkey = o_custkey""",
)
def c05(t):
    large = keyed(t, 450000)
    joined = t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        "c_custkey",
        fill_from("o_orderpriority", "c_mktsegment").alias("label"),
        fill_from("o_orderstatus", F.lit("None")).alias("status"),
    )


@check(
    "u01_stack",
    """SELECT year, count(*) AS n FROM (SELECT year(o_orderdate) AS year FROM orders UNION ALL
       SELECT year(l_shipdate) FROM lineitem) GROUP BY year""",
)
def u01(t):
    both = stack(t.orders.select(F.year("o_orderdate").alias("year")), t.lineitem.select(F.year("l_shipdate").alias("year")))
    return both.groupBy("year").agg(F.count("*").alias("n"))


@check(
    "u01_stack_tagged",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'pending' END AS tag, count(*) AS n
       FROM orders GROUP BY 1""",
)
def u01_tagged(t):
    parts = {"filled": "F", "open": "O", "pending": "P"}
    slices = {tag: t.orders.where(F.col("o_orderstatus") == code) for tag, code in parts.items()}
    return stack_tagged(slices, "tag").groupBy("tag").agg(F.count("*").alias("n"))


@check(
    "u02_add_row",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT -1, 'DC', NULL, 0.0""",
)
def u02(t):
    return add_row(t.supplier, s_suppkey=-1, s_name="DC", s_acctbal=0.0)


@check(
    "u03_side_by_side",
    """SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 6) AS share
       FROM events GROUP BY event_type""",
)
def u03(t):
    both = value_counts(t.events, "event_type")
    return both.select("event_type", F.col("total").alias("n"), F.round("percentage", 6).alias("share"))


@check(
    "u03_align_three",
    """WITH c AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nation, count(*) AS n, round(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE), 2) AS balance FROM customer GROUP BY 1),
       s AS (SELECT s_nationkey AS nation, count(*) AS n FROM supplier WHERE s_nationkey % 3 > 0 GROUP BY 1),
       n AS (SELECT n_nationkey AS nation, n_name FROM nation WHERE n_regionkey <> 2 UNION ALL SELECT NULL, 'nowhere'),
       k AS (SELECT nation FROM c UNION SELECT nation FROM s UNION SELECT nation FROM n)
       SELECT k.nation, c.n AS "customers n", c.balance AS "customers balance", s.n AS "suppliers n", n.n_name AS "names n_name"
       FROM k LEFT JOIN c ON k.nation IS NOT DISTINCT FROM c.nation LEFT JOIN s ON k.nation IS NOT DISTINCT FROM s.nation LEFT JOIN n ON k.nation IS NOT DISTINCT FROM n.nation""",
)
def u03_align(t):
    nation = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    customers = t.customer.groupBy(nation.alias("nation")).agg(F.count("*").alias("n"), F.round(F.sum(cents("c_acctbal")).cast("double"), 2).alias("balance"))
    suppliers = t.supplier.where("s_nationkey % 3 > 0").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    names = add_row(t.nation.where("n_regionkey <> 2").select(F.col("n_nationkey").alias("nation"), "n_name"), n_name="nowhere")
    return align_frames({"customers": customers, "suppliers": suppliers, "names": names}, "nation")
