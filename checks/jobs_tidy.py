"""K: row-wise jobs."""

from pyspark.sql import functions as F

from chartframes.columns import ordering
from chartframes.functions import degrees, title_case
from chartframes.operators.columns import sort_columns
from chartframes.plans import bin_labels, company_tiers, log_size, unit_conversion
from chartframes.plans.tidy import feet_and_inches
from checks.registry import cents, check, rounded


@check(
    "k18_log_size",
    """SELECT c_custkey, round(pow(1 + log10(c_acctbal) - (SELECT min(log10(c_acctbal)) FROM customer WHERE c_acctbal > 0), 2), 1) AS size
       FROM customer WHERE c_acctbal > 0""",
)
def k18(t):
    return log_size(t.customer, "c_acctbal").select("c_custkey", "size")


PRICE_BANDS = [(None, 5, "budget"), (5, 25, "low"), (25, 50, "middle"), (50, 75, "high"), (75, None, "top")]


@check(
    "k19_bin_labels",
    """SELECT CASE WHEN v <= 5 THEN 'budget' WHEN v <= 25 THEN 'low' WHEN v <= 50 THEN 'middle' WHEN v <= 75 THEN 'high'
       ELSE 'top' END AS bin, count(*) AS n
       FROM (SELECT l_extendedprice / 1000 AS v FROM lineitem) GROUP BY 1""",
)
def k19(t):
    lines = t.lineitem.select((F.col("l_extendedprice") / 1000).alias("v"))
    return bin_labels(lines, "v", PRICE_BANDS, "unknown").groupBy("bin").agg(F.count("*").alias("n"))


@check(
    "k25_unit_conversion",
    """SELECT p_partkey, upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1])
         || split_part(p_name, ' ', 2)[2:] AS name, round(p_size * 0.39370079::DOUBLE, 6) AS total_inches,
       CAST(floor(p_size * 0.39370079::DOUBLE / 12) AS BIGINT) AS feet,
       round(p_size * 0.39370079::DOUBLE - 12 * floor(p_size * 0.39370079::DOUBLE / 12), 6) AS inches,
       round(p_retailprice / 453.59237::DOUBLE, 6) AS pounds FROM part""",
)
def k25(t):
    sized = feet_and_inches(t.part.withColumn("name", title_case("p_name")), "p_size")
    out = unit_conversion(sized, {"pounds": ("p_retailprice", 1.0, 453.59237)})
    names = ["total_inches", "feet", "inches", "pounds"]
    return out.select("p_partkey", "name", *names).withColumns(rounded("total_inches", "inches", "pounds"))


@check("k25_longest", "SELECT p_partkey, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 15")
def k25_longest(t):
    longest = t.part.select("p_partkey", "p_size").orderBy(*ordering(["-p_size", "p_partkey"])).limit(15)
    return longest.orderBy("p_size", "p_partkey")


# fixed values: lower bounds, tier labels and marker sizes
TIERS = [(4.0, "> $4M", 4), (3.0, "> $3M", 3), (2.0, "> $2M", 2), (1.0, "> $1M", 1)]


@check(
    "k34_company_tiers",
    """WITH s AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
         FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL),
       m AS (SELECT *, round(spend / 1000000, 1) AS mils FROM s)
       SELECT c_custkey, mils AS spend, round(c_acctbal, 2) AS balance, CASE WHEN mils > 4 THEN '> $4M' WHEN mils > 3 THEN '> $3M' WHEN mils > 2 THEN '> $2M'
         WHEN mils > 1 THEN '> $1M' END AS tier, CAST(CASE WHEN mils > 4 THEN 4 WHEN mils > 3 THEN 3 WHEN mils > 2 THEN 2 WHEN mils > 1 THEN 1 END AS DOUBLE) AS marker_size,
         'sells to<br>' || lower(c_mktsegment) AS text_wrapped, CAST(c_nationkey AS DOUBLE) AS lat, -(CAST(c_nationkey AS DOUBLE) + 0.5) AS long
       FROM m JOIN customer USING (c_custkey, c_name, c_nationkey, c_mktsegment)""",
)
def k34(t):
    spend = t.orders.groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("spend"))
    raw = t.customer.join(spend, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey",
        "c_nationkey",
        F.concat(F.lit("$"), F.format_number("spend", 2)).alias("spend"),
        F.format_number("c_acctbal", 2).alias("balance"),
        F.concat(F.lit("sells to "), F.lower("c_mktsegment")).alias("text"),
    )
    key = F.col("n_nationkey")
    coords = t.nation.select(
        key.alias("c_nationkey"),
        degrees(F.concat(key.cast("string"), F.lit("°N"))).alias("lat"),
        degrees(F.concat((key + 0.5).cast("string"), F.lit("°W"))).alias("long"),
    )
    currencies = {"spend": (1e6, 1), "balance": (1, 2)}
    out = company_tiers(raw, "c_nationkey", currencies, "spend", TIERS, coords, ("text", 8))
    kept = sort_columns(out.drop("c_nationkey"), left=["c_custkey"], right=["text_wrapped"])
    return kept.withColumn("marker_size", F.col("marker_size").cast("double"))
