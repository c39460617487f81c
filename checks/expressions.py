"""C, T, X and D: conditions, cleaning and scalar functions."""

from pyspark.sql import functions as F

from chartframes.functions import (
    bin_label,
    bold_label,
    calendar_parts,
    checked_label,
    choose,
    convert,
    currency,
    date_of,
    degrees,
    first_match,
    floor_divide,
    iso_week,
    label_violations,
    localize,
    number_or,
    others,
    pad_end,
    parse_date,
    parse_datetime,
    percent_columns,
    ratio_percent,
    replace_all,
    replace_first,
    replace_literal,
    safe_cast,
    slice_text,
    split_get,
    strict_cast,
    title_case,
    weekday_number,
    wrap_text,
    year_month,
    zero_pad,
)
from checks.registry import check, rounded


@check("c01_choose_literal", "SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS kind FROM orders")
def c01(t):
    kind = choose(F.col("o_totalprice") > 250000, F.lit("large"), F.lit("small"))
    return t.orders.select("o_orderkey", kind.alias("kind"))


@check(
    "c02_choose_column",
    """SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN l_quantity > 25 THEN l_returnflag ELSE l_linestatus END AS picked FROM lineitem""",
)
def c02(t):
    picked = choose(F.col("l_quantity") > 25, "l_returnflag", "l_linestatus")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", picked.alias("picked"))


@check(
    "c03_first_match",
    "SELECT p_partkey, CASE WHEN p_size > 40 THEN 3 WHEN p_size > 20 THEN 2 WHEN p_size > 10 THEN 1 END::DOUBLE AS tier FROM part",
)
def c03(t):
    size = F.col("p_size")
    tier = first_match((size > 40, 3), (size > 20, 2), (size > 10, 1))
    return t.part.select("p_partkey", tier.cast("double").alias("tier"))


@check(
    "c04_bins",
    """SELECT CASE WHEN p_size <= 8 THEN 'small' WHEN p_size <= 24 THEN 'medium' WHEN p_size <= 36 THEN 'large'
       ELSE 'unsized' END AS bin, count(*) AS n FROM part GROUP BY 1""",
)
def c04(t):
    bins = [(0, 8, "small"), (8, 24, "medium"), (24, 36, "large")]
    return t.part.groupBy(bin_label("p_size", bins, "unsized").alias("bin")).agg(F.count("*").alias("n"))


STATUS_COUNTS = """SELECT o_custkey, nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS f,
    count(*) FILTER (o_orderstatus = 'P' AND o_totalprice > 400000) AS p FROM orders GROUP BY o_custkey"""


def status_counts(t):
    f = F.nullif(F.count_if(F.col("o_orderstatus") == "F"), F.lit(0))
    p = F.count_if((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000))
    return t.orders.groupBy("o_custkey").agg(f.alias("f"), p.alias("p"))


@check("c06_fill_zero", f"SELECT o_custkey, coalesce(f, 0) AS f, p FROM ({STATUS_COUNTS})")
def c06(t):
    return status_counts(t).fillna(0, ["f", "p"])


@check(
    "c07_repaired_ratio",
    f"""SELECT o_custkey, round(CASE WHEN p = 0 THEN CASE WHEN coalesce(f, 0) = 0 THEN 0.0 END
        ELSE 100.0 * coalesce(f, 0) / p END, 6)::DOUBLE AS ratio FROM ({STATUS_COUNTS})""",
)
def c07(t):
    return status_counts(t).select("o_custkey", F.round(ratio_percent("f", "p"), 6).alias("ratio"))


@check(
    "c09_others",
    """SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE 'Others' END AS segment,
       count(*) AS n FROM customer GROUP BY 1""",
)
def c09(t):
    return t.customer.groupBy(others("c_mktsegment", ["BUILDING", "MACHINERY"]).alias("segment")).agg(F.count("*").alias("n"))


@check("t01_strict_cast", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM orders")
def t01(t):
    return t.orders.select("o_orderkey", strict_cast(F.substring("o_orderpriority", 1, 1), "int").alias("priority"))


@check(
    "t01_unsigned",
    """SELECT p_partkey, CAST(CASE WHEN p_size BETWEEN 0 AND 255 THEN p_size END AS DOUBLE) AS size,
       CAST(CASE WHEN trunc(p_retailprice)::BIGINT - 950 BETWEEN 0 AND 65535 THEN trunc(p_retailprice)::BIGINT - 950 END AS DOUBLE) AS above FROM part""",
)
def t01_unsigned(t):
    return t.part.select(
        "p_partkey",
        strict_cast("p_size", "uint8").cast("double").alias("size"),
        safe_cast(F.col("p_retailprice").cast("int") - 950, "uint16").cast("double").alias("above"),
    )


@check("t02_safe_cast", "SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#1', '') AS DOUBLE) AS number FROM part")
def t02(t):
    return t.part.select("p_partkey", safe_cast(F.replace("p_brand", F.lit("Brand#1"), F.lit("")), "double").alias("number"))


@check(
    "t03_label_violations",
    """SELECT o_orderpriority, count(*) AS n FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') GROUP BY 1""",
)
def t03(t):
    return label_violations(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])


@check("t03_checked_label", "SELECT o_orderkey, o_orderstatus FROM orders")
def t03_checked(t):
    return t.orders.select("o_orderkey", checked_label("o_orderstatus", ["F", "O", "P"]).alias("o_orderstatus"))


@check("t04_currency", "SELECT o_orderkey, o_totalprice AS price, round(o_totalprice / 1000, 1) AS thousands FROM orders")
def t04(t):
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    parsed = t.orders.select("o_orderkey", text.alias("text"))
    return parsed.select("o_orderkey", currency("text").alias("price"), currency("text", 1000, 1).alias("thousands"))


@check(
    "t05_markers",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 0 WHEN '5-LOW' THEN 50
       ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS years FROM orders""",
)
def t05(t):
    worded = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Less than 1 year").when(
        F.col("o_orderpriority") == "5-LOW", "More than 50 years"
    )
    text = worded.otherwise(F.substring("o_orderpriority", 1, 1))
    years = number_or("text", {"Less than 1 year": 0, "More than 50 years": 50}, "int")
    return t.orders.select("o_orderkey", text.alias("text")).select("o_orderkey", years.alias("years"))


@check(
    "t06_degrees",
    """SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) + 0.25 AS lat, -(CAST(s_nationkey AS DOUBLE) + 100.5) AS long
       FROM supplier""",
)
def t06(t):
    lat = F.concat((F.col("s_nationkey") + 0.25).cast("string"), F.lit("°N"))
    long = F.concat((F.col("s_nationkey") + 100.5).cast("string"), F.lit("°W"))
    texts = t.supplier.select("s_suppkey", lat.alias("lat"), long.alias("long"))
    return texts.withColumns({c: degrees(c) for c in ("lat", "long")})


@check("t07_boolean", "SELECT o_orderkey, o_totalprice > 400000 OR o_totalprice < 5000 AS far FROM orders")
def t07(t):
    far = (F.col("o_totalprice") > 400000) | (F.col("o_totalprice") < 5000)
    return t.orders.select("o_orderkey", far.cast("boolean").alias("far"))


@check("x01_replace_first", "SELECT p_partkey, regexp_replace(p_name, '[lo]', '<>') AS name FROM part")
def x01(t):
    return t.part.select("p_partkey", replace_first("p_name", "[lo]", "<>").alias("name"))


@check("x02_replace_all", "SELECT p_partkey, replace(p_name, 'l', '$1') AS name FROM part")
def x02(t):
    return t.part.select("p_partkey", replace_all("p_name", "l", "$1").alias("name"))


@check(
    "x03_replace_literal",
    r"SELECT doc_id, md5(regexp_replace(text, '\.', '$')) AS digest FROM documents",
)
def x03(t):
    return t.documents.select("doc_id", F.md5(replace_literal("text", ".", "$")).alias("digest"))


@check(
    "x04_slice",
    "SELECT c_custkey, c_name[1:4] AS head, right(c_name, 2) AS tail, substr(c_name, 4) AS rest FROM customer",
)
def x04(t):
    return t.customer.select(
        "c_custkey",
        slice_text("c_name", 0, 4).alias("head"),
        slice_text("c_name", -2, 2).alias("tail"),
        slice_text("c_name", 3).alias("rest"),
    )


@check(
    "x05_split",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS adjective, nullif(split_part(p_name, ' ', 2), '') AS noun FROM part",
)
def x05(t):
    return t.part.select(
        "p_partkey", split_get("p_name", " ").alias("adjective"), split_get("p_name", " ", 1).alias("noun")
    )


@check("x06_upper", "SELECT event_id, upper(event_type) AS event_type FROM events")
def x06(t):
    return t.events.select("event_id", F.upper("event_type").alias("event_type"))


@check(
    "x07_title_case",
    """SELECT p_partkey, upper(a[1]) || a[2:] || '-' || upper(b[1]) || b[2:] || '_' || upper(c[1]) || c[2:] AS name
       FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, lower(p_brand[1:5]) AS c FROM part)""",
)
def x07(t):
    text = F.concat(F.translate("p_name", " ", "-"), F.lit("_"), F.substring("p_brand", 1, 5))
    return t.part.select("p_partkey", title_case(text).alias("name"))


@check(
    "x08_pad",
    """SELECT p_partkey, CASE WHEN length(CAST(p_size AS VARCHAR)) < 2 THEN lpad(CAST(p_size AS VARCHAR), 2, '0')
       ELSE CAST(p_size AS VARCHAR) END AS "left", CASE WHEN length(p_brand) < 8 THEN rpad(p_brand, 8, '0') ELSE p_brand END AS "right"
       FROM part""",
)
def x08(t):
    return t.part.select("p_partkey", zero_pad("p_size", 2).alias("left"), pad_end("p_brand", 8, "0").alias("right"))


@check("x09_concat", "SELECT p_partkey, '<b>' || p_brand || '</b><br>' || p_name || '<br>' || p_size AS label FROM part")
def x09(t):
    return t.part.select("p_partkey", bold_label("p_brand", "p_name", "p_size").alias("label"))


@check(
    "x10_parse",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE)::VARCHAR AS month,
       CAST(date_trunc('year', CAST(ts AS DATE)) AS DATE)::VARCHAR AS year, CAST(date_trunc('minute', ts) AS VARCHAR) AS minute FROM events""",
)
def x10(t):
    texts = t.events.select(
        "event_id",
        F.date_format("ts", "MM/dd/yyyy").alias("day"),
        F.date_format("ts", "yyyy-MM").alias("month"),
        F.date_format("ts", "yyyy").alias("year"),
        F.date_format("ts", "MM/dd/yyyy HH:mm").alias("minute"),
    )
    return texts.select(
        "event_id",
        parse_date("day", "MM/dd/yyyy").cast("string").alias("day"),
        parse_date("month", "yyyy-MM").cast("string").alias("month"),
        parse_date("year", "yyyy").cast("string").alias("year"),
        parse_datetime("minute", "MM/dd/yyyy HH:mm").cast("string").alias("minute"),
    )


@check(
    "x11_year_month",
    "SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, strftime(o_orderdate, '%Y_%m') AS year_month FROM orders",
)
def x11(t):
    return t.orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        year_month("o_orderdate").alias("year_month"),
    )


@check(
    "x12_calendar_parts",
    """SELECT event_id, year(ts) AS year, month(ts) AS month, strftime(ts, '%b') AS month_name, day(ts) AS day,
       strftime(ts, '%a') AS day_name, dayofweek(ts) AS day_num, hour(ts) AS hour, week(ts) AS week FROM events""",
)
def x12(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in calendar_parts("ts").items()])


@check("x13_date", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, dayofweek(ts) AS day_num FROM events")
def x13(t):
    return t.events.select("event_id", date_of("ts").cast("string").alias("day"), weekday_number("ts").alias("day_num"))


@check("x14_iso_week", "SELECT o_orderkey, week(o_orderdate) AS week FROM orders")
def x14(t):
    return t.orders.select("o_orderkey", iso_week("o_orderdate").alias("week"))


@check(
    "x15_arithmetic",
    """SELECT p_partkey, CAST(floor(p_size / 10) AS BIGINT) AS tens, round(p_size * 0.39370079::DOUBLE, 6) AS inches,
       round(p_retailprice / 453.59237::DOUBLE, 6) AS pounds FROM part""",
)
def x15(t):
    return t.part.select(
        "p_partkey",
        floor_divide("p_size", 10).alias("tens"),
        F.round(convert("p_size", 0.39370079), 6).alias("inches"),
        F.round(convert("p_retailprice", divisor=453.59237), 6).alias("pounds"),
    )


@check(
    "x16_log_power",
    """SELECT o_orderkey, round(log10(o_totalprice), 6) AS log, round(pow(o_totalprice / 1000, 2), 4) AS power,
       abs(o_totalprice - 250000) AS distance FROM orders""",
)
def x16(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.round(F.log10(price), 6).alias("log"),
        F.round(F.pow(price / 1000, F.lit(2)), 4).alias("power"),
        F.abs(price - 250000).alias("distance"),
    )


@check(
    "x17_local_to_utc",
    """SELECT event_id, CAST(timezone('UTC', timezone('US/Eastern', ts + INTERVAL 290 DAY)) AS VARCHAR) AS autumn,
       CASE WHEN CAST(ts + INTERVAL 60 DAY AS DATE) = DATE '2024-03-10' AND hour(ts) = 2 THEN NULL
       ELSE CAST(timezone('UTC', timezone('US/Eastern', ts + INTERVAL 60 DAY)) AS VARCHAR) END AS spring FROM events""",
)
def x17(t):
    autumn, spring = F.col("ts") + F.expr("INTERVAL 290 DAYS"), F.col("ts") + F.expr("INTERVAL 60 DAYS")
    return t.events.select(
        "event_id",
        localize(autumn, "US/Eastern").cast("string").alias("autumn"),
        localize(spring, "US/Eastern", nonexistent="null").cast("string").alias("spring"),
    )


@check(
    "x18_percent_columns",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS QTY, round((l_tax * 100) / 100.0, 6) AS TAX_PCT FROM lineitem",
)
def x18(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").alias("QTY"), (F.col("l_tax") * 100).alias("TAX_PCT"))
    return lines.withColumns(percent_columns(lines.columns)).withColumns(rounded("TAX_PCT"))


#: white space: what the engine calls so, vertical tab, information separators, next line, and all Unicode separators
_WHITE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def _wrapped(width: int) -> str:
    return f"SELECT doc_id, md5(regexp_replace(text, '(.{{{width},}}?){_WHITE}', '\\1<br>', 'gs')) AS digest FROM documents"


@check("d01_wrap_28", _wrapped(28))
def d01_28(t):
    return t.documents.select("doc_id", F.md5(wrap_text("text", 28)).alias("digest"))


@check("d01_wrap_45", _wrapped(45))
def d01_45(t):
    return t.documents.select("doc_id", F.md5(wrap_text("text", 45)).alias("digest"))
