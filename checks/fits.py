"""M: fits, histograms and distributions."""

from pyspark.sql import functions as F

from chartframes.operators.fit import density, distribution, histogram, histogram_dates, histogram_round, poly_eval, poly_fit
from chartframes.operators.quantiles import iqr_fences
from chartframes.plans import reference_means
from chartframes.sources.tables import literal_table
from checks.registry import check, rounded


@check(
    "m01_linear_fit",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""",
)
def m01(t):
    intercept, slope = poly_fit(t.lineitem, "l_quantity", "l_extendedprice", 1).coefficients()
    out = literal_table(t.spark, {"slope": [slope], "intercept": [intercept]})
    return out.withColumns(rounded("slope", "intercept", digits=4))


@check(
    "m01_residuals",
    """WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS a, regr_intercept(o_totalprice, o_custkey) AS b FROM orders)
       SELECT o_orderkey, round(o_totalprice - (a * o_custkey + b), 1) AS residual FROM orders, f""",
)
def m01_residuals(t):
    fit = poly_fit(t.orders, "o_custkey", "o_totalprice", 1)
    return t.orders.select("o_orderkey", F.round(F.col("o_totalprice") - fit.at("o_custkey"), 1).alias("residual"))


@check(
    "m01_quadratic_fit",
    """WITH p AS (SELECT (l_quantity - 25.5) / 24.5 AS t, l_extendedprice AS y FROM lineitem),
       m AS (SELECT count(*)::DOUBLE AS a, sum(t) AS b, sum(t * t) AS c, sum(t * t * t) AS d, sum(t * t * t * t) AS e,
         sum(y) AS u, sum(t * y) AS v, sum(t * t * y) AS w FROM p),
       s AS (SELECT *, a * (c * e - d * d) - b * (b * e - c * d) + c * (b * d - c * c) AS det FROM m)
       SELECT round((u * (c * e - d * d) - b * (v * e - d * w) + c * (v * d - c * w)) / det, 2) AS c0,
         round((a * (v * e - d * w) - u * (b * e - c * d) + c * (b * w - v * c)) / det, 2) AS c1,
         round((a * (c * w - v * d) - b * (b * w - v * c) + u * (b * d - c * c)) / det, 2) AS c2 FROM s""",
)
def m01_quadratic(t):
    fit = poly_fit(t.lineitem, "l_quantity", "l_extendedprice", 2)
    out = literal_table(t.spark, {f"c{i}": [c] for i, c in enumerate(fit.scaled)})
    return out.withColumns(rounded("c0", "c1", "c2", digits=2))


def _orthogonal(degree: int) -> str:
    """The fit on a grid of 50 points, in SQL: each polynomial from the two before it, so that all are orthogonal over the data."""
    out = """WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
       d AS (SELECT (2 * l_quantity - lo - hi) / (hi - lo) AS t, count(*)::DOUBLE AS n, sum(l_extendedprice) AS sy, NULL::DOUBLE AS x FROM lineitem, e GROUP BY ALL
         UNION ALL SELECT (2 * (lo + i * (hi - lo) / 49) - lo - hi) / (hi - lo), 0, 0, lo + i * (hi - lo) / 49 FROM e, range(50) AS g(i)),
       s0 AS (SELECT *, 1::DOUBLE AS p, 0::DOUBLE AS before, 1::DOUBLE AS norm, 0::DOUBLE AS y FROM d)"""
    for k in range(degree + 1):
        out += f""",
       m{k} AS (SELECT sum(n * t * p * p) / sum(n * p * p) AS a, sum(n * p * p) AS q, sum(sy * p) / sum(n * p * p) AS c FROM s{k}),
       s{k + 1} AS (SELECT t, n, sy, x, (t - a) * p - {"0" if k == 0 else "q / norm"} * before AS p, p AS before, q AS norm, y + c * p AS y FROM s{k}, m{k})"""
    return out + f" SELECT round(x, 6) AS x, round(y, 4) AS y FROM s{degree + 1} WHERE x IS NOT NULL"


@check("m02_fit_degree_5", _orthogonal(5))
def m02(t):
    fit = poly_fit(t.lineitem, "l_quantity", "l_extendedprice", 5)
    return poly_eval(t.spark, fit, 50).select(F.round("x", 6).alias("x"), F.round("y", 4).alias("y"))


@check("m02_fit_degree_12", _orthogonal(12))
def m02_steep(t):
    fit = poly_fit(t.lineitem, "l_quantity", "l_extendedprice", 12)
    return poly_eval(t.spark, fit, 50).select(F.round("x", 6).alias("x"), F.round("y", 4).alias("y"))


@check(
    "m02_fit_on_grid",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b,
         min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
       SELECT round(lo + i * (hi - lo) / 49, 6) AS x, round(a * (lo + i * (hi - lo) / 49) + b, 3) AS y
       FROM f, range(50) AS g(i)""",
)
def m02_grid(t):
    fit = poly_fit(t.lineitem, "l_quantity", "l_extendedprice", 1)
    return poly_eval(t.spark, fit, 50).select(F.round("x", 6).alias("x"), F.round("y", 3).alias("y"))


@check(
    "m03_fences",
    """WITH r AS (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS rn,
         count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
       q AS (SELECT o_orderpriority, max(n) AS n, median(o_totalprice) AS median,
         max(CASE WHEN rn = floor(0.25::DOUBLE * (n - 1) + 0.5) + 1 THEN o_totalprice END) AS q1,
         max(CASE WHEN rn = floor(0.75::DOUBLE * (n - 1) + 0.5) + 1 THEN o_totalprice END) AS q3 FROM r GROUP BY 1)
       SELECT o_orderpriority, n, round(median, 4) AS median, q1, q3, round(q3 - q1, 4) AS iqr,
         round(q1 - 1.5 * (q3 - q1), 4) AS fence_low, round(q3 + 1.5 * (q3 - q1), 4) AS fence_high FROM q""",
)
def m03(t):
    out = iqr_fences(t.orders, "o_orderpriority", "o_totalprice")
    return out.withColumns(rounded("median", "iqr", "fence_low", "fence_high", digits=4))


@check(
    "m04_histogram",
    """WITH c AS (SELECT least(floor((o_totalprice - 0) / 25000), 19)::BIGINT AS bin, count(*) AS n FROM orders
         WHERE o_totalprice BETWEEN 0 AND 500000 GROUP BY 1)
       SELECT i AS bin, coalesce(n, 0) AS n, i * 25000.0::DOUBLE AS low, (i + 1) * 25000.0::DOUBLE AS high
       FROM range(20) AS g(i) LEFT JOIN c ON bin = i""",
)
def m04(t):
    return histogram(t.orders, "o_totalprice", 0.0, 500000.0, 20)


@check(
    "m04_histogram_full_range",
    """WITH e AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 20 AS w FROM orders),
       c AS (SELECT least(CAST(floor((o_totalprice - lo) / w) AS BIGINT), 19) AS bin, count(*) AS n FROM orders, e GROUP BY 1)
       SELECT b.bin, coalesce(n, 0) AS n, round(lo + b.bin * w, 4) AS low, round(lo + b.bin * w + w, 4) AS high
       FROM (SELECT unnest(range(20)) AS bin) b LEFT JOIN c USING (bin), e""",
)
def m04_full(t):
    return histogram(t.orders, "o_totalprice", bins=20).withColumns(rounded("low", "high", digits=4))


@check(
    "m04_histogram_outside",
    """WITH c AS (SELECT CASE WHEN o_totalprice < 100000 THEN -1 WHEN o_totalprice > 300000 THEN 4
         ELSE least(CAST(floor((o_totalprice - 100000) / 50000) AS BIGINT), 3) END AS bin, count(*) AS n FROM orders GROUP BY 1)
       SELECT bin, n, CASE WHEN bin >= 0 THEN 100000.0 + bin * 50000.0 END::DOUBLE AS low,
         CASE WHEN bin < 4 THEN 150000.0 + bin * 50000.0 END::DOUBLE AS high FROM c""",
)
def m04_outside(t):
    return histogram(t.orders, "o_totalprice", 100000.0, 300000.0, 4)


@check(
    "m04_histogram_round",
    """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
       w AS (SELECT min(step) AS step FROM (SELECT unnest([1, 2, 5, 10, 20, 50, 100]) * pow(10, floor(log10((hi - lo) / 15))) AS step, lo, hi FROM e)
         WHERE floor(hi / step) - floor(lo / step) + 1 <= 15),
       c AS (SELECT CAST(floor(o_totalprice / step) AS BIGINT) AS place, count(*) AS n FROM orders, w GROUP BY 1)
       SELECT p - CAST(floor(lo / step) AS BIGINT) AS bin, p * step AS low, (p + 1) * step AS high, coalesce(n, 0) AS n
       FROM (SELECT unnest(range(CAST(floor(lo / step) AS BIGINT), CAST(floor(hi / step) AS BIGINT) + 1)) AS p, lo, step FROM e, w) LEFT JOIN c ON place = p""",
)
def m04_round(t):
    return histogram_round(t.orders, "o_totalprice", 15)


@check(
    "m04_histogram_dates",
    """WITH m AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS month FROM orders),
       e AS (SELECT min(month) AS lo, max(month) AS hi FROM m),
       w AS (SELECT min(step) AS step FROM (SELECT unnest([1, 3, 6, 12, 24, 60, 120]) AS step, lo, hi FROM e) WHERE hi // step - lo // step + 1 <= 30),
       c AS (SELECT month // step AS place, count(*) AS n FROM m, w GROUP BY 1)
       SELECT CAST(make_date(p * step // 12, p * step % 12 + 1, 1) AS VARCHAR) AS low, CAST(make_date((p + 1) * step // 12, (p + 1) * step % 12 + 1, 1) AS VARCHAR) AS high, coalesce(n, 0) AS n
       FROM (SELECT unnest(range(lo // step, hi // step + 1)) AS p, step FROM e, w) LEFT JOIN c ON place = p""",
)
def m04_dates(t):
    return histogram_dates(t.orders, "o_orderdate", 30).withColumns({n: F.col(n).cast("string") for n in ("low", "high")})


@check(
    "m05_density",
    """WITH s AS (SELECT o_orderpriority, min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n,
         0.9 * least(stddev_samp(o_totalprice), (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) / 1.34) * pow(count(*), -0.2) AS bw FROM orders GROUP BY 1),
       g AS (SELECT *, lo - 2 * bw AS start, (hi - lo + 4 * bw) / 127 AS step FROM s),
       p AS (SELECT o_orderpriority, (o_totalprice - start) / step AS place FROM orders JOIN g USING (o_orderpriority)),
       b AS (SELECT o_orderpriority, bin, sum(weight) AS weight FROM (
         SELECT o_orderpriority, floor(place) AS bin, 1 - (place - floor(place)) AS weight FROM p UNION ALL SELECT o_orderpriority, floor(place) + 1, place - floor(place) FROM p) GROUP BY ALL)
       SELECT o_orderpriority, point, round(start + point * step, 4) AS x, round(bw, 4) AS bandwidth,
         round(sum(weight * exp(-pow((point - bin) * step / bw, 2) / 2)) / (n * bw * sqrt(2 * pi())), 12) AS density
       FROM b JOIN g USING (o_orderpriority), range(128) AS r(point) GROUP BY o_orderpriority, point, start, step, n, bw""",
)
def m05_density(t):
    curve = density(t.orders, "o_totalprice", "o_orderpriority")
    return curve.withColumns(rounded("x", "bandwidth", digits=4) | rounded("density", digits=12))


@check(
    "m05_distribution",
    """WITH r AS (SELECT p_type, p_retailprice, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice) AS rn,
         count(*) OVER (PARTITION BY p_type) AS n FROM part)
       SELECT p_type, max(n) AS n, min(p_retailprice) AS min, max(p_retailprice) AS max, round(avg(p_retailprice), 6) AS mean,
         round(median(p_retailprice), 6) AS median,
         max(CASE WHEN rn = floor(0.25::DOUBLE * (n - 1) + 0.5) + 1 THEN p_retailprice END) AS q1,
         max(CASE WHEN rn = floor(0.75::DOUBLE * (n - 1) + 0.5) + 1 THEN p_retailprice END) AS q3 FROM r GROUP BY p_type""",
)
def m05(t):
    return distribution(t.part, "p_retailprice", "p_type").withColumns(rounded("mean", "median"))


@check(
    "m06_reference_lines",
    "SELECT round(avg(l_quantity), 6) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice FROM lineitem",
)
def m06(t):
    means = reference_means(t.lineitem, ["l_quantity", "l_extendedprice"])
    return means.withColumns(rounded("l_quantity") | rounded("l_extendedprice", digits=4))
