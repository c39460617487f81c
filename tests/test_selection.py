import math
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartframes.operators.selection import Pick, double_of, refined_medians, refined_quantiles, with_double_codes


def slow(values, q, method):
    values = sorted((v for v in values if v is not None), key=lambda v: (isinstance(v, float) and math.isnan(v), v))
    if not values:
        return None
    place = q * (len(values) - 1)
    if method == "nearest":
        return values[math.floor(place + 0.5)]
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return float(low) if low == high else low + (high - low) * (place - math.floor(place))


def bits(x):
    """The bit pattern of a double as a number of the same order."""
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 1.0, 0.1, 3.0, 1e22, 2.0**52 + 1, 1 - 2**-53, 2.0**-1000]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=300))
def test_codes_of_doubles_are_their_bits(spark, numbers):
    numbers = numbers + EDGES + [math.nextafter(2.0**e, d) for e in (-1022, -3, 0, 7, 1000) for d in (0, math.inf)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    df = with_double_codes(df, {"code": "x"})
    for r in df.withColumn("back", double_of(F.col("code"))).collect():
        assert r.code == bits(r.x) and r.back == r.x


def test_nan_is_the_largest(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (1.0,)], "x double")
    got = refined_quantiles(df, None, {"top": Pick("x", 1.0), "middle": Pick("x", 0.5)}).first()
    assert math.isnan(got.top) and got.middle == math.inf


@pytest.mark.parametrize("bits", [2, 12])
def test_every_kind_and_group_against_sorting(spark, bits):
    rng = random.Random(4)
    kinds = "g string, `column` int, whole bigint, real double, single float, money decimal(12,2), day date, at timestamp"
    base = spark.createDataFrame(
        [
            (rng.choice(["a", "b", "b", "b", None, "only nulls"]), rng.choice([1, None]), rng.choice([None, -(1 << 63), (1 << 63) - 1, rng.randrange(-5, 5), rng.randrange(1 << 40)]),
             rng.choice([None, rng.gauss(0, 1), rng.expovariate(1) * 1e9, -1e-300, 7.25]), rng.choice([None, 0.5, -2.25, 1e30]), None, None, None)
            for _ in range(400)
        ], kinds,
    )
    df = base.withColumns(
        {
            "money": F.round(F.col("real") % 1000, 2).cast("decimal(12,2)"), "day": F.date_add(F.lit("1970-01-01").cast("date"), (F.col("whole") % 20000).cast("int")),
            "at": F.timestamp_micros(F.col("whole") % (1 << 50)),
        }
    )
    df = df.withColumns({c: F.when(~F.col("g").eqNullSafe("only nulls"), F.col(c)) for c in df.columns[2:]})
    picks = {f"{c}_{i}": Pick(c, q, m) for c in df.columns[2:] for i, (q, m) in enumerate([(0.25, "nearest"), (0.9, "nearest"), (0.5, "linear")]) if m == "nearest" or c in ("whole", "real", "single", "money")}
    got = {(r.g, r["column"]): r for r in refined_quantiles(df, ["g", "column"], picks, "n", bits=bits).collect()}
    rows = df.collect()
    assert got.keys() == {(r.g, r["column"]) for r in rows}
    for key, found in got.items():
        own = [r for r in rows if (r.g, r["column"]) == key]
        assert found.n == len(own)
        for name, p in picks.items():
            want = slow([float(r[p.column]) if p.method == "linear" and r[p.column] is not None else r[p.column] for r in own], p.q, p.method)
            assert found[name] == (pytest.approx(want, rel=1e-12) if p.method == "linear" and want is not None else want), (key, name)


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "x int")
    assert refined_medians(df, None, ["x"]).collect()[0].x == 2.0
    assert refined_medians(df.limit(0), None, ["x"]).collect()[0].x is None
    assert refined_medians(df.limit(0).withColumn("k", F.lit(1)), "k", ["x"]).collect() == []
    with pytest.raises(TypeError):
        refined_medians(df.withColumn("x", F.col("x").cast("string")), None, ["x"])


def test_no_shuffle_carries_values(spark, tables):
    """What goes into a shuffle is combined by bin: few rows, however many values there are."""
    rows = spark.range(0, 200_000, 1, 4).select((F.col("id") % 3).alias("g"), (F.xxhash64("id") / 7.0).alias("x"))
    tracker = spark.sparkContext._jsc.sc().statusStore()
    before = {s.stageId() for s in _stages(tracker)}
    found = refined_medians(rows, "g", ["x"]).collect()
    assert len(found) == 3
    written = [s.shuffleWriteRecords() for s in _stages(tracker) if s.stageId() not in before]
    assert max(written) <= 4 * 3 * 2 * (1 << 12) and sum(written) < 100_000


def _stages(store):
    found = store.stageList(None, False, False, spark_quantiles(), None)
    return [found.apply(i) for i in range(found.size())]


def spark_quantiles():
    from pyspark import SparkContext

    return SparkContext._gateway.new_array(SparkContext._jvm.double, 0)
