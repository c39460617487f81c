"""Files, literal tables and profiles."""

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from chartframes.session import scratch_path
from chartframes.sources import (
    cached_rows,
    cached_sketches,
    cached_source,
    describe,
    estimates,
    infer_types,
    literal_table,
    mapping_table,
    merge_sketches,
    profile,
    read_csv,
    read_inferred,
    read_lenient,
    read_tagged,
    read_two_row_header,
    sample_n,
    sample_rows,
    sketches,
    unpack_list,
    weekdays,
    write_csv,
)
from chartframes.sources.profile import distinct_counts
from tests.conftest import rows


def written(tmp_path, name, content, encoding="utf-8"):
    path = tmp_path / name
    path.write_text(content, encoding=encoding)
    return str(path)


def test_byte_order_mark_quotes_and_line_breaks(spark, tmp_path):
    path = written(tmp_path, "a.csv", 'Company,Address\nX,"1 Way, ""Old"" Town"\nY,"two\nlines"\n', "utf-8-sig")
    found = rows(read_csv(spark, path, multiLine=True), "Company", "Address")
    assert found == [("X", '1 Way, "Old" Town'), ("Y", "two\nlines")]


def test_lenient_read_keeps_bad_rows(spark, tmp_path):
    path = written(tmp_path, "b.csv", "k,n\na,1\nb,NA\nc,\n")
    assert rows(read_lenient(spark, path, {"n": "int"})) == [("a", 1), ("b", None), ("c", None)]


def test_tagged_files(spark, tmp_path):
    paths = {y: written(tmp_path, f"{y}.csv", f"k,state\n1,ok\n2,{y}\n") for y in ("2021", "2022")}
    found = rows(read_tagged(spark, paths, "YEAR", lambda d: d.where("upper(state) = 'OK'")), "k", "YEAR")
    assert found == [("1", "2021"), ("1", "2022")]


def test_two_row_header(spark, tmp_path):
    content = "MONTH,Coffee Arabica,Tea\n,($/kg),($/kg)\n,COFFEE_ARABIC,TEA_AVG\n1960M01,0.94,…\n1960M02,0.95,1.1\n"
    path = written(tmp_path, "c.csv", content)
    df = read_two_row_header(spark, path, {"MONTH": "string"})
    assert df.columns == ["MONTH", "COFFEE_ARABIC ($/kg)", "TEA_AVG ($/kg)"]
    assert rows(df) == [("1960M01", 0.94, None), ("1960M02", 0.95, 1.1)]


def test_cached_source_builds_once(spark):
    path, built = scratch_path(spark, "cache"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert cached_source(spark, path, build).count() == 3
    assert cached_source(spark, path, build).count() == 3
    assert len(built) == 1


def test_write_csv_round_trip(spark):
    path = scratch_path(spark, "out")
    df = spark.createDataFrame([('say "hi", you', 1.5), (None, None)], "t string, x double")
    write_csv(df, path)
    assert rows(read_csv(spark, path, "t string, x double")) == rows(df)


def test_literal_tables_have_a_known_size(spark):
    table = weekdays(spark, 0)
    assert rows(table)[0] == ("Fri", 5)
    assert "LocalRelation" in table._jdf.queryExecution().optimizedPlan().toString()
    assert rows(mapping_table(spark, {"a": 1, "b": 2})) == [("a", 1), ("b", 2)]


def test_unpack_list(spark):
    df = literal_table(spark, {"info": [["AK", "1", "2"], ["WA", "3", "1"]]})
    out = unpack_list(df, "info", {"abbr": "string", "row": "int", "col": "int"})
    assert rows(out) == [("AK", 1, 2), ("WA", 3, 1)]


def test_profile(spark):
    df = spark.createDataFrame([(10, "a"), (9, None), (None, "b")], "n int, t string")
    assert rows(profile(df)) == [("n", "int", 2, 1, "9", "10", 9.5, 0.5**0.5), ("t", "string", 2, 1, "a", "b", None, None)]
    big = spark.createDataFrame([(9007199254740993, {"a": 1})], "id long, m map<string, int>")
    assert rows(profile(big), "column", "min", "max") == [("id", "9007199254740993", "9007199254740993"), ("m", None, None)]
    assert rows(distinct_counts(df, ["n", "t"])) == [("n", 2), ("t", 2)]


def test_sample_of_n_rows_does_not_depend_on_partitions(spark):
    few = [sample_n(spark.range(0, 1000, 1, parts), 7, "id", 3) for parts in (1, 9)]
    assert len(rows(few[0])) == 7 and rows(few[0]) == rows(few[1]) != rows(sample_n(spark.range(1000), 7, "id", 4))
    assert sample_n(spark.range(3), 7, "id").count() == 3


def test_cached_source_leaves_a_foreign_folder_alone(spark, tmp_path):
    folder = tmp_path / "kept"
    (folder / "_keep").mkdir(parents=True)
    (folder / "_keep" / "notes.txt").write_text("mine")
    with pytest.raises(PySparkException):
        cached_source(spark, str(folder), lambda: spark.range(3)).collect()
    assert (folder / "_keep" / "notes.txt").read_text() == "mine"


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    assert rows(sample_rows(df, 0.1, 1)) == rows(sample_rows(df, 0.1, 1))


CELLS = """flag,whole,big,number,day,time,text,mixed,nothing,"odd, name"
true,1,9223372036854775807,1.5,2024-02-29,2024-01-01 10:00:00,a,1,,x
FALSE,-20,9223372036854775808,2,2023-12-31,2024-01-02,b,,,
,007,3,-.5e3,,,,2x,,true
"""


def test_types_are_inferred_from_all_cells(spark, tmp_path):
    path = written(tmp_path, "types.csv", CELLS)
    found = {r["column"]: (r["type"], r["cells"], r["rows"]) for r in infer_types(read_csv(spark, path)).collect()}
    assert found == {
        "flag": ("boolean", 2, 3), "whole": ("bigint", 3, 3), "big": ("double", 3, 3), "number": ("double", 3, 3), "day": ("date", 2, 3),
        "time": ("timestamp", 2, 3), "text": ("string", 2, 3), "mixed": ("string", 2, 3), "nothing": ("string", 0, 3), "odd, name": ("string", 2, 3),
    }
    df = read_inferred(spark, path)
    assert [k for _, k in df.dtypes] == [v[0] for v in found.values()]
    first = df.where("whole = 1").first()
    assert first.flag is True and first.number == 1.5 and str(first.day) == "2024-02-29" and first.mixed == "1" and first.nothing is None


def test_inferred_types_are_those_of_duckdb(spark, tmp_path, tables):
    orders = tables.orders.withColumns({"late": F.col("o_totalprice") > 100_000, "gaps": F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")), "at": F.lit("2024-05-01 12:30:00")})
    path = str(tmp_path / "orders")
    write_csv(orders.coalesce(1), path)
    names = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}
    theirs = {r[0]: names[r[1]] for r in duckdb.connect().execute(f"DESCRIBE SELECT * FROM read_csv('{path}/*.csv', sample_size=-1)").fetchall()}
    assert dict(read_inferred(spark, path).dtypes) == theirs


def test_masks_of_files_merge(spark, tmp_path):
    from chartframes.sources.inference import inferred_types, merge_masks, type_masks

    parts = [written(tmp_path, f"p{i}.csv", f"a,b\n{a},{b}\n") for i, (a, b) in enumerate([(1, "2024-01-01"), ("2.5", "2024-01-01 05:00"), ("", "")])]
    masks = merge_masks([type_masks(read_csv(spark, p)) for p in parts])
    assert rows(inferred_types(masks), "column", "type") == [("a", "double"), ("b", "timestamp")] == rows(infer_types(read_csv(spark, parts)), "column", "type")


def test_lost_cells_are_counted_while_reading(spark, tmp_path):
    path = written(tmp_path, "lost.csv", "k,n,d\na,1,2024-01-01\nb,NA,x\nc,,y\nd,2.5,\n")
    lost = Observation()
    df = read_lenient(spark, path, {"n": "int", "d": "date"}, lost)
    assert rows(df, "k", "n") == [("a", 1), ("b", None), ("c", None), ("d", None)]
    assert lost.get == {"n": 2, "d": 2}


def test_tagged_files_are_one_scan(spark, tmp_path):
    paths = {f"label {i}": written(tmp_path, f"a file+{i} %20.csv", f"k\n{i}\n{i + 1000}\n") for i in range(100)}
    folder = tmp_path / "a folder"
    folder.mkdir()
    for i in range(2):
        (folder / f"{i}.csv").write_text(f"k\n{i + 5000}\n")
    df = read_tagged(spark, paths | {"folder": str(folder)}, "label")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] csv") == 1 and "Union" not in plan
    want = [(str(i + d), f"label {i}") for i in range(100) for d in (0, 1000)] + [(str(i + 5000), "folder") for i in range(2)]
    assert rows(df, "k", "label") == sorted(want)
    with pytest.raises(ValueError):
        read_tagged(spark, {"a": str(folder), "b": f"{folder}/"}, "label")


def test_cache_has_its_rows_schema_and_sketches(spark):
    path = scratch_path(spark, "cache")
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    first = cached_source(spark, path, lambda: df, sketch=True)
    again = cached_source(spark, path, lambda: 1 / 0)
    assert cached_rows(spark, path) == 1000 == again.count() and first.schema == again.schema
    found = {r["column"]: r for r in estimates(cached_sketches(spark, path)).collect()}
    assert found["x"].distinct == 7 and abs(found["id"].median - 500) < 10


def test_half_written_cache_is_built_anew(spark, tmp_path):
    folder = tmp_path / "half"
    (folder / "_temporary" / "0").mkdir(parents=True)
    (folder / "part-00000.parquet").write_text("not finished")
    assert cached_source(spark, str(folder), lambda: spark.range(3)).count() == 3
    aside = [p for p in tmp_path.iterdir() if p.name.startswith("half.unfinished")]
    assert len(aside) == 1 and (aside[0] / "part-00000.parquet").exists()


def test_of_two_builders_the_first_wins(spark, tmp_path):
    path = str(tmp_path / "raced")

    def slow():
        assert cached_source(spark, path, lambda: spark.range(3)).count() == 3  # meanwhile another one builds it
        return spark.range(5)

    assert cached_source(spark, path, slow).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["raced"]


def test_failed_builder_leaves_nothing_in_place(spark, tmp_path):
    path = str(tmp_path / "failed")
    with pytest.raises(PySparkException):
        cached_source(spark, path, lambda: spark.range(3).select(F.raise_error(F.lit("broken"))))
    assert not (tmp_path / "failed").exists()
    assert cached_source(spark, path, lambda: spark.range(2)).count() == 2


def test_describe_is_exact(spark):
    values = [5.0, None, 1.0, float("nan"), 2.0, 2.0, 10.0]
    df = spark.createDataFrame([(v, "t" if i % 2 else None) for i, v in enumerate(values)], "x double, t string")
    found = {r["column"]: r for r in describe(df).collect()}
    assert (found["x"].q1, found["x"].median, found["x"].q3) == (2.0, 2.0, 5.0)
    assert found["t"].median is None and found["t"].distinct == 1 and found["t"]["nulls"] == 4
    assert describe(df.limit(0)).count() == 2 and describe(df.select("t")).count() == 1


def test_sketches_merge_and_are_near(spark):
    df = spark.range(100_000).select(((F.xxhash64("id") % 1_000_000) / 7).alias("x"), (F.col("id") % 5000).cast("string").alias("t"))
    exact = {r["column"]: r for r in describe(df).collect()}
    merged = merge_sketches([sketches(df.where("pmod(xxhash64(x), 3) = 0")), sketches(df.where("pmod(xxhash64(x), 3) > 0"))])
    found = {r["column"]: r for r in estimates(merged).collect()}
    assert found["x"]["count"] == 100_000
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        rank = df.where(F.col("x") <= found["x"][name]).count() / 100_000
        assert abs(rank - q) < 0.01
    for c in ("x", "t"):
        assert abs(found[c].distinct / exact[c].distinct - 1) < 0.03
