import numpy as np
import pytest
from pyspark.sql import functions as F

from chartframes.llm import topk
from tests.llm.odd import against_duckdb


def test_query_equals_duckdb(spark):
    against_duckdb(spark, "op1_exact_top_k", "/root/testdata/sf0.01")


def slow(table, queries, k):
    out = []
    for q, qc in queries:
        if q is None or qc is None:
            continue
        near = sorted(((qc ^ c) & ((1 << 64) - 1)).bit_count() * (1 << 32) + i for i, c in table if i is not None and c is not None)[:k]
        out += [(q, n + 1, x & ((1 << 32) - 1), x >> 32) for n, x in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("k,block", [(1, 1 << 18), (7, 1 << 18), (7, 90), (400, 90)])
def test_random_codes(spark, monkeypatch, k, block):
    monkeypatch.setattr(topk, "INDEX_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    rng = np.random.default_rng(k)
    centres = rng.integers(-(1 << 63), (1 << 63) - 1, 6)
    codes = [int(centres[rng.integers(6)] ^ sum(np.int64(1) << np.int64(b) for b in rng.integers(0, 63, rng.integers(0, 20)))) for _ in range(240)]
    table = [(i, c) for i, c in enumerate(codes)] + [(1000 + i, codes[0]) for i in range(60)] + [(None, 5), (3000, None)]
    queries = [*table[::12], (5000, 0), (5001, -1), (5001, -1), (None, 1), (5002, None)]
    df = spark.createDataFrame([(*x, "n") for x in table], "id long, code long, rank string")
    asked = spark.createDataFrame([(*x, 1) for x in queries], "id long, code long, distance int")
    got = sorted(tuple(r) for r in topk.nearest(df, asked, k).collect())
    assert got == slow(table, queries, k)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, 1)], "id long, code long")
    assert topk.nearest(df, df.limit(0)).collect() == [] and topk.nearest(df.limit(0), df).collect() == []
    vectors = spark.createDataFrame([([1.0, -1.0, 0.0, 2.0],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in vectors.select(topk.sign_code(vectors.v)).collect()] == [9, None, 0]


def test_vectors_longer_than_a_code_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0] * 64), (2, None), (3, [-1.0, 2.0])], "id long, v array<float>")
    assert [r.c for r in df.select(topk.sign_code(F.col("v")).alias("c")).collect()] == [-1, None, 2]
    wide = spark.createDataFrame([(1, [1.0] * 96)], "id long, v array<float>")
    with pytest.raises(Exception, match="a vector has 96 elements"):
        wide.select(topk.sign_code(F.col("v")).alias("c")).collect()
