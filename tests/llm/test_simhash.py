import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chartframes.llm import queries, simhash


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps):
    root = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    low = {}
    for r, d in zip(root, ids, strict=True):
        low[r] = min([x for x in (low.get(r), d) if x is not None], default=None)
    return [low[r] for r in root]


def smallest(roots, nodes):
    """The smallest node with the same root, for each."""
    return [min(n for n, other in zip(nodes, roots, strict=True) if other == r) for r in roots]


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    fps = [slow_fingerprint(d.text) for d in docs]
    roots = slow_components([d.doc_id for d in docs], fps)
    want = sorted((d.doc_id, f"{f:016x}", r) for d, f, r in zip(docs, fps, roots, strict=True))
    assert sorted(map(tuple, queries.op7(spark, folder).collect())) == want


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "One", None), (4, "one", "y"), (5, "one two", "y"), (None, "ONE", "z"), (6, "é " * 40_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    names = ["doc_id", "fingerprint", "component_id"]
    got = sorted(map(tuple, simhash.near_duplicates(df).select(names).collect()), key=str)
    zero = "0" * 16
    one = f"{xxhash.xxh64_intdigest(b'one', seed=42):016x}"
    assert [r for r in got if r[1] == zero] == [(1, zero, 1), (2, zero, 1), (3, zero, 1)]
    assert sorted(str(r[0]) for r in got if r[1] == one and r[2] == 4) == ["4", "4", "None"]
    assert len(got) == len(rows)
    assert simhash.near_duplicates(df.limit(0)).collect() == []
    kept = simhash.one_of_each(df.unionByName(df)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 4, 5, 6]
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(df.where("doc_id IS NULL OR doc_id > 4")).collect()) == ["5", "6", "None"]
    assert simhash.one_of_each(df.limit(0)).collect() == []


@pytest.mark.parametrize("limit", [100, 100_000])
def test_trie_links_connect_what_brute_force_connects(spark, limit):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [base[rng.integers(40)] ^ sum(np.uint64(1) << np.uint64(b) for b in rng.integers(0, 64, rng.integers(0, 4))) for _ in range(300)]
    fps = sorted({int(x) for x in [*base, *flips, 0, 1, 3, 7, (1 << 64) - 1]})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = simhash.trie_links(df, 2, limit)
    got = {r.node: r.root for r in simhash.components(links).collect()}
    assert smallest([got.get(x, x) for x in signed], signed) == slow_components(signed, fps)
    assert all(((a - b) and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2) for a, b in links.select("a", "b").collect())


def test_components_of_a_chain_and_a_star(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1001, 1500).select(F.lit(1000).cast("long").alias("a"), F.col("id").alias("b"))
    got = sorted((r.node, r.root) for r in simhash.components(chain.unionByName(star)).collect())
    assert [n for n, _ in got] == [*range(201), *range(1000, 1500)]
    assert smallest([r for _, r in got], [n for n, _ in got]) == [0] * 201 + [1000] * 500
