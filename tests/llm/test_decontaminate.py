import hashlib
import re

import pytest
from pyspark.sql import functions as F

from chartframes.llm import decontaminate, queries
from tests.llm.odd import against_duckdb

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOW))


def slow(docs, items):
    wins = {}
    for i, t in items:
        w = split(t)
        for k in range(max(len(w) - 10, 0) + 1) if w else ():
            wins.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found |= ids
        names = sorted(map(str, found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_query_equals_duckdb(spark):
    against_duckdb(spark, "op4_benchmark_decontamination", "/root/testdata/sf0.001")


@pytest.mark.parametrize("broadcast", [0, 32 << 20])
def test_odd_rows(spark, monkeypatch, broadcast):
    monkeypatch.setattr("chartframes.llm.common.BROADCAST_BYTES", broadcast)
    one = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = [(1, one), (2, one.upper()), (10, "été rouge"), (3, ""), (4, None), (5, "solo"), (6, "x y z " * 5), (6, "x y z " * 5)]
    docs = [(1, f"say {one} now {one[6:]}"), (2, "Été-ROUGE été rouge"), (3, None), (4, ""), (5, "x y z " * 60_000), (6, "beta gamma delta"), (7, "solo"), (7, "solo"), (None, "SOLO solo"), (8, "été")]
    b = spark.createDataFrame([(*x, "n") for x in items], "item_id long, text string, doc_id string")
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    names = "doc_id n_words n_hit n_items items_sha256 contaminated".split()
    got = decontaminate.contamination(d, b).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == slow(docs, items)
    assert [tuple(r) for r in decontaminate.contamination(d, b.limit(0)).select("n_hit").distinct().collect()] == [(0,)]
    assert decontaminate.contamination(d.limit(0), b).collect() == []
    assert queries.ORACLES["op4_benchmark_decontamination"]


def test_ids_of_any_type(spark):
    one = "a passage of more than ten words that is in two of them and stays whole"
    items = spark.createDataFrame([("a1", one), ("10", one), ("9", "another item of some more words that nobody has taken from it")], "item_id string, text string")
    docs = spark.createDataFrame([("x", f"before {one} after"), ("y", "clean"), (None, one), (None, "clean too")], "doc_id string, text string")
    found = {(r.doc_id, r.contaminated): r for r in decontaminate.contamination(docs, items).collect()}
    assert found["x", True]["items"] == ["10", "a1"] and found["x", True].n_hit == 16 and found[None, True].n_items == 2
    assert found["x", True].items_sha256 == hashlib.sha256(b"10,a1").hexdigest()
    assert sorted((r.doc_id, r.text) for r in decontaminate.clean_documents(docs, items).na.fill("-").collect()) == [("-", "clean too"), ("y", "clean")]


def test_hashes_do_not_depend_on_slices(monkeypatch):
    text = decontaminate._canonical("One two, three; " * 9 + "x" * 100 + " four   five é" + "y" * 64 + " z")
    whole = decontaminate.word_hashes(text)
    assert len(whole) == len(text.split()) and len(set(whole.tolist())) == len(set(text.split()))
    for size in (16, 17, 64, 65):
        monkeypatch.setattr(decontaminate, "SLICE", size)
        monkeypatch.setattr(decontaminate, "_POWERS", [])
        assert decontaminate.word_hashes(text).tolist() == whole.tolist()
    assert decontaminate.word_hashes(b"").tolist() == [] == decontaminate.word_hashes(b"   ").tolist()


def test_a_large_benchmark_stays_in_spark(spark):
    """300,000 windows: no part of them comes to the driver, and documents are hashed twice, not once a block."""
    items = spark.range(300).select(F.col("id").alias("item_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1009)), lambda i: F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("n"), i.cast("string")))).alias("text"))
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(500), F.lit(520)), lambda i: F.concat(F.lit("w"), (F.col("id") * 7).cast("string"), F.lit("n"), i.cast("string")))).alias("text"))
    found = decontaminate.contamination(docs, items).collect()
    assert {(r.doc_id, r.n_hit, tuple(r["items"])) for r in found} == {(i, 21 if 7 * i < 300 else 0, (str(7 * i),) if 7 * i < 300 else ()) for i in range(50)}
