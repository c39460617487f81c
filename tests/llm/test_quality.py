import zlib

import numpy as np
from pyspark.sql import functions as F

from chartframes.llm import common, quality, queries


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = queries.op2(spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in got)
    tested = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    good, bad = ([s for s, t in tested if t == v] for v in (1, 0))
    auc = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    print("held-out AUC", auc, "accuracy", np.mean([(s >= 0.5) == t for s, t in tested]))
    assert auc > 0.75


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    bags = [rng.random((n, quality.WIDTH)).astype(np.float32) for n in (1, 4, 3)]
    labels = np.array([1, 0, 1], np.float32)
    model = quality.Attention(bags, labels, 0.5, rounds=1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        total = 0
        for x, y in zip(bags, labels, strict=True):
            h = np.tanh(x @ model.p["w"] + model.p["wb"])
            e = (np.tanh(h @ model.p["v"]) / (1 + np.exp(-(h @ model.p["u"])))) @ model.p["a"]
            z = (np.exp(e) / np.exp(e).sum()) @ h
            q = 1 / (1 + np.exp(-(z @ model.p["c"] + model.p["cb"][0])))
            total -= np.log(q if y else 1 - q) / len(bags)
        return total

    gradient = model._gradient(bags, labels)
    for name, value in model.p.items():
        for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(3)]:
            old = value[at]
            value[at] = old + 1e-5
            up = loss()
            value[at] = old - 1e-5
            down = loss()
            value[at] = old
            assert abs((up - down) / 2e-5 - gradient[name][at]) < 1e-5


def test_portions_do_not_change_the_score(monkeypatch):
    rng = np.random.default_rng(2)
    model = quality.Attention([rng.random((2, quality.WIDTH)).astype(np.float32) for _ in range(4)], np.array([0, 1, 0, 1], np.float32), 0.5)
    text = " ".join(f"word{i % 777}" for i in range(20_000))
    whole = np.concatenate(list(quality.passages(text)))
    assert len(whole) == -(-20_000 // quality.PASSAGE_WORDS)
    before = model.score(text)
    monkeypatch.setattr(quality, "PORTION", 3)
    assert abs(model.score(text) - before) < 1e-6
    assert np.allclose(np.concatenate(list(quality.passages(text))), whole)


def test_odd_rows(spark):
    rows = [(i, "good words and more words here" if i % 2 else "x### y$$$ z%%% q***", i) for i in range(40)]
    odd = [(50, None, 0), (51, "", 0), (52, " \n", 0), (53, "é " * 60_000, 0), (None, "good words", 0), (1, "good words", 0)]
    df = spark.createDataFrame([*rows, *odd], "doc_id long, text string, score int")
    labels = spark.createDataFrame([*[(i, i % 2) for i in range(40)], (50, None), (None, 1), (99, 1), (3, 1)], "doc_id long, quality int")
    model = quality.fit(df, labels, F.lit(True))
    got = quality.score(df, model).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    found = {r.doc_id: r.score for r in got}
    assert found[3] > 0.5 > found[2] and found[50] == found[51] == found[52]
    assert {r.score for r in quality.score(df, quality.fit(df, labels.limit(0), F.lit(True))).collect()} == {0.5}
    assert quality.score(df.limit(0), model).collect() == []


def test_a_long_document_is_learned_from_over_its_whole_length(spark):
    parts = [np.full((n, quality.WIDTH), i, np.float32) for i, n in enumerate([1, 300, 2, 900])]
    kept = quality.spread(iter(parts), 64)
    assert len(kept) == 64 and kept[0, 0] == 0 and kept[-1, 0] == 3 and 12 <= (kept[:, 0] == 1).sum() <= 20
    assert (quality.spread(iter(parts[:1]), 64) == parts[0]).all()
    good, bad = "Plain words that say something, and end. " * 25_000, "BUY !!! now $$$ 999 " * 50_000
    rows = [(i, good if i % 2 else bad) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    assert all(len(t) >= 1_000_000 for _, t in rows)
    model = quality.fit(docs, labels, F.lit(True))
    assert model.score(good[:5000]) > model.score(bad[:5000])


def test_the_sample_is_bounded_whatever_repeats(spark):
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(1000)] + [(i, "other") for i in range(100, 110)] + [(None, "x"), (8, None)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("label"))
    got = common.labelled_sample(docs, labels, 6).collect()
    assert len(got) <= 6 and len({r.doc_id for r in got}) == len(got)
    everything = common.labelled_sample(docs, labels, 10_000).collect()
    assert sorted(r.doc_id for r in everything) == [7, 8, *range(100, 110)] and sum(r.doc_id == 7 for r in everything) == 1
    assert common.labelled_sample(docs, labels.limit(0), 6).collect() == []
