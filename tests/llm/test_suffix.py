import hashlib
import time

import numpy as np
import pytest

from chartframes.llm import common, queries, suffix


def slow(rows, width=50):
    """(doc_id, text) rows to what the query must return."""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            w = b[i : i + width]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < d:
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op6(spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == slow([tuple(d) for d in docs])


@pytest.mark.parametrize("piece", [300, 1 << 18])
def test_random_passages(spark, piece, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", piece)
    rng = np.random.default_rng(3)
    passages = ["".join(rng.choice(list("ab é"), n)) for n in (49, 50, 51, 70, 120, 700)]
    rows = [(i, "".join(rng.choice([*passages, "x", "yz" * 40, "ab"], rng.integers(0, 9)))) for i in range(60)]
    rows += [(100 + i, "same line, over and over, in a text of one line only. " * 30) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    local = suffix.remove_repeats(df).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in local) == slow(rows)


def test_odd_rows(spark):
    long_ = "abcdefghij" * 10
    rows = [(1, None, 1), (2, "", 2), (3, long_, 3), (3, long_ + "k", 4), (4, long_, 5), (None, long_, 6), (None, "z" + long_, 7), (5, "é" * 90_000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs long")
    got = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans) for r in suffix.remove_repeats(df).collect()}
    assert got == {
        (1, 0): (0, 0), (2, 0): (0, 0), (3, 100): (0, 0), (3, 101): (0, 0), (4, 100): (100, 1),
        (None, 100): (100, 1), (None, 101): (100, 1), (5, 180_000): (0, 0),
    }
    assert suffix.remove_repeats(df.limit(0)).collect() == []


@pytest.mark.parametrize("width", [49, 57, 64, 130, 200])
def test_other_widths(spark, width):
    rng = np.random.default_rng(width)
    passages = ["".join(rng.choice(list("abc é"), n)) for n in (width - 1, width, width + 1, width + 9, 3 * width)]
    rows = [(i, "".join(rng.choice([*passages, "x", "yz" * 90, "ab"], rng.integers(0, 7)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix.remove_repeats(df, width=width).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow(rows, width)


def shuffle_files(spark):
    return {x for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}


def test_shuffled_joins_and_files(spark, monkeypatch):
    """Texts joined by shuffle; each step's shuffle files go before the next one writes its own, carried texts are moved once."""
    rng = np.random.default_rng(8)
    passages = ["".join(rng.choice(list("ab é"), n)) for n in (49, 50, 58, 59, 120)]
    rows = [(i, "".join(rng.choice([*passages, "x", "ab"], rng.integers(0, 9)))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = []

    def pin(frame, *args, **options):
        before, out = shuffle_files(spark), real(frame, *args, **options)
        for _ in range(50):
            if not shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        left.append(shuffle_files(spark) - before)
        return out

    real = suffix.pin
    monkeypatch.setattr(suffix, "pin", pin)
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    plain, carried = suffix.remove_repeats(df), suffix.remove_repeats(df, carry=True)
    assert len(left) >= 6 and not any(left)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in plain.collect()) == slow(rows)
    got = carried.collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow(rows)
    assert sorted((r.row.doc_id, r.row.text) for r in got) == sorted(rows)


def test_carried_text_is_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    df = spark.createDataFrame([(1, "a" * 80), (2, "a" * 90)], "doc_id long, text string")
    plan = suffix.remove_repeats(df, carry=True)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().apply(0)
    names = plan.left().output().mkString(" ")
    assert "row#" in names and "text#" not in names


def test_windows_go_together():
    """An anchor's 35 windows take four rows past the threshold, and each is told from its neighbours."""
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 100, 400).astype(np.uint8).tobytes() for _ in range(3)]
    texts[2] = texts[0][100:180] + texts[2][80:]
    data = np.frombuffer(b"".join(b"\0" * 8 + x for x in texts) + b"\0" * 16, np.uint8)
    codes, begin = [], [8, 416, 824]
    for i, text in enumerate(texts):
        a = suffix.anchors(np.frombuffer(text, np.uint8), np.array([len(text)]), 50)
        first = a["first"] + begin[i]
        codes.append(suffix._place(first, a["last"] - a["first"] + 1, a["at"] - a["first"], 50) << 4 | 15)
    n = [len(x) for x in codes]
    c = suffix._open_windows(np.concatenate(codes), data, 50)
    assert len(c["place"]) <= 4 * sum(n)
    own = np.repeat([0, 1, 2], n)[c.pop("code")]
    start, has = c["place"] >> suffix.TOGETHER, c["place"] & 511
    windows = sorted((int(o), int(s) - i - begin[o]) for o, s, b in zip(own, start, has, strict=True) for i in range(9) if b >> i & 1)
    assert windows == [(o, s) for o in range(3) for s in range(351)]
    left, gone = suffix._met_before(c | {"doc": own.astype(np.int64), "tie": own * 0}, 50)
    want = [(o, s) for o, s in windows if any(texts[o][s : s + 50] in texts[p] for p in range(o))]
    got = [(int(d), s - begin[d]) for d, a, b in zip(gone["doc"], gone["first"], gone["stop"], strict=True) for s in range(int(a), int(b) - 49)]
    assert want and sorted(got) == want and sum(int(x).bit_count() for x in left) == len(windows) - len(want)
