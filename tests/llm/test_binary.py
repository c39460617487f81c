import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from chartframes.llm import binary, packing, queries
from chartframes.llm.common import scratch_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_permutation():
    for n in (1, 2, 3, 5, 100, 257, 5000):
        for key in (1, 77):
            out = binary.permute(np.arange(n), n, key)
            assert sorted(out.tolist()) == list(range(n))
            assert (out == np.concatenate([binary.permute(np.array([i]), n, key) for i in range(n)])).all()
    assert (binary.permute(np.arange(1000), 1000, 1) != binary.permute(np.arange(1000), 1000, 2)).any()
    moved = np.corrcoef(np.arange(5000), binary.permute(np.arange(5000), 5000, 3))[0, 1]
    assert abs(moved) < 0.05


def round_trip(spark, df, size, shard):
    path = scratch_folder(spark)
    binary.materialise(df, path, PATH, size=size, shard_records=shard)
    rows = spark.read.parquet(path).collect()
    return path, rows, dict(binary.read_shards(rows))


def test_exact_round_trip_and_resume(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80)
    path, rows, read = round_trip(spark, docs, 100, 16)
    t = Tokenizer.from_file(PATH)
    want = {}
    for d in docs.collect():
        ids = t.encode(d.text or "", add_special_tokens=False).ids + [49407]
        want |= {(d.doc_id, p): ids[at : at + 100] for p, at in enumerate(range(0, len(ids), 100))}
    assert sorted(read) == list(range(len(want)))
    names = {r["first_slot"] + i: key for r in rows for i, key in enumerate(zip(r["doc_ids"], r["pieces"], strict=True))}
    assert {names[s]: ids.tolist() for s, ids in read.items()} == want
    assert all(r["stride"] == 200 and len(r["data"]) == 200 * len(r["lengths"]) and r["first_slot"] == 16 * r["shard"] for r in rows)
    assert [len(r["lengths"]) for r in sorted(rows, key=lambda r: r["shard"])][:-1] == [16] * (len(rows) - 1)
    late = {r.slot: np.frombuffer(r.ids, "<u2").tolist() for r in binary.read_from(spark, path, 37).collect()}
    assert late == {s: ids.tolist() for s, ids in read.items() if s >= 37}


def test_query_has_every_sequence_once(spark):
    got = queries.op9(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    t = Tokenizer.from_file(PATH)
    want = sorted((d.doc_id, len(t.encode(d.text or "", add_special_tokens=False).ids) + 1) for d in docs)
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert sorted(total.items()) == want


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "a", 0), (3, "a", 0), (None, "b", 0), (4, "word " * 30_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    _, written, read = round_trip(spark, df, 1024, 8)
    lengths = sorted((str(d), n) for r in written for d, n in zip(r["doc_ids"], r["lengths"], strict=True) if d != 4)
    assert lengths == [("1", 1), ("2", 1), ("3", 2), ("3", 2), ("None", 2)]
    assert len(read) == 5 + 30
    assert round_trip(spark, df.limit(0), 1024, 8)[1] == []


def test_wide_vocabulary_keeps_its_ids(spark, tmp_path):
    words = {f"w{i}": i for i in range(70_000)} | {"[UNK]": 70_000}
    tokenizer = Tokenizer(models.WordLevel(words, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tokenizer.save(str(tmp_path / "wide.json"))
    df = spark.createDataFrame([(1, "w3 w65536 w69999"), (2, "w65535")], "doc_id long, text string")
    binary.materialise(df, str(tmp_path / "out"), str(tmp_path / "wide.json"), size=8, end=5)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["width"] for r in rows} == {4} and {r["stride"] for r in rows} == {32}
    assert sorted(ids.tolist() for _, ids in binary.read_shards(rows)) == [[3, 65536, 69999, 5], [65535, 5]]
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in binary.read_from(spark, str(tmp_path / "out")).collect()}
    assert found == {1: [3, 65536, 69999, 5], 2: [65535, 5]}


def test_words_are_encoded_together(spark, monkeypatch):
    """No plain word goes to the tokenizer by itself; of a table with nulls, repeats, odd and long texts nothing is lost."""

    def strict(path, **settings):
        encode = packing.WordEncoder(path, **settings)  # not the one that the worker keeps for other tests
        by_itself = encode._ids

        def ids(part):
            assert not part.isalpha(), part
            return by_itself(part)

        encode._ids = ids
        return encode

    monkeypatch.setattr(binary, "word_encoder", strict)
    words = [chr(97 + i % 26) + chr(97 + i // 26 % 26) + "ing" for i in range(600)]
    texts = [" ".join(words[:300]), None, "", " ".join(words[250:]) * 3, "\u4e2d\u00c9t\u00e9 <|endoftext|> It's", "It's", "It's"]
    docs = spark.createDataFrame([(i if i < 5 else 5, t) for i, t in enumerate(texts)] + [(None, "It's")], "doc_id long, text string")
    _, rows, read = round_trip(spark, docs, 100, 4)
    t = Tokenizer.from_file(PATH)
    want = []
    for d in docs.collect():
        ids = t.encode(d.text or "", add_special_tokens=False).ids + [49407]
        want += [(d.doc_id, p, ids[at : at + 100]) for p, at in enumerate(range(0, len(ids), 100))]
    names = {r["first_slot"] + i: key for r in rows for i, key in enumerate(zip(r["doc_ids"], r["pieces"], strict=True))}
    assert sorted(((*names[s], ids.tolist()) for s, ids in read.items()), key=str) == sorted(want, key=str)


def test_later_slots_skip_earlier_shards(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"))
    path, rows, read = round_trip(spark, docs, 64, 8)
    found = binary.read_from(spark, path, 100)
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in scan and "GreaterThan(first_slot,92)" in scan
    assert sorted(r.slot for r in found.collect()) == list(range(100, len(read)))
