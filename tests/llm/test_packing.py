import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chartframes.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, capacity=2048):
    """Rows of the query against the tokenizer, every piece once, sequences without gaps."""
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for d, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want.append((d, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins), -(-sum(w[3] for w in want) // capacity)


def test_query_against_the_tokenizer(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    used, least = check(queries.op5(spark, folder).collect(), docs)
    assert used <= least + 1


def test_odd_rows(spark):
    texts = [
        None, "", " ", "It's ME., they'll... ok?! a.b, <|endoftext|> <|ENDOFTEXT|>.", "it's", "it's", "Σίσυφος ΣΑΣ. İI, é. ́a x y z, ²., 5., _.,",
        "word, " * 30_000, "a" * 5000, "\U0001f600., \x1c x\x85y", "ǅ, ß. ŉ.",
    ]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "x", 1), (4, "it's", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int")
    check(packing.pack_documents(df, PATH).collect(), [r[:2] for r in rows])
    assert packing.pack_documents(df.limit(0), PATH).collect() == []


def test_lengths_are_numbered_in_as_many_parts_as_they_need(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 3)
    rows = [(i, "one two" if i % 3 else "w " * (i + 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    used, least = check(packing.pack_documents(df, PATH, 64).collect(), rows, 64)
    assert used <= least + 1


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=25))
def test_plan_uses_every_piece_once(counts):
    patterns = packing.plan(counts, 64)
    used = {}
    for pattern, times in patterns:
        assert times > 0 and sum(pattern) <= 64
        for x in pattern:
            used[x] = used.get(x, 0) + times
    assert used == counts


def test_plan_prefers_exact_complements():
    assert packing.plan({60: 2, 30: 3, 10: 1, 4: 1}, 64) == [((60, 4), 1), ((60,), 1), ((30, 30), 1), ((30, 10), 1)]
    assert packing.plan({50: 1, 9: 1, 5: 1, 12: 1}, 64) == [((50, 9, 5), 1), ((12,), 1)]
    assert packing.plan({50: 1, 6: 1, 5: 1, 3: 1, 13: 1}, 64) == [((50, 6, 5, 3), 1), ((13,), 1)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abEÉéßÿ÷×.,'’ \t\x0b\x85\u0301ΣσİǅΩ中\U0001f600<|>5²_-"), max_size=30))
def test_encoder_equals_the_tokenizer(text):
    if not ENCODER:
        ENCODER.extend([packing.WordEncoder(PATH), Tokenizer.from_file(PATH)])
    want = np.array(ENCODER[1].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert ENCODER[0](text) == want


ENCODER = []


def test_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_PARTS", 3)
    encode = packing.WordEncoder(PATH)
    assert encode.direct
    text = "one two three four five one, two. six"
    want = np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encode(text) == want == encode(text)


def whole(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abEÉéßÿ÷×.,'’ \t\n\x01\x0b\x85\u0301ΣσİǅΩ中\U0001f600<|>5²_-sdlvreтм"), max_size=30), max_size=6))
def test_texts_together_equal_the_tokenizer(texts):
    if not TOGETHER:
        TOGETHER.append(packing.WordEncoder(PATH, together=True))
        assert TOGETHER[0].words
    assert list(TOGETHER[0].each(texts)) == whole(texts)


TOGETHER = []


def test_words_of_pieces_together_equal_the_tokenizer(monkeypatch):
    """Every token that ends a word is met, and 30,000 words of up to four tokens, in portions of any size."""
    encode = packing.WordEncoder(PATH, together=True)
    calls = []
    monkeypatch.setattr(encode, "_ids", lambda part: calls.append(part) or packing.WordEncoder._ids(encode, part))
    tokens = [t for t in Tokenizer.from_file(PATH).get_vocab() if t.isascii() and "|" not in t]
    words = [t.removesuffix("</w>") for t in tokens if t.endswith("</w>")]
    rng = np.random.default_rng(1)
    words += ["".join(tokens[i].removesuffix("</w>") for i in rng.integers(len(tokens), size=rng.integers(2, 5))) for _ in range(30_000)]
    texts = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)] + ["", "<|endoftext|> It's", "x" * 5000]
    want = whole(texts)
    for portion in (1, 10_000, 4 << 20):
        monkeypatch.setattr(packing, "PORTION", portion)
        assert list(encode.each(texts)) == want
    assert len(calls) < 1000  # nearly all words are encoded together


def test_one_by_one_gives_the_same_pieces_and_ids(spark):
    df = spark.createDataFrame([(1, "One two, three."), (2, None), (3, "w " * 100 + "中 é")], "doc_id long, text string")
    found = [packing.pack_documents(df, PATH, 64, with_ids=True, together=t).drop("sequence_id", "offset").collect() for t in (True, False)]
    assert sorted(found[0]) == sorted(found[1]) and all(zlib.crc32(r.ids) == r.ids_crc32 for r in found[0])
