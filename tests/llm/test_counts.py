import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, normalizers

from chartframes.llm import counts, queries


def tokenizer(pieces):
    """The same vocabulary in the tokenizers library, which keeps its sums in double precision."""
    low = -1e12
    vocab = [("<unk>", low), *[(f"<0x{i:02X}>", low) for i in range(256)], *pieces]
    t = Tokenizer(models.Unigram(vocab, 0, byte_fallback=True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return t


def lowest(pieces):
    """With the worst score of the vocabulary as the library sees it, unknown characters cost the same in both."""
    v = counts.Viterbi(pieces)
    v.unknown = -1e12 - 10
    return v


def test_query_equals_the_tokenizer(spark):
    folder = "/root/testdata/sf0.001"
    pieces = counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    t = tokenizer(pieces)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: len(t.encode(d.text or "", add_special_tokens=False).ids) for d in docs}
    assert {r.doc_id: r.n_tokens for r in queries.op8(spark, folder).collect()} == want


@pytest.mark.parametrize("scores", [lambda r: float(-r.randint(1, 4)), lambda r: -r.random() * 5])
def test_random_vocabularies_with_ties(scores):
    r = random.Random(4)
    for _ in range(60):
        names = {"▁", "a", "b"} | {"".join(r.choice("ab▁\nc") for _ in range(r.randint(1, 5))) for _ in range(r.randint(3, 25))}
        pieces = [(n, scores(r)) for n in sorted(names)]
        t, v = tokenizer(pieces), lowest(pieces)
        for _ in range(15):
            text = "".join(r.choice("aab  bc\ndé") for _ in range(r.randint(0, 40)))
            assert v(text)[1] == len(t.encode(text, add_special_tokens=False).ids), (pieces, text)


def test_parts_equal_whole_texts():
    pieces = counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    v = counts.Viterbi(pieces)
    assert v.parts is not None
    for text in ("", " ", "a", "  two  blanks \n and lines\n\n", "x" * 3000, "日本語 \U0001f600 words", "tab\tand\r\n"):
        whole = v.best("▁" + text.replace(" ", "▁")) if text else (0.0, 0)
        assert v(text) == whole


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, " ", 5), (4, "ab", 5), (4, "ab", 5), (None, "ab", 5), (5, "ab " * 60_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = counts.token_counts(df, [("▁", -1.0), ("▁ab", -2.0), ("b", -9.0)]).collect()
    found = sorted(((r.doc_id, r.n_tokens, r.score) for r in got), key=str)
    assert found == sorted([(1, 0, 0.0), (2, 0, 0.0), (3, 2, -2.0), (4, 1, -2.0), (4, 1, -2.0), (None, 1, -2.0), (5, 60_001, -120_001.0)], key=str)
    assert counts.token_counts(df.limit(0), [("a", 0.0)]).collect() == []
