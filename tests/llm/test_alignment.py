import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from chartframes.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BOTH = []


def both():
    """The libraries themselves, and the bytes of A's ids by decoding them."""
    if not BOTH:
        tokenizer = Tokenizer.from_file(A)
        tokenizer.encode_special_tokens = True
        BOTH.extend([tokenizer, SentencePieceProcessor(model_file=B), alignment.Aligner(A, B)])
    return BOTH


def letters():
    """Byte-level letters, as the vocabulary's authors list them: printable bytes as they are, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def slow_document(text):
    """Ids and byte ranges of both tokenizers; nothing if the bytes differ."""
    if not text:
        return [], []
    tokenizer, pieces, _ = both()
    byte = letters()
    a = [(i, bytes(byte[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in pieces.encode(text):
        p = pieces.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("\u2581", " ").encode()))
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def slow(rows):
    documents, counts = [], Counter()
    for doc_id, text in rows:
        tokens = slow_document(text)
        ranges = []
        for side in tokens:
            ends = np.cumsum([len(x) for _, x in side]).tolist()
            ranges.append([(i, e - len(x), e) for (i, x), e in zip(side, ends, strict=True)])
        links = [(i, j) for i, s, e in ranges[0] for j, t, f in ranges[1] if s < f and t < e] if len(ranges[0]) < 3000 else slow_links(*ranges)
        counts.update(links)
        cuts = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
        groups = []
        for s, e in zip([0, *cuts], cuts, strict=False):
            groups.append("|".join(",".join(str(i) for i, x, y in side if s <= x and y <= e) for side in ranges) if len(cuts) < 3000 else "")
        documents.append((doc_id, ranges, links, groups))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return sorted(
        (
            (d, len(r[0]), len(r[1]), len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
            for d, r, x, g in documents
        ), key=str,
    )


def slow_links(a, b):
    out, first = [], 0
    for i, s, e in a:
        while b[first][2] <= s:
            first += 1
        n = first
        while n < len(b) and b[n][1] < e:
            out.append((i, b[n][0]))
            n += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(df):
    found = alignment.agreement(alignment.align(df, A, B), alignment.piece_count(B))
    return sorted(map(tuple, found.select(*COLUMNS).collect()), key=str)


def test_query_against_the_libraries(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op13(spark, folder).collect()}
    assert len(found) == len(docs)
    short = [tuple(d) for d in docs if len(d.text or "") < 2500]
    for row in slow(short):  # counts are over all documents, so only what is a document's own is compared here
        assert found[row[0]][:5] == row[:5] and found[row[0]][7] == row[7]
    some = spark.createDataFrame(short, "doc_id long, text string")
    assert got(some) == slow(short)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "   two  blanks\n\n\tand \r\n lines \x00\x1c\x85\u00a0 "), (5, "<|endoftext|> <s> </s> <unk> <0x41>"), (6, "\u2581a b\u2581"),
    (7, "It's ME, they'll've 1234567 \u00e9t\u00e9 na\u00efve \u03a3\u03af\u03c3\u03c5 \u4e2d\u6587 \U0001f600\U0001f468\u200d\U0001f469 \ufb01 e\u0301"), (7, "same id"), (7, "same id"), (None, "same id"), (None, None), (8, "x" * 3000), (9, "\ufffd\ufeff"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, 5) for r in ODD], "doc_id long, text string, pairs int")
    assert got(df) == slow(ODD)
    assert got(df.limit(0)) == []
    long_ = [(1, "Some words of it, and more: " * 30_000), (2, "a")]
    rows = {r.doc_id: r for r in alignment.align(spark.createDataFrame(long_, "doc_id long, text string"), A, B).collect()}
    one = slow([(1, "Some words of it, and more: " * 20)])[0]
    assert abs(rows[1].n_links - one[4] * 1500) < 3000 and rows[2].n_links == 1


def test_counts_by_shuffle_are_the_same(spark, monkeypatch):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    monkeypatch.setattr("chartframes.llm.common.BROADCAST_BYTES", 0)
    assert got(df) == slow(ODD)


def test_spans_say_what_the_groups_are(spark):
    df = spark.createDataFrame(ODD[2:8], "doc_id long, text string")
    for r in alignment.align(df, A, B, spans=True).collect():
        groups = []
        for i, j, x, y in zip([0, *r.group_a], [0, *r.group_b], r.group_a, r.group_b, strict=False):
            groups.append(",".join(map(str, r.a_ids[i:x])) + "|" + ",".join(map(str, r.b_ids[j:y])))
        assert (hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") == r.groups_sha256
        size = alignment.piece_count(B)
        pairs = Counter(r.a_ids[i] * size + r.b_ids[j] for i, j in zip(r.link_a, r.link_b, strict=True))
        assert pairs == dict(zip(r.pairs, r.times, strict=True)) and len(r.link_a) == r.n_links


@pytest.mark.parametrize("lane", [1, 2, 7, 1000])
@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 6), st.integers(1, 6)), max_size=8), min_size=1, max_size=5))
def test_merge_of_random_tokens(lane, documents):
    """Documents as groups of (bytes, A tokens, B tokens), the tokens of a group cut evenly."""
    ends, counts, at = ([], []), ([], []), 0
    for groups in documents:
        size = [len(e) for e in ends]
        for n, *parts in groups:
            for side, k in zip(ends, parts, strict=True):
                side.extend(sorted({at + -(-n * x // k) for x in range(1, k + 1)}))
            at += n
        for c, e, s in zip(counts, ends, size, strict=True):
            c.append(len(e) - s)
    a, b = (np.array(e, np.int64) for e in ends)
    n_a, n_b = (np.array(c) for c in counts)
    to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
    more = alignment._known_cuts(a, b, to_a - n_a, to_a, lane)
    first_a, order = np.unique(np.r_[(to_a - n_a)[n_a > 0], more[0]].astype(int), return_index=True)
    first_b = np.r_[(to_b - n_b)[n_a > 0], more[1]].astype(int)[order]
    links = np.diff(np.r_[first_a, len(a)]) + np.diff(np.r_[first_b, len(b)])
    i, j, cut = alignment.merge(a, b, first_a, first_b, links)
    want = [(x, y) for x in range(len(a)) for y in range(len(b)) if (a[x - 1] if x else 0) < b[y] and (b[y - 1] if y else 0) < a[x]]
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == want and cut.tolist() == [a[x] == b[y] for x, y in want]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abEÉéßÿ÷×.,'’ \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u0301ΣǅΩ中\U0001f600<|>5²½_-ǆɏ\u2028\u2026"), max_size=30))
def test_fast_ids_equal_the_library(text):
    tokenizer, _, own = both()
    assert own.a.fast is not None
    assert own.a.ids([text])[0] == tokenizer.encode(text, add_special_tokens=False).ids
