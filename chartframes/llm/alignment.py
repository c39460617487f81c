"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids meet in a corpus."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.llm.common import frugal, join_small, pin, take
from chartframes.llm.packing import BYTE_LETTERS

#: Bytes of text that are aligned together; a longer text is aligned alone.
PORTION = 2 << 20
#: A lane is one of the places at which a portion's tokens are merged at the same time; it has about so many tokens.
LANE = 256
#: Texts of these characters only are split alike by both libraries' patterns, which may know other versions of Unicode.
_KNOWN = re.compile("[\x00-\u024f\u2010-\u2027]*")
# fixed values: the pattern of byte-level vocabularies that splits a text before merging
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokens:
    """Ids of a byte-level BPE file (``tokenizers`` format), and the bytes of each id.

    Ids that are numbered by rank can be made by ``tiktoken``, which takes a fifth of the time and gives the same; it is
    used for texts of well-known characters, if the file's settings allow it.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = {letter: b for b, letter in enumerate(BYTE_LETTERS)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in vocabulary.items():
            # a special token is no sequence of byte letters: its text stands for itself
            self.bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        special = {t["id"] for t in settings.get("added_tokens", [])}
        ranks = {self.bytes[i]: i for i in vocabulary.values() if i not in special}
        merged = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in settings["model"]["merges"]]
        by_rank = [vocabulary["".join(m)] for m in merged]
        pre, model = settings.get("pre_tokenizer") or {}, settings["model"]
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not settings.get("normalizer")
        plain = plain and not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"))
        fast = plain and by_rank == sorted(by_rank) and len(set(by_rank)) == len(by_rank) and all(bytes([b]) in ranks for b in range(256))
        self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if fast else None

    def ids(self, texts: list[str]) -> list[list[int]]:
        known = [self.fast is not None and _KNOWN.fullmatch(t) is not None for t in texts]
        slow = iter(self.tokenizer.encode_batch_fast([t for t, k in zip(texts, known, strict=True) if not k], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if k else next(slow).ids for t, k in zip(texts, known, strict=True)]


class PieceTokens:
    """Ids of a sentencepiece file, and the bytes of each id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


def _known_cuts(a_ends: np.ndarray, b_ends: np.ndarray, first: np.ndarray, last: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (A tokens, B tokens) to begin further lanes at: ends that both have, about every ``lane`` A tokens of a document.

    ``first`` and ``last`` are each document's A tokens. A place without a common end is moved on, all of them together.
    """
    steps = np.maximum((last - first - 1) // lane, 0)
    document = np.repeat(np.arange(len(first)), steps)
    nth = np.arange(len(document)) - np.repeat(np.cumsum(steps) - steps, steps) + 1
    at = first[document] + nth * lane - 1
    stop = np.minimum(at + lane, last[document] - 1)
    found = np.full(len(at), -1)
    left = np.arange(len(at))
    while len(left):
        place = np.searchsorted(b_ends, a_ends[at[left]])
        same = b_ends[place] == a_ends[at[left]]
        found[left[same]] = place[same]
        at[left[~same]] += 1
        left = left[~same]
        left = left[at[left] < stop[left]]
    good = found >= 0
    return at[good] + 1, found[good] + 1


def merge(a_ends: np.ndarray, b_ends: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, n_links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, cut) of every two tokens that overlap, in order; cut marks those that end together.

    Each lane has a place in A, one in B and one in the output, at ``first_a``, ``first_b`` and after the ``n_links`` at most
    that the lanes before it make. One step links the two tokens of every lane and moves on past the one that ends first, or both;
    a lane ends at the next one's start, and the lanes that have ended are taken out of the state.
    """
    last_a = np.r_[first_a[1:], len(a_ends)]
    out_first = np.cumsum(n_links) - n_links
    total = int(n_links.sum())
    link_a, link_b, cuts = np.empty(total, np.int32), np.empty(total, np.int32), np.zeros(total, bool)
    used = np.zeros(total, bool)
    alive = first_a < last_a
    i, j, at, stop = first_a[alive], first_b[alive], out_first[alive], last_a[alive]
    while len(i):
        end_a, end_b = a_ends[i], b_ends[j]
        cut = end_a == end_b
        link_a[at], link_b[at], cuts[at], used[at] = i, j, cut, True
        i = i + (end_a <= end_b)
        j = j + (end_b <= end_a)
        at = at + 1
        on = (i < stop) | ~cut  # a lane's last tokens end together
        if not on.all():
            i, j, at, stop = i[on], j[on], at[on], stop[on]
    return link_a[used], link_b[used], cuts[used]


class Aligner:
    """Both vocabularies, and the alignment of lists of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        # a token's number as text, with what stands after it
        self.text_a = [f"{i}{sign}".encode() for i in range(len(self.a.bytes)) for sign in (",", "|")]
        self.text_b = [f"{i}{sign}".encode() for i in range(len(self.b.bytes)) for sign in (",", ";")]

    def tokens(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers; none where the text is empty or the tokens' bytes are not a blank and the text."""
        full = [n for n, t in enumerate(texts) if t]
        a, b = [[] for _ in texts], [[] for _ in texts]
        blank = [" " + texts[n] for n in full]
        for n, text, x, y in zip(full, blank, self.a.ids(blank), self.b.ids([texts[n] for n in full]), strict=True):
            want = text.encode()
            if b"".join(map(self.a.bytes.__getitem__, x)) == want == b"".join(map(self.b.bytes.__getitem__, y)):
                a[n], b[n] = x, y
        return a, b

    def __call__(self, texts: list[str | None], spans: bool) -> dict[str, pa.Array]:
        """The columns of ``align`` for some texts."""
        a, b = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a, b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int32, int(n.sum())) for ids, n in ((a, n_a), (b, n_b)))
        del a, b
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        ends_a, ends_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        more_a, more_b = _known_cuts(ends_a, ends_b, to_a - n_a, to_a, LANE)
        first_a, order = np.unique(np.r_[(to_a - n_a)[n_a > 0], more_a], return_index=True)
        first_b = np.r_[(to_b - n_b)[n_a > 0], more_b][order]
        n_links = np.diff(np.r_[first_a, len(ends_a)]) + np.diff(np.r_[first_b, len(ends_b)])
        link_a, link_b, cut = merge(ends_a, ends_b, first_a, first_b, n_links)
        document = np.searchsorted(to_a, link_a, side="right")
        links, groups = (np.bincount(x, minlength=len(texts)) for x in (document, document[cut]))
        # pairs of ids, each once a document with its number of links
        pair = flat_a[link_a].astype(np.int64) * len(self.size_b) + flat_b[link_b]
        span = len(self.size_a) * len(self.size_b)
        pairs, times = np.unique(document * span + pair, return_counts=True)
        pairs_to = np.searchsorted(pairs, np.arange(len(texts) + 1) * span)
        out = {
            "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(groups), "n_links": pa.array(links),
            "groups_sha256": pa.array(self._digests(flat_a, flat_b, to_a, to_b, link_a[cut], link_b[cut])),
            "pairs": _lists(pairs_to, pairs % span), "times": _lists(pairs_to, times),
        }
        if spans:
            links_to, groups_to = np.r_[0, np.cumsum(links)], np.r_[0, np.cumsum(groups)]
            before_a, before_b = np.r_[0, to_a][:-1], np.r_[0, to_b][:-1]
            cut_document = document[cut]
            out |= {
                "a_ids": _lists(np.r_[0, to_a], flat_a.astype(np.int64)), "b_ids": _lists(np.r_[0, to_b], flat_b.astype(np.int64)),
                "link_a": _lists(links_to, link_a - before_a[document]), "link_b": _lists(links_to, link_b - before_b[document]),
                "group_a": _lists(groups_to, link_a[cut] - before_a[cut_document] + 1), "group_b": _lists(groups_to, link_b[cut] - before_b[cut_document] + 1),
            }
        return out

    def _digests(self, a, b, to_a, to_b, cut_a, cut_b) -> list[str]:
        """Each document's groups as text ``a1,a2|b1;a3|b2,b3``, as its SHA-256; '' without tokens."""
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[cut_a], ends_b[cut_b] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        # a token comes after all tokens of the groups before; within a group A comes first
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        code = np.empty(len(a) + len(b), np.int64)
        code[place_a] = 2 * a.astype(np.int64) + ends_a
        code[place_b] = 2 * b.astype(np.int64) + ends_b + len(self.text_a)
        words = self.text_a + self.text_b
        out = []
        start = 0
        for stop in (to_a + to_b).tolist():
            text = b"".join(map(words.__getitem__, code[start:stop].tolist()))
            out.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
            start = stop
        return out


def _lists(to: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(values.astype(np.int64)))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's vocabularies, kept between tasks."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _portions(texts: list[str | None]) -> Iterator[slice]:
    start, held = 0, 0
    for n, t in enumerate(texts):
        if held and held + len(t or "") > PORTION:
            yield slice(start, n)
            start, held = n, 0
        held += len(t or "") + 1
    if start < len(texts):
        yield slice(start, len(texts))


def align(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text", spans: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times.

    A blank and the text are encoded by the byte-level file ``path_a``, the text by the sentencepiece file ``path_b``, which puts
    a blank before it. Tokens are linked if their bytes overlap; where both end at one byte, a group ends. ``pairs`` are the
    distinct pairs of linked ids as A id * size of B + B id, ``times`` their numbers of links. With ``spans`` also all ids, the linked
    tokens (link_a, link_b) and the groups' ends (group_a, group_b), as places in the document. Texts that are null or empty,
    or whose tokens do not stand for just these bytes, have no tokens. Special tokens' names are plain text. Repeated rows
    come out once each, null doc_ids like any other; other columns are not read; an empty table gives no rows.
    """
    plain = take(docs, doc_id=id_column, text=text_column)
    kind = dict(plain.dtypes)["doc_id"]
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    lists = ["pairs", "times", *(["a_ids", "b_ids", "link_a", "link_b", "group_a", "group_b"] if spans else [])]

    def run(batches):
        both = aligner(path_a, path_b)
        for batch in batches:
            texts = batch.column("text")
            for own in _portions(texts.to_pylist()):
                part = texts.slice(own.start, own.stop - own.start).to_pylist()
                found = both(part, spans)
                ids = batch.column("doc_id").slice(own.start, own.stop - own.start)
                yield pa.RecordBatch.from_pydict({"doc_id": ids} | {c: found[c] for c in [*numbers, "groups_sha256", *lists]})

    schema = ", ".join([f"doc_id {kind}", *[f"{c} long" for c in numbers], "groups_sha256 string", *[f"{c} array<long>" for c in lists]])
    return plain.mapInArrow(frugal(run), schema)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best) over ``aligned`` rows: the links of each pair of ids, and whether no other A id has more with this B id."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    counts = pin(each.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % size_b))
    most = pin(counts.groupBy("b").agg(F.max("n").alias("most")))  # as many rows as B has ids at most
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def agreement(aligned: DataFrame, size_b: int) -> DataFrame:
    """The rows of ``align`` with n_best and count_sum, and without pairs and times.

    A link's count is the number of links of its pair of ids in all documents. ``n_best`` counts a document's links whose
    count is the highest of their B id, ``count_sum`` adds up the counts. ``aligned`` is written once. The table of counts is
    broadcast while it is small and joined by shuffle otherwise; rows of a document are combined before they are shuffled.
    """
    rows = pin(aligned.withColumn("row", F.monotonically_increasing_id()), "zstd")
    counts = pin(pair_counts(rows, size_b))
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    met = join_small(each, counts, ["pair"], 24, "inner")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row", "left").drop("row").na.fill(0, ["n_best", "count_sum"])


def piece_count(path: str) -> int:
    """Number of ids of a sentencepiece file."""
    return len(PieceTokens(path).bytes)
