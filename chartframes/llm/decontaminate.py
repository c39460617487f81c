"""Benchmark passages in documents, by a prefix-filtered join of word windows.

Documents and items become numbers of three-word shingles in tasks; shingles are counted and joined in Spark. A window
that must be contained whole needs one prefix shingle only, its rarest one, so a document meets the few windows
whose rarest shingle it has, at the place where it has it, and these are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartframes.llm.common import frugal, give_back, join_small, pin, take, without_rows

WINDOW = 10
SHINGLE = 3
#: Bytes of a text that a task hashes in one go; words are not cut.
SLICE = 1 << 20
#: What a row of the joined tables takes, with a window of ten words.
ROW_BYTES = 160

#: Everything but a-z, 0-9 and bytes of other characters becomes a blank, A-Z becomes a-z.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_FACTOR, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _canonical(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").translate(_TABLE)


def words(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and all characters beyond ASCII, A-Z in lower case, as UTF-8."""
    return _canonical(text).split()


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    if not _POWERS:
        for factor in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            steps = np.full(SLICE + 1, factor, np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


_POWERS: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(_MIX)
    return x ^ x >> np.uint64(29)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a canonical text: a polynomial of its bytes, from differences of running sums."""
    found = [np.zeros(0, np.uint64)]
    up, down = _powers()
    start = 0
    while start < len(data):
        stop = min(start + SLICE, len(data))
        if stop < len(data):
            stop = data.rfind(b" ", start, stop) + 1 or stop
            if stop == start + SLICE and data[stop - 1] != 32:  # one word fills the slice: it is taken apart from the others
                end = data.find(b" ", stop)
                stop = len(data) if end < 0 else end
                found.append(np.array([_long_word(data[start:stop])], np.uint64))
                start = stop
                continue
        part = np.frombuffer(data, np.uint8, stop - start, start)
        full = np.r_[False, part != 32, False]
        edges = np.flatnonzero(full[1:] != full[:-1])
        first, last = edges[::2], edges[1::2]
        sums = np.r_[np.uint64(0), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], dtype=np.uint64)]
        found.append(_mixed((sums[last] - sums[first]) * down[first]))
        start = stop
    return np.concatenate(found)


def _long_word(word: bytes) -> int:
    """The hash of a word that may be longer than a slice, which may begin in the slice with other words before it."""
    total, shift = 0, 1
    for at in range(0, len(word), SLICE):
        part = np.frombuffer(word, np.uint8, min(SLICE, len(word) - at), at).astype(np.uint64) + np.uint64(1)
        total = (total + int(np.sum(part * _powers()[0][: len(part)], dtype=np.uint64)) * shift) % (1 << 64)
        shift = shift * int(pow(_FACTOR, len(part), 1 << 64)) % (1 << 64)
    return int(_mixed(np.array([total], np.uint64))[0])


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row; sizes do not meet."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = _mixed(out * np.uint64(_FACTOR) + hashes[i : i + n])
    return out.view(np.int64)


@F.pandas_udf(T.LongType())
def word_count(texts: pd.Series) -> pd.Series:
    """Number of words; null texts have none."""
    out = []
    for t in texts:
        full = np.r_[False, np.frombuffer(_canonical(t), np.uint8) != 32]
        out.append(np.count_nonzero(full[1:] & ~full[:-1]))
    give_back()
    return pd.Series(out, dtype="int64")


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows (item_id, window): the distinct windows of each (item_id, text), as words joined by blanks."""

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            w = words(t)
            out.append([b" ".join(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)] if w else [])
        return pd.Series(out)

    return benchmark.select("item_id", F.explode(cut("text")).alias("window")).distinct()


@F.pandas_udf(T.ArrayType(T.LongType()))
def _window_shingles(phrases: pd.Series) -> pd.Series:
    """Shingle hashes of a window in the order of their places; a window of fewer words is one shingle."""
    out = []
    for p in phrases:
        hashes = word_hashes(bytes(p))
        out.append(shingle_hashes(hashes, min(SHINGLE, len(hashes))))
    return pd.Series(out)


def document_shingles(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows (k1, k2, place, shingle): every shingle of every document (k1, k2, text), with its first word's place."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own = batch.column("text").to_pylist(), []
            for n, text in enumerate(texts):
                hashes = word_hashes(_canonical(text))
                own += [(n, s, shingle_hashes(hashes, s)) for s in sizes]
            rows = pa.array([n for n, _, _ in own], pa.int32())
            ends = np.cumsum([0, *(len(h) for _, _, h in own)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([h for _, _, h in own]) if own else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("k1").take(rows), batch.column("k2").take(rows), lists], ["k1", "k2", "shingles"])

    found = docs.mapInArrow(frugal(cut), "k1 long, k2 long, shingles array<long>")
    return found.select("k1", "k2", F.posexplode("shingles").alias("place", "shingle"))


def _keys(id_: Column, text: Column) -> list[Column]:
    """Two hashes that tell documents apart by id and text, whatever the type of the id; null is an id of its own."""
    named = F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit(""))
    return [F.xxhash64(named, text).alias("k1"), F.xxhash64(F.lit(1), text, named).alias("k2")]


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Hit words and items of the documents that have any: (k1, k2, n_hit) and (k1, k2, item_id).

    ``docs`` is (k1, k2, text), ``benchmark`` (item_id, text). Shingles of windows are counted over all documents, and
    each window is joined by its rarest one; windows with an absent one have no part in it. Joined tables are broadcast while
    they are counted to be small, else both sides are shuffled, and AQE splits a hot shingle.
    """
    named = pin(windows(benchmark, size))
    found = pin(named.select("window").distinct().withColumn("w", F.monotonically_increasing_id()))
    placed = pin(found.select("w", F.posexplode(_window_shingles("window")).alias("at", "shingle"), F.size(F.split(F.decode("window", "UTF-8"), " ")).alias("words")))
    sizes = [r.s for r in placed.select(F.least("words", F.lit(SHINGLE)).alias("s")).distinct().orderBy("s").collect()]  # 1 to SHINGLE
    shingles = pin(placed.select("shingle").distinct())
    each = document_shingles(docs, sizes)
    counts = pin(join_small(each.select("shingle"), shingles, ["shingle"], 16, "inner").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")))
    ranked = placed.join(counts, "shingle", "left").groupBy("w").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at")).alias("rarest"))
    prefixed = pin(ranked.where("rarest.n > 0").join(found, "w").select("rarest.shingle", "rarest.at", "w", "window"))
    met = join_small(each, prefixed, ["shingle"], ROW_BYTES, "inner").where("place >= at")  # positional bound
    candidates = met.select("k1", "k2", (F.col("place") - F.col("at")).alias("start"), "w", "window").distinct()
    asked = pin(candidates.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "w", "window")).alias("asked")))
    size_ = asked.agg(F.sum(F.size("asked"))).first()[0] or 0
    texts = join_small(docs, asked, ["k1", "k2"], -(-size_ * ROW_BYTES // max(asked.count(), 1)) + 32, "inner")

    @F.pandas_udf("n_hit long, ws array<long>")
    def verify(texts: pd.Series, asked: pd.Series) -> pd.DataFrame:
        out = []
        for text, wanted in zip(texts, asked, strict=True):
            run = words(text)
            hits, ws = [], set()
            for one in wanted:
                window = bytes(one["window"]).split()
                stop = one["start"] + len(window)
                if stop <= len(run) and run[one["start"] : stop] == window:  # length bound, then word by word
                    hits.append((one["start"], stop))
                    ws.add(one["w"])
            runs = _merged(np.array(hits, np.int64).reshape(-1, 2))
            out.append((int((runs[:, 1] - runs[:, 0]).sum()), sorted(ws)))
        return pd.DataFrame(out, columns=["n_hit", "ws"])

    verified = texts.select("k1", "k2", verify("text", "asked").alias("v")).select("k1", "k2", "v.*").where("n_hit > 0")
    verified = pin(verified.dropDuplicates(["k1", "k2"]))
    items = named.join(found, "window").select("w", "item_id")
    hit = verified.select("k1", "k2", F.explode("ws").alias("w")).join(items, "w").select("k1", "k2", "item_id").distinct()
    return verified.select("k1", "k2", "n_hit"), hit


def _merged(runs: np.ndarray) -> np.ndarray:
    """Runs [first, end) with those that touch or overlap made one."""
    if len(runs) < 2:
        return runs
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    fresh = np.flatnonzero(np.r_[True, runs[1:, 0] > reach[:-1]])
    return np.stack([runs[fresh, 0], reach[np.r_[fresh[1:], len(runs)] - 1]], 1)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", size: int = WINDOW,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (ids as text, sorted), items_sha256, contaminated,
    text_hash.

    A window is ``size`` consecutive words of an item, or all words of an item with fewer. A document word
    inside any occurrence of a window is hit. Null and empty texts have no words; items without words or without
    an id are left out. Ids of documents and items may be of any plain type. Repeated documents come out once each, repeated
    items count once, texts of any length are looked at whole, an empty benchmark hits nothing, an empty document table
    gives no rows, other columns are not read.
    """
    plain = take(docs, doc_id=id_column, text=text_column)
    items = take(benchmark, item_id=item_column, text=item_text_column).where("item_id IS NOT NULL")
    keyed = plain.select("doc_id", "text", *_keys(F.col("doc_id"), F.col("text")))
    hits, hit_items = occurrences(keyed.select("k1", "k2", "text"), items.select(F.col("item_id").cast("string"), "text"), size)
    listed = hit_items.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = pin(hits.join(listed, ["k1", "k2"]))
    counted = keyed.select(
        "doc_id", "k1", "k2", word_count("text").alias("n_words"), F.xxhash64("text").alias("text_hash")
    )
    total = found.agg(F.sum(F.size("items"))).first()[0] or 0
    both = join_small(counted, found, ["k1", "k2"], -(-total * 32 // max(found.count(), 1)) + 48)
    none = F.array().cast("array<string>")
    return both.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"), F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "text_hash",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and others) in which no window of the benchmark occurs."""
    return without_rows(docs, contamination(docs, benchmark).where("contaminated").select("doc_id", "text_hash"))
