"""Token sequences in training order, written as shards of fixed-size records."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartframes.llm.common import join_small, pin, take, tasks
from chartframes.llm.packing import word_encoder

RECORD_TOKENS = 1024
SHARD_RECORDS = 256
ROUNDS = 4


def _round(x: np.ndarray, key: int, turn: int) -> np.ndarray:
    """A keyed mix of one half, the same on every machine."""
    z = x + np.uint64((key * 0x9E3779B97F4A7C15 + (turn + 1) * 0xD1B54A32D192ED03) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ z >> np.uint64(shift)) * np.uint64(factor)
    return z ^ z >> np.uint64(31)


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: a Feistel network over an even number of bits, walked until it is below ``n``."""
    half = np.uint64(max((max(n - 1, 1)).bit_length() + 1, 2) // 2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for turn in range(ROUNDS):
            left, right = right, left ^ (_round(right, key, turn) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def id_type(tokenizer: str, end: int) -> str:
    """Little-endian unsigned numbers of 16 bits if all ids of the vocabulary fit in, else of 32 bits."""
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values()
    return "<u2" if max(*ids, end) < 1 << 16 else "<u4"


def records(docs: DataFrame, tokenizer: str, size: int, end: int) -> DataFrame:
    """Rows (row, doc_id, piece, ids): each document's ids and ``end``, cut at ``size``, as numbers of ``id_type``."""
    kind, numbers = dict(docs.dtypes)["doc_id"], id_type(tokenizer, end)

    def cut(frames):
        encode = word_encoder(tokenizer, together=True)
        tail, step = np.array([end], "<u4").tobytes(), size * np.dtype(numbers).itemsize
        for f in frames:
            out = []
            for doc, ids in zip(f["doc_id"], encode.each(t or "" for t in f["text"]), strict=True):
                ids = np.frombuffer(ids + tail, "<u4").astype(numbers).tobytes()
                out += [(doc, piece, ids[at : at + step]) for piece, at in enumerate(range(0, len(ids), step))]
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "ids"])
            frame["doc_id"] = frame["doc_id"].astype(f["doc_id"].dtype)
            yield frame

    found = docs.mapInPandas(cut, f"doc_id {kind}, piece int, ids binary")
    return found.withColumn("row", F.monotonically_increasing_id())


def materialise(
    docs: DataFrame, path: str, tokenizer: str, key: int = 1, size: int = RECORD_TOKENS, end: int = 49407,
    shard_records: int = SHARD_RECORDS, id_column: str = "doc_id", text_column: str = "text",
) -> None:
    """Write all token sequences of ``docs`` to ``path`` in the order in which training is to read them.

    A document is its ids and the id ``end``, cut into sequences of ``size``; a shorter one is filled up with
    ``end`` to the fixed size. Sequences are numbered densely, the keyed permutation of the number is the
    global slot. Every ``shard_records`` slots make a shard, one row (shard, first_slot, slots, stride, width, data, ids of
    the documents, pieces, lengths, crc32): the record of a slot starts at ``stride * (slot - first_slot)`` in
    ``data``, and an id takes ``width`` bytes, 2 or 4 as the vocabulary asks for. Ranges of shards are the write's tasks, so a
    lost one is written again alone, and a reader can go on from any slot (``read_from``). The same files, read in the
    same split, give the same order; a table that is split otherwise gives another one.

    Null and empty texts are a sequence of the end token; repeated rows are written once each; null doc_ids are
    kept; other columns are not read; an empty table gives no shards.
    """
    spark = docs.sparkSession
    cut = pin(records(take(docs, doc_id=id_column, text=text_column), tokenizer, size, end), "zstd")
    # dense numbers: rows are numbered within the tasks that wrote them, tasks start where those before end
    counts = cut.groupBy(F.shiftrightunsigned("row", 33).alias("task")).count().orderBy("task").collect()  # one number per task
    starts = np.cumsum([0, *(r["count"] for r in counts)])
    n = int(starts[-1])
    base = spark.createDataFrame([(r["task"], int(s)) for r, s in zip(counts, starts, strict=False)], "task long, start long")
    shards = -(-n // shard_records)
    parts = max(min(tasks(spark), shards), 1)
    per_part = max(-(-shards // parts), 1)

    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(np.int64), n, key))

    numbered = join_small(cut.withColumn("task", F.shiftrightunsigned("row", 33)), base, ["task"], 32, "inner")
    placed = numbered.select(slot(F.col("start") + F.col("row").bitwiseAND((1 << 33) - 1)).alias("slot"), "doc_id", "piece", "ids")
    ranged = placed.repartitionById(parts, F.expr(f"cast(slot div {shard_records * per_part} as int)")).sortWithinPartitions("slot")
    kind, numbers = dict(docs.dtypes)[id_column], np.dtype(id_type(tokenizer, end))

    def assemble(frames):
        held = []
        for f in frames:
            for row in zip(f["slot"], f["doc_id"], f["piece"], f["ids"], strict=True):
                if held and row[0] // shard_records != held[0][0] // shard_records:
                    yield one(held)
                    held = []
                held.append(row)
        if held:
            yield one(held)

    def one(held):
        width = numbers.itemsize
        filler = np.full(size, end, numbers).tobytes()
        data = b"".join(r[3] + filler[len(r[3]) :] for r in held)
        return pd.DataFrame({
            "shard": [held[0][0] // shard_records], "first_slot": [held[0][0]], "slots": [shard_records], "stride": [width * size], "width": [width], "data": [data],
            "doc_ids": [[None if pd.isna(r[1]) else r[1] for r in held]], "pieces": [[r[2] for r in held]], "lengths": [[len(r[3]) // width for r in held]], "crc32": [zlib.crc32(data)],
        })

    ranged.mapInPandas(
        assemble, f"shard long, first_slot long, slots int, stride int, width int, data binary, doc_ids array<{kind}>, pieces array<int>, lengths array<int>, crc32 long"
    ).write.option("compression", "zstd").parquet(path)


def read_from(spark: SparkSession, path: str, slot: int = 0) -> DataFrame:
    """Records (slot, shard, at, doc_id, piece, length, width, ids binary) from ``slot`` on.

    The bound on first_slot is a plain number, taken from the size of the shards, so files and row groups of earlier shards are
    skipped by their statistics.
    """
    shards = spark.read.parquet(path)
    whole = shards.select("slots").first() if slot else None
    if whole:
        shards = shards.where(F.col("first_slot") > slot - whole["slots"])
    flat = shards.select("shard", "first_slot", "stride", "width", "data", "doc_ids", "pieces", F.posexplode("lengths").alias("n", "length"))
    at = F.col("n") * F.col("stride")
    return flat.select(
        (F.col("first_slot") + F.col("n")).alias("slot"), "shard", at.cast("long").alias("at"),
        F.get("doc_ids", F.col("n")).alias("doc_id"), F.get("pieces", F.col("n")).alias("piece"), "length", "width",
        F.substring("data", at + 1, F.col("length") * F.col("width")).alias("ids"),
    ).where(F.col("slot") >= slot)


def read_shards(rows: list, order: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, ids) of collected shard rows, as a loader walks them."""
    for r in sorted(rows, key=lambda r: r["first_slot"]) if order else rows:
        if zlib.crc32(r["data"]) != r["crc32"]:
            raise ValueError(f"shard {r['shard']} is damaged")
        ids = np.frombuffer(r["data"], f"<u{r['width']}").reshape(-1, r["stride"] // r["width"])
        for i, length in enumerate(r["lengths"]):
            yield r["first_slot"] + i, ids[i, :length]
