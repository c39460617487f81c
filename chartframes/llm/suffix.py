"""Removal of repeated passages by prefix doubling over sampled suffixes.

Ranking every byte position would move many times the input, so only sampled suffixes are ranked, and none
is lost: of the 35 strings of 16 bytes in a 50-byte window, the one with the smallest hash is its anchor,
wherever the window occurs. An anchor stands for the run of windows that share it.

1. In a task, the 16-byte ranks come from doubling (1, 2, 4, 8, 16 bytes). Each anchor gets its own rank, the
   rank of all bytes of its windows, and for each of four tiers of its windows, by their distance from the anchor,
   16 bits of the rank of the bytes that all windows of the tier have in common.
2. Spark sorts the anchors by these ranks, half of the ranks at a time, so half of the anchors are on disk at once. An
   anchor whose windows all occur in an earlier document is settled. A tier whose common bytes are in no other document is settled too.
3. The windows of the remaining tiers, of a few percent of the anchors, are ranked again past the threshold. Up to nine
   neighbouring windows go together: two ranks of the 42 bytes that they have in common, and the eight bytes before and
   behind. Spark sorts these again; each window is told by the ranks and its share of the bytes around.

Ranks are 64-bit hashes instead of dense numbers, so no round has to wait for a count of all positions.
Equality is only concluded from two of them (128 bits).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.llm.common import frugal, give_back, join_small, payload_bytes, pin

SEED_BYTES = 16
#: Windows that go together past the threshold, one byte apart: the bytes around what they have in common fill a word.
TOGETHER = 9
#: Tiers of an anchor's windows, with 16 bits each.
TIERS = 4
#: Slices of the ranks that are sorted one after the other: fewer anchors on disk at once, for reading the texts so many times.
SLICES = 2
#: Text that a task ranks at once, and window starts per piece of a longer text.
TEXT_BYTES = 1 << 20
PIECE = 1 << 18

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_S31, _S29 = np.uint64(31), np.uint64(29)
_SHORT = np.uint64(0xFFFF)


def mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One 64-bit rank for each pair of ranks."""
    z = x * _A
    z ^= z >> _S29
    z += y
    z *= _B
    z ^= z >> _S31
    z *= _C
    z ^= z >> _S29
    return z


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number, the first one highest."""
    eight = data.astype(np.uint64)
    for shift in (1, 2, 4):
        eight = eight[:-shift] << np.uint64(8 * shift) | eight[shift:]
    return eight


def seed_ranks(data: np.ndarray) -> np.ndarray:
    """The rank of the 16 bytes from each position on, by doubling."""
    eight = words(data)  # up to 8 bytes fit a word as they are
    return mix(eight[:-8], eight[8:])


def _common(h: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """The rank of the ``length`` bytes from each start on; overlapping seeds cover them all."""
    rank = h[start]
    for offset in range(SEED_BYTES, length - SEED_BYTES, SEED_BYTES):
        rank = mix(rank, h[start + offset])
    return mix(rank, h[start + length - SEED_BYTES])


def _groups(width: int) -> list[tuple[int, int, int]]:
    """Windows that go together: their smallest and largest distance from the anchor, and where their common bytes start before it."""
    seeds = width - SEED_BYTES + 1
    return [(d, min(d + TOGETHER, seeds) - 1, min(d, seeds - TOGETHER)) for d in range(0, seeds, TOGETHER)]


def _tiers(width: int) -> list[list[tuple[int, int, int]]]:
    groups = _groups(width)
    return [groups[len(groups) * t // TIERS : len(groups) * (t + 1) // TIERS] for t in range(TIERS)]


def anchors(data: np.ndarray, sizes: np.ndarray, width: int, part: int = 0, parts: int = 1) -> dict[str, np.ndarray]:
    """Anchors of the windows of ``width`` bytes in consecutive texts, with their ranks and windows; one of ``parts`` slices of the ranks.

    ``first`` and ``last`` are the first bytes of an anchor's first and last window within ``data``.
    """
    n = len(data)
    names = ("rank", "side", "whole", "first", "last", "at")
    if n < width:
        return {k: np.zeros(0, np.int64) for k in names}
    h = seed_ranks(data)
    seeds = width - SEED_BYTES + 1
    low = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    reach = 1
    while reach * 2 <= seeds:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: n - width + 1], low[seeds - reach : seeds - reach + n - width + 1])
    at = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(at), bool)
    for end in ends[:-1]:
        inside[max(0, end - width + 1) : end] = False
    starts = np.flatnonzero(inside)
    at = at[starts]
    if not len(at):
        return {k: np.zeros(0, np.int64) for k in names}
    fresh = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first, last, p = starts[fresh], starts[np.r_[fresh[1:], len(at)] - 1], at[fresh]
    own = h[p] % np.uint64(parts) == np.uint64(part)  # by the low bits: the high ones chose the anchor
    first, last, p = first[own], last[own], p[own]
    side = np.zeros(len(p), np.uint64)
    for t, tier in enumerate(_tiers(width)):
        near, far = tier[0][0], tier[-1][1]
        start = np.where((first <= p - near) & (last >= p - far), p - near, 0)  # else no window of the tier is there
        side |= (_common(h, start, width - far + near) & _SHORT) << np.uint64(16 * t)
    stop = last + width
    whole = mix((p - first).astype(np.uint64), (stop - first).astype(np.uint64))
    for offset in range(0, width + seeds, SEED_BYTES):  # overlapping seeds cover all bytes of the windows
        whole = mix(whole, h[np.minimum(first + offset, stop - SEED_BYTES)])
    return {"rank": h[p], "side": side, "whole": whole, "first": first, "last": last, "at": p}


def _pieces(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts put together up to ``PIECE`` bytes, longer ones cut with overlap: data, sizes, text number, offset."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def out():
        data = np.frombuffer(b"".join(x[2] for x in held), np.uint8)
        return data, np.array([len(x[2]) for x in held]), np.array([x[0] for x in held]), np.array([x[1] for x in held])

    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - width + 1, 0), PIECE):
            part = text[at : at + PIECE + width - 1]
            if size + len(part) > 2 * PIECE:
                yield out()
                held, size = [], 0
            held.append((i, at, part))
            size += len(part)
    if held:
        yield out()


def _earliest(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the smallest document among the rows with equal keys, and the number of its group."""
    order = np.lexsort([doc, *keys])
    new = np.ones(len(doc), bool)
    if len(doc) > 1:
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    group = np.cumsum(new) - 1
    low = np.empty(len(doc), doc.dtype)
    name = np.empty(len(doc), np.int64)
    low[order] = doc[order][np.flatnonzero(new)][group]
    name[order] = group
    return low, name


def _joined(doc: np.ndarray, tie: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Byte runs with touching and overlapping ones of a document made one."""
    order = np.lexsort([first, tie, doc])
    doc, tie, first, stop = doc[order], tie[order], first[order], stop[order]
    if not len(doc):
        return doc, tie, first, stop
    other = np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]
    base = (np.cumsum(other) - 1) * (int(stop.max()) + 2)  # a lane of its own for each document
    reach = np.maximum.accumulate(stop + base)
    fresh = np.flatnonzero(np.r_[True, (first + base)[1:] > reach[:-1]])
    last = np.r_[fresh[1:], len(doc)] - 1
    return doc[fresh], tie[fresh], first[fresh], (reach - base)[last]


#: ``place`` is what ``_place`` gives; for a run of bytes that is settled it is -1 - first byte, and ``side`` its end.
_SENT = pa.schema([(k, pa.int64()) for k in ("rank", "side", "whole", "doc", "tie", "place")])
#: Windows that go together: ``place`` is the start of their common bytes * 512 + a bit for each window that is there, by its bytes before them.
_SENT_WINDOWS = pa.schema([(k, pa.int64()) for k in ("rank", "side", "whole", "behind", "doc", "tie", "place")])
_RUN = "kind int, doc long, tie long, first long, stop long"


def _place(first: np.ndarray, count: np.ndarray, back: np.ndarray, width: int) -> np.ndarray:
    """An anchor's first byte of windows, their number, and how far behind that byte it is, in one number."""
    bits = width.bit_length()
    return (first << bits | count) << bits | back


def _placed(place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of the first and of the last window, and the anchor, of what ``_place`` gave."""
    bits, low = width.bit_length(), (1 << width.bit_length()) - 1
    first = place >> 2 * bits
    return first, first + (place >> bits & low) - 1, first + (place & low)


def _batches(columns: dict[str, np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    arrays = [pa.array(columns[f.name], f.type) for f in schema]
    table = pa.RecordBatch.from_arrays(arrays, schema=schema)
    for at in range(0, table.num_rows, 100_000):
        yield table.slice(at, 100_000)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows in portions of about ``TEXT_BYTES``, with their texts as bytes."""
    column = batch.column("text").cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    at, size = 0, 0
    for i, length in enumerate(sizes):
        size += length
        if size >= TEXT_BYTES or i == len(sizes) - 1:
            part = slice(at, i + 1)
            yield batch.slice(at, i + 1 - at), [x or b"" for x in column[part].to_pylist()]
            at, size = i + 1, 0


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def _sent_runs(doc: np.ndarray, tie: np.ndarray, first: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
    """Settled runs on their way past the sort, spread by a rank of their own."""
    doc, tie, first, stop = _joined(doc, tie, first, stop)
    rank = _signed(mix(doc.astype(np.uint64), first.astype(np.uint64)))
    return {"rank": rank, "side": stop, "whole": first * 0, "doc": doc, "tie": tie, "place": -1 - first}


def _send_anchors(width: int, slice_: int):
    """Anchors of whole texts; what an earlier document of the same portion settles is sent as runs, rank at random."""

    def send(batches):
        for batch in batches:
            for rows, texts in _texts(batch):
                docs, ties = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tie"))
                found = []
                for data, sizes, names, offsets in _pieces(texts, width):
                    a = anchors(data, sizes, width, slice_, SLICES)
                    ends = np.cumsum(sizes)
                    part = np.searchsorted(ends, a["first"], side="right")
                    shift = offsets[part] - (ends - sizes)[part]
                    found.append(
                        {
                            **{k: _signed(a[k]) for k in ("rank", "side", "whole")}, "doc": docs[names[part]], "tie": ties[names[part]],
                            "first": a["first"] + shift, "count": a["last"] - a["first"] + 1, "back": a["at"] - a["first"],
                        }
                    )
                if not found:
                    continue
                c = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
                c["place"] = _place(c["first"], c["count"], c["back"], width)
                low, _ = _earliest([c["whole"], c["rank"]], c["doc"])
                done = c["doc"] > low
                runs = _sent_runs(*(c[k][done] for k in ("doc", "tie", "first")), (c["first"] + c["count"])[done] + width - 1)
                yield from _batches({k: np.concatenate([c[k][~done], runs[k]]) for k in _SENT.names}, _SENT)

    return send


def _whole_ranks(batches, key: str) -> Iterator[dict[str, np.ndarray]]:
    """Sorted rows of a partition, in portions that do not cut a rank."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        c = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in batch.schema.names}
        if not len(c[key]):
            continue
        cut = int(np.searchsorted(c[key], c[key][-1]))
        if cut:
            yield {k: np.concatenate([h[k] for h in held] + [c[k][:cut]]) for k in c}
            held = []
        held.append({k: v[cut:] for k, v in c.items()})
    if held:
        yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}


_SETTLED = pa.schema([("kind", pa.int32()), ("doc", pa.int64()), ("tie", pa.int64()), ("first", pa.int64()), ("stop", pa.int64())])


def _settled(run: dict[str, np.ndarray], **more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs that came past the sort, and more rows."""
    out = {"kind": np.zeros(len(run["doc"]), np.int32), "doc": run["doc"], "tie": run["tie"], "first": -1 - run["place"], "stop": run["side"]}
    return _batches({k: np.concatenate([out[k], more[k].astype(out[k].dtype)]) for k in out}, _SETTLED)


def _settle(width: int):
    """Kind 0: runs of bytes to remove. Kind 1: anchors with windows that must be ranked past the threshold; ``stop`` has a bit for each tier."""

    def settle(batches):
        for c in _whole_ranks(batches, "rank"):
            run = c["place"] < 0
            q = {k: v[~run] for k, v in c.items()}
            # the rows are sorted by rank, bytes of all windows and document
            new = np.ones(len(q["doc"]), bool)
            new[1:] = (q["rank"][1:] != q["rank"][:-1]) | (q["whole"][1:] != q["whole"][:-1])
            group = np.cumsum(new) - 1
            done = q["doc"] > q["doc"][new][group]
            first, last, at = _placed(q["place"], width)
            # a document that has all windows of an earlier one is no witness that the earlier one is not
            left = np.flatnonzero(~done)
            rank = q["rank"][left].view(np.uint64)
            left = left[_differ(rank, q["doc"][left])]
            rank, side = q["rank"][left].view(np.uint64), q["side"][left].view(np.uint64)
            open_ = np.zeros(len(left), np.int64)
            for t, tier in enumerate(_tiers(width)):
                # common bytes that are in two documents and in different surroundings
                there = np.flatnonzero((first[left] <= at[left] - tier[0][0]) & (last[left] >= at[left] - tier[-1][1]))
                key = mix(rank[there], side[there] >> np.uint64(16 * t) & _SHORT)
                both = _differ(key, q["doc"][left[there]]) & _differ(key, group[left[there]])
                open_[there[both]] |= 1 << t
            left, open_ = left[open_ > 0], open_[open_ > 0]
            yield from _settled(
                {k: v[run] for k, v in c.items()},
                kind=np.repeat([0, 1], [done.sum(), len(left)]),
                **{k: np.concatenate([q[k][done], q[k][left]]) for k in ("doc", "tie")},
                first=np.concatenate([first[done], q["place"][left]]),
                stop=np.concatenate([last[done] + width, open_]),
            )

    return settle


def _differ(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each row whether the rows with its key have more than one value."""
    if not len(key):
        return np.zeros(0, bool)
    order = np.argsort(key)
    sorted_ = key[order]
    start = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    mixed = np.minimum.reduceat(value[order], start) != np.maximum.reduceat(value[order], start)
    out = np.empty(len(key), bool)
    out[order] = np.repeat(mixed, np.diff(np.r_[start, len(key)]))
    return out


def _met_before(c: dict[str, np.ndarray], width: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Bits of the windows that are left, and the runs of bytes of those that an earlier document of the rows has."""
    start, left = c["place"] >> TOGETHER, c["place"] & (1 << TOGETHER) - 1
    rank, whole, before, behind = (c[k].view(np.uint64) for k in ("rank", "whole", "side", "behind"))
    gone, found = np.zeros(len(left), np.int64), []
    for i in range(TOGETHER):  # the window with i bytes before the common ones, and the others behind
        there = np.flatnonzero(left >> i & 1)
        front = before[there] & np.uint64((1 << 8 * i) - 1)
        back = behind[there] >> np.uint64(8 * i) if 8 * i < 64 else behind[there] * np.uint64(0)
        keys = [mix(mix(rank[there], front), back), mix(mix(whole[there], back), front)]
        low, _ = _earliest(keys, c["doc"][there])
        there = there[c["doc"][there] > low]
        gone[there] |= 1 << i
        found.append((c["doc"][there], c["tie"][there], start[there] - i, start[there] - i + width))
    runs = _joined(*(np.concatenate(x) for x in zip(*found, strict=True)))
    return left & ~gone, dict(zip(("doc", "tie", "first", "stop"), runs, strict=True))


def _open_windows(codes: np.ndarray, data: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """Windows of the open tiers of anchors, those that go together in a row; ``codes`` have places in ``data``, which has 8 bytes around texts."""
    first, last, at = _placed(codes >> TIERS, width)
    eight = words(data)
    h = mix(eight[:-8], eight[8:])
    length = width - TOGETHER + 1
    found = []
    for t, tier in enumerate(_tiers(width)):
        for near, far, start in tier:
            there = np.flatnonzero((codes >> t & 1 == 1) & (first <= at - near) & (last >= at - far))
            u = at[there] - start
            has = np.zeros(len(u), np.int64)
            for d in range(near, far + 1):
                has |= ((first[there] <= at[there] - d) & (last[there] >= at[there] - d)).astype(np.int64) << d - start
            rank, pair = h[u], mix(h[u + length - SEED_BYTES], _B)
            for offset in range(0, length - SEED_BYTES, SEED_BYTES):
                rank = mix(rank, h[u + offset])
                pair = mix(h[u + length - SEED_BYTES - offset], pair)
            rank, pair = mix(rank, h[u + length - SEED_BYTES]), mix(h[u], pair)
            found.append((_signed(rank), _signed(eight[u - 8]), _signed(pair), _signed(eight[u + length]), there, u << TOGETHER | has))
    return dict(zip(("rank", "side", "whole", "behind", "code", "place"), (np.concatenate(x) for x in zip(*found, strict=True)), strict=True))


def _send_windows(width: int):
    """The windows of the open tiers of anchors; those that an earlier document of the same portion has are sent as runs."""

    def send(batches):
        for batch in batches:
            for rows, texts in _texts(batch):
                blobs = [np.frombuffer(x, np.int64) for x in rows.column("runs").to_pylist()]
                text = np.repeat(np.arange(len(texts)), [len(x) for x in blobs])
                ends = np.cumsum([len(x) + 8 for x in texts])
                begin = ends - [len(x) for x in texts]
                data = np.frombuffer(b"".join([b"\0" * 8 + x for x in texts]) + b"\0" * 16, np.uint8)
                shift = begin[text] << 2 * width.bit_length() + TIERS
                c = _open_windows(np.concatenate(blobs) + shift, data, width)
                text = text[c.pop("code")]
                c |= {k: rows.column(k).to_numpy(zero_copy_only=False)[text] for k in ("doc", "tie")}
                c["place"] -= begin[text] << TOGETHER
                left, gone = _met_before(c, width)
                c["place"] = c["place"] >> TOGETHER << TOGETHER | left
                c = {k: v[left > 0] for k, v in c.items()}
                runs = _sent_runs(**gone)
                runs["behind"] = runs["whole"]
                yield from _batches({k: np.concatenate([c[k], runs[k]]) for k in _SENT_WINDOWS.names}, _SENT_WINDOWS)

    return send


def _settle_windows(width: int):
    """Runs of bytes to remove, as kind 0."""

    def settle(batches):
        for c in _whole_ranks(batches, "rank"):
            run = c["place"] < 0
            _, gone = _met_before({k: v[~run] for k, v in c.items()}, width)
            yield from _settled({k: v[run] for k, v in c.items()}, kind=gone["doc"] * 0, **gone)

    return settle


def _blobs(runs: DataFrame) -> DataFrame:
    """One row (doc, tie, runs) per document: its runs made one where they touch, packed as pairs of numbers."""

    @F.pandas_udf("binary")
    def pack(first: pd.Series, stop: pd.Series) -> pd.Series:
        zero = [np.zeros(len(x), np.int64) for x in first]
        return pd.Series([np.stack(_joined(z, z, np.asarray(a), np.asarray(b))[2:], 1).tobytes() for z, a, b in zip(zero, first, stop, strict=True)])

    spans = runs.groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "stop")).alias("x"))
    return spans.select("doc", "tie", pack(F.col("x.first"), F.col("x.stop")).alias("runs"))


def _packed(codes: DataFrame) -> DataFrame:
    """One row (doc, tie, runs) per document: its open anchors, each a number of place and tiers."""

    @F.pandas_udf("binary")
    def pack(codes: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(x, np.int64).tobytes() for x in codes])

    numbers = codes.groupBy("doc", "tie").agg(F.collect_list(F.shiftleft("first", TIERS).bitwiseOR(F.col("stop"))).alias("x"))
    return numbers.select("doc", "tie", pack("x").alias("runs"))


def repeated_runs(docs: DataFrame, width: int = 50) -> DataFrame:
    """One row (doc, tie, runs) per document with bytes to remove; ``docs`` is (doc, tie, text)."""

    def sent(schema: pa.Schema) -> str:
        return ", ".join(f"{name} long" for name in schema.names)

    def ranked(rows: DataFrame, settle, *by: str) -> DataFrame:
        return rows.repartition("rank").sortWithinPartitions("rank", *by).mapInArrow(frugal(settle(width)), _RUN)

    parts = [
        pin(ranked(docs.mapInArrow(frugal(_send_anchors(width, k)), sent(_SENT)), _settle, "whole", "doc"), shuffles=False) for k in range(SLICES)
    ]
    settled = reduce(DataFrame.unionByName, parts)
    open_ = pin(_packed(settled.where("kind = 1")), shuffles=False)
    left = join_small(docs, open_, ["doc", "tie"], payload_bytes(open_, "runs"), "inner")
    again = ranked(left.mapInArrow(frugal(_send_windows(width)), sent(_SENT_WINDOWS)), _settle_windows)
    runs = settled.unionByName(again).where("kind = 0").select("doc", "tie", "first", "stop")
    return pin(_blobs(runs), shuffles=False)


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 50, carry: bool = False
) -> DataFrame:
    """One row per document: doc_id, kept binary, kept_text, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of ``width`` bytes covers it that also starts in a document with a smaller doc_id,
    judged on the texts as given. Strings that only repeat within a document stay, and so does the first
    document of a group of copies. Texts are UTF-8 bytes, null ones are empty; ``kept`` may start or end
    inside a character, which ``kept_text`` leaves out. A null doc_id is later than any other; rows with the same
    doc_id are not held against each other, and each keeps its own row. An empty table gives no rows.
    Other columns are not read; with ``carry`` each row comes along whole as a struct ``row``.
    """
    if width < SEED_BYTES + 33:
        raise ValueError("width must be 49 or more, for a window to hold 33 bytes to one side of its anchor")
    if dict(docs.dtypes)[id_column] not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_column} must be a whole number, as the smaller document keeps a passage")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(0)
    plain = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), row.alias("row"))
    ids = plain.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    # repeated ids need the text to tell their rows apart; else the column is a constant
    tie = F.lit(0).cast("long") if ids.isEmpty() else F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = plain.withColumns({"doc": F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("long"), "tie": tie})
    runs = repeated_runs(keyed.select("doc", "tie", "text"), width)

    @F.pandas_udf("kept binary, kept_text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, runs, strict=True):
            text = (text or "").encode("utf-8", "replace")
            spans = [] if spans is None else np.frombuffer(spans, np.int64).reshape(-1, 2).tolist()
            parts = [text[i:j] for i, j in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(text)], strict=True)]
            kept = b"".join(parts)
            plain_text = "".join(p.decode("utf-8", "ignore") for p in parts)
            out.append((kept, plain_text, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        give_back()
        return pd.DataFrame(out, columns=["kept", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    whole = keyed.drop("text") if carry else keyed  # a row has its text
    text = F.col(f"row.`{text_column}`" if carry else "text")
    joined = join_small(whole, runs, ["doc", "tie"], payload_bytes(runs, "runs"))
    found = joined.select("doc_id", *(["row"] if carry else []), cut(text, "runs").alias("c"))
    return found.select("doc_id", *(["row"] if carry else []), "c.*")
