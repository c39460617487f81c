"""SimHash near-duplicates: fingerprints, and a self-join of their binary trie within a Hamming budget."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartframes.llm.common import components, give_back, pin, take, without_rows

BITS = 64
SEED = 42
#: Trie levels that one distributed step goes down.
STEP = 4
#: A pair of nodes with no more fingerprints than this is finished inside one task.
NODE_PAIR_ROWS = 65_536
#: Node pairs that a task walks at once; beyond it the walk goes depth first.
FRONTIER = 1 << 17
#: Pairs of fingerprints that a task compares at once.
COMPARED = 1 << 20


def fingerprint(text: str | None, size: int = 3) -> int:
    """The 64-bit SimHash of the whole text, as a signed integer.

    Words are maximal runs of anything but ASCII white space, A-Z in lower case. A shingle is ``size`` words
    joined by spaces, every occurrence counts; a text of fewer words is one shingle; no words give 0.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > size:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)), "<u8", len(starts)
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def text_fingerprint(texts: pd.Series) -> pd.Series:
    out = pd.Series([fingerprint(x) for x in texts], dtype="int64")
    give_back()
    return out


def _compare(left, right, a0, a1, b0, b1, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs between the ranges of small nodes, portion by portion; each range holds few fingerprints."""
    sizes = (a1 - a0) * (b1 - b0)
    upto = np.cumsum(sizes)
    cuts = np.unique(np.searchsorted(upto, np.arange(COMPARED, upto[-1], COMPARED)))
    for own in np.split(np.arange(len(sizes)), cuts):
        size = sizes[own]
        which = np.repeat(own, size)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        width = (b1 - b0)[which]
        i, j = a0[which] + nth // width, b0[which] + nth % width
        near = np.bitwise_count(left[i] ^ right[j]) <= budget
        if left is right:
            near &= i < j
        if near.any():
            yield i[near], j[near]


def walk(left: np.ndarray, right: np.ndarray, depth: int, used: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions whose fingerprints differ in at most ``budget`` bits, walking two tries together.

    ``left`` and ``right`` are sorted unsigned fingerprints, each below one node at ``depth``; ``used`` bits
    differ above. A trie node is a range of a sorted array. If both are the same array, a pair comes once.
    """
    same = left is right
    todo = [(depth, np.array([[0], [len(left)], [0], [len(right)], [used]], np.int64))]
    while todo:
        depth, node = todo.pop()
        if node.shape[1] > FRONTIER:
            half = node.shape[1] // 2
            todo += [(depth, node[:, :half]), (depth, node[:, half:])]
            continue
        a0, a1, b0, b1, used_ = node
        small = ((a1 - a0) * (b1 - b0) <= 64) | (depth == BITS)
        if small.any():
            yield from _compare(left, right, *(x[small] for x in (a0, a1, b0, b1)), budget)
            a0, a1, b0, b1, used_ = node[:, ~small]
        if not len(a0):
            continue
        bit = np.uint64(1 << (BITS - 1 - depth))
        keep = np.uint64((1 << BITS) - (1 << (BITS - depth)))  # the bits above
        am = np.clip(np.searchsorted(left, (left[a0] & keep) | bit), a0, a1)
        bm = np.clip(np.searchsorted(right, (right[b0] & keep) | bit), b0, b1)
        mirrored = (a0 == b0) & (a1 == b1) if same else np.zeros(len(a0), bool)
        children = np.concatenate(
            [
                [a0, am, b0, bm, used_],
                [am, a1, bm, b1, used_],
                [a0, am, bm, b1, used_ + 1],
                np.array([am, a1, b0, bm, used_ + 1])[:, ~mirrored],
            ],
            axis=1,
        )
        alive = (children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= budget)
        if alive.any():
            todo.append((depth + 1, children[:, alive]))


def _forest(rows: pd.DataFrame, budget: int) -> pd.DataFrame:
    """Links between the fingerprints of one node pair, without those that earlier links already imply."""
    depth, used, alone = int(rows["depth"].iloc[0]), int(rows["used"].iloc[0]), bool(rows["alone"].iloc[0])
    fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
    side = rows["side"].to_numpy()
    left = np.sort(fps[side == 0])
    right = left if alone else np.sort(fps[side == 1])
    names = left if alone else np.concatenate([left, right])
    shift = 0 if alone else len(left)
    root = list(range(len(names)))
    kept: list[tuple[int, int]] = []
    for i, j in walk(left, right, depth, used, budget):
        for a, b in zip(i.tolist(), (j + shift).tolist(), strict=True):
            x, y = a, b
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            while root[y] != y:
                root[y] = root[root[y]]
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                kept.append((a, b))
    ends = np.array(kept, np.int64).reshape(-1, 2)
    found = names.view(np.int64)[ends]
    give_back()
    return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})


def _prefix(depth: int) -> Column:
    """The top ``depth`` bits of the fingerprint as a number of their own."""
    return F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("long")


def trie_links(fps: DataFrame, budget: int = 2, rows: int = NODE_PAIR_ROWS) -> DataFrame:
    """Links (a, b) that connect all pairs of distinct fingerprints at most ``budget`` bits apart.

    The trie is walked from the root as a DataFrame of node pairs with the bits used so far: a step goes
    ``STEP`` levels down and makes only those partners that the budget left allows. A pair leaves the walk as
    soon as both nodes together hold at most ``rows`` fingerprints, and one task finishes it. So no task ever
    holds more than ``rows`` fingerprints, however they are spread; the result links whole components, not all pairs.
    """
    spark = fps.sparkSession
    total = fps.count()
    pairs = spark.sql("SELECT 0L AS a, 0L AS b, 0 AS used")
    leaves = [(0, pairs)] if total <= rows else []
    depth = 0
    while total > rows and depth < BITS:
        deeper = depth + STEP
        children = fps.groupBy(_prefix(deeper).alias("c")).agg(F.count(F.lit(1)).alias("n"))
        if depth:
            nodes = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
            children = children.withColumn("a", F.shiftright("c", STEP)).join(nodes, "a", "left_semi").drop("a")
        children = pin(children.withColumn("parent", F.shiftright("c", STEP)))
        masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("bits")) for m in range(1 << STEP) if m.bit_count() <= budget])
        left = children.select(F.col("parent").alias("a"), F.col("c").alias("a2"), F.col("n").alias("n_a"))
        right = children.select(F.col("c").alias("b2"), F.col("n").alias("n_b"))
        entered = pairs.join(left, "a") if depth else left.withColumns({"b": F.lit(0).cast("long"), "used": F.lit(0)})
        spread = entered.withColumn("mask", F.explode(F.filter(masks, lambda x: x["bits"] + F.col("used") <= budget)))
        spread = spread.select(
            "a2", "n_a", (F.col("used") + F.col("mask.bits")).alias("used"),
            (F.shiftleft("b", STEP) + F.col("a2").bitwiseAND((1 << STEP) - 1).bitwiseXOR(F.col("mask.m"))).alias("b2"),
        )
        found = pin(spread.join(right, "b2").where("a2 <= b2"))
        whole = F.when(F.col("a2") == F.col("b2"), F.col("n_a")).otherwise(F.col("n_a") + F.col("n_b"))
        found = found.select(F.col("a2").alias("a"), F.col("b2").alias("b"), "used", whole.alias("n"))
        depth = deeper
        leaves.append((depth, found.where(F.col("n") <= rows) if depth < BITS else found))
        pairs = found.where(F.col("n") > rows).drop("n")
        if pairs.isEmpty():
            break

    def members(depth: int, pairs: DataFrame) -> DataFrame:
        if not depth:  # the root with itself
            zero = [F.lit(0).cast(kind).alias(n) for n, kind in (("depth", "int"), ("a", "long"), ("b", "long"), ("side", "int"), ("used", "int"))]
            return fps.select(*zero, "fp", F.lit(True).alias("alone"))
        pairs = pairs.where((F.col("a") != F.col("b")) | F.lit(depth < BITS)).select(
            F.explode(
                F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("side"))))
                .otherwise(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("side")), F.struct(F.col("b").alias("node"), F.lit(1).alias("side"))))
            ).alias("x"),
            F.lit(depth).alias("depth"), "a", "b", "used",
        )
        return fps.select("fp", _prefix(depth).alias("node")).join(pairs.select("x.node", "x.side", "depth", "a", "b", "used"), "node").select(
            "depth", "a", "b", "side", "used", "fp", (F.col("a") == F.col("b")).alias("alone")
        )

    parts = [members(d, p) for d, p in leaves]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined.groupBy("depth", "a", "b").applyInPandas(lambda group: _forest(group, budget), "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", budget: int = 2) -> DataFrame:
    """One row (doc_id, fingerprint, component_id, text_hash) per document.

    Documents are linked if their fingerprints differ in at most ``budget`` bits; ``component_id`` is the
    smallest doc_id that can be reached. Equal fingerprints are joined as one before the trie is walked, so a
    group of copies costs one entry. Null and empty texts have fingerprint zero and are linked like any
    other. Repeated rows come out once each; a null doc_id is later than any other, and a component of null
    doc_ids only has a null component_id. An empty table gives no rows; other columns are not read.
    """
    plain = take(docs, doc_id=id_column, text=text_column)
    marked = pin(plain.select("doc_id", text_fingerprint("text").alias("fp"), F.xxhash64("text").alias("text_hash")))
    fps = pin(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(trie_links(fps, budget)).select(F.col("node").alias("fp"), "root")
    roots = fps.join(found, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = pin(roots.join(smallest, "root").select("fp", "component_id", "root"))
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_hash", "root"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and others) that stay: of each group of near copies the smallest doc_id.

    Of rows with that doc_id, or without any, the one with the smallest hash of its text stays, and once only.
    """
    return first_of_each(docs, near_duplicates(docs).select("doc_id", "text_hash", "root"))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that come first in the groups ``found`` (doc_id, text_hash, root)."""
    found = pin(found)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = pin(found.groupBy("root").agg(F.min(order).alias("best")).select("root", "best.doc_id", "best.text_hash"))
    other = best.select("root", F.col("doc_id").alias("best_id"), F.col("text_hash").alias("best_hash"))
    differs = ~(F.col("doc_id").eqNullSafe(F.col("best_id")) & F.col("text_hash").eqNullSafe(F.col("best_hash")))
    gone = found.join(other, "root").where(differs).select("doc_id", "text_hash")
    kept = without_rows(docs, gone)
    if best.count() < found.join(other, "root").where(~differs).count():  # rows that are repeated as they are
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept
