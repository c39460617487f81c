"""The prefix trie of conversations, and sums over the subtrees of a forest by centroid decomposition.

Removing a centroid, a node below which hang at most half of a component's nodes while more than half
hang from it upwards, cuts the component into parts of at most half its size. So each node is in few components
one after the other, however deep the forest is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartframes.llm.common import pin, take
from chartframes.operators.ordered import row_number, running_sum
from chartframes.operators.skew import attach, fits_one_task

#: A component with no more nodes than this is finished inside one task.
TASK_NODES = 8192
#: Conversations are grouped by so many numbers; the first of a group lends its first turns to the others.
GROUP = 100
#: A conversation takes fewer first turns than this from the first of its group.
HEADS = 6
#: The largest prime below 2^63; sums of digests are taken modulo this number.
PRIME = 9223372036854775783


def _pointed(up: np.ndarray) -> np.ndarray:
    """Where the pointers ``up`` lead in the end; -1 ends a walk."""
    to = np.where(up < 0, np.arange(len(up)), up)
    while True:
        further = to[to]
        if (further == to).all():
            return to
        to = further


def subtree_sums(up: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (nodes, columns) over the subtree of each node; ``up`` is the parent's place or -1.

    In each round every component's centroid gets the total of what hangs from it, which is also added to the nodes on
    the path from there to the top; then the component falls apart. Nodes with more than half of a
    component below them form a chain from the top, so the path needs no walk and the centroid is its end.
    """
    n = len(up)
    up, out, carried = up.copy(), np.zeros_like(values), np.zeros_like(values)
    size, to = np.ones(n, np.int64), up.copy()
    while (to >= 0).any():  # what is less than 1, 2, 4, ... levels below
        has = to >= 0
        more = np.zeros(n, np.int64)
        np.add.at(more, to[has], size[has])
        size = size + more
        to = np.where(has, to[np.where(has, to, 0)], -1)
    top = _pointed(up)
    left = np.arange(n)
    while len(left):
        whole = size[top[left]]
        heavy = left[2 * size[left] > whole]
        least = np.full(n, n + 1)
        np.minimum.at(least, top[heavy], size[heavy])
        is_centroid = size[heavy] == least[top[heavy]]
        centroid = np.full(n, -1)
        centroid[top[heavy[is_centroid]]] = heavy[is_centroid]
        done = np.zeros(n, bool)
        done[heavy[is_centroid]] = True
        above = up[left]
        up[left[done[left] | (above >= 0) & done[above]]] = -1
        part = _pointed(up)
        below = left[done[left] | (part[left] != top[left])]
        total = np.zeros_like(values)
        np.add.at(total, top[below], values[below])
        middle = heavy[is_centroid]
        out[middle] = carried[middle] + total[top[middle]]
        path = heavy[~is_centroid]
        carried[path] += total[top[path]]
        size[path] -= size[centroid[top[path]]]
        top = part
        left = left[~done[left]]
    return out


def _tops(nodes: DataFrame) -> DataFrame:
    """(node, top) of ``nodes`` (node, up), where up is null at a top: pointers jump twice as far in each round."""
    walking = pin(nodes.select("node", F.coalesce("up", "node").alias("to"), F.col("up").isNull().alias("there")))
    while not walking.where("NOT there").isEmpty():
        ahead = walking.select(F.col("node").alias("to"), F.col("to").alias("then"), F.col("there").alias("__there"))
        # those that have arrived stay out of the join: a top may be where a third of all pointers lead
        moved = walking.where("NOT there").join(ahead, "to").select("node", F.col("then").alias("to"), F.col("__there").alias("there"))
        walking = pin(walking.where("there").unionByName(moved))
    return walking.select("node", F.col("to").alias("top"))


def _sizes(forest: DataFrame) -> DataFrame:
    """(node, size, top) of ``forest`` (node, up): the nodes of each subtree; in each round twice as many levels are counted."""
    counted = pin(forest.select("node", F.col("up").alias("to"), F.col("node").alias("top"), F.lit(1).cast("long").alias("size")))
    while not counted.where("to IS NOT NULL").isEmpty():
        more = counted.where("to IS NOT NULL").groupBy(F.col("to").alias("node")).agg(F.sum("size").alias("more"))
        ahead = counted.select(F.col("node").alias("to"), F.col("to").alias("then"), F.col("top").alias("their"))
        counted = pin(
            counted.join(more, "node", "left").join(ahead, "to", "left").select(
                "node", F.col("then").alias("to"), F.coalesce("their", "top").alias("top"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")
            )
        )
    return counted.select("node", "size", "top")


def rollup(forest: DataFrame, values: Sequence[str], node: str = "node", parent: str = "parent", limit: int = TASK_NODES) -> DataFrame:
    """One row per node with the sums of the whole-number columns ``values`` over its subtree, the node included.

    ``forest`` has a row per node: its number, its parent's number, null at a top, and the values, null counting as 0.
    Components of more than ``limit`` nodes are cut at their centroids, round by round, the totals below a
    centroid being added along its path to the top; smaller ones are dealt into tasks of about ``limit`` nodes, which go on
    likewise. Neither the number of rounds nor a task's memory depends on depths or numbers of children. A
    node number must occur once, and a parent's number must be that of a node; an empty table gives no rows.
    """
    plain = pin(
        forest.select(
            F.col(f"`{node}`").cast("long").alias("node"), F.col(f"`{parent}`").cast("long").alias("up"),
            *[F.coalesce(F.col(f"`{v}`").cast("long"), F.lit(0)).alias(f"v{i}") for i, v in enumerate(values)],
        )
    )
    own, carried, totals = ([f"{k}{i}" for i in range(len(values))] for k in "vct")
    none = {c: F.lit(0).cast("long") for c in carried}
    todo = pin(plain.join(_sizes(plain), "node").withColumns(none))
    small, done = [], []
    while True:
        whole = todo.where("node = top").select("top", F.col("size").alias("whole"), F.col("size").alias("__rows"))
        todo = attach(todo, whole, "top", "__rows").drop("__rows")
        small.append(todo.where(F.col("whole") <= limit).drop("whole"))
        large = pin(todo.where(F.col("whole") > limit))
        if large.isEmpty():
            break
        heavy = large.where(2 * F.col("size") > F.col("whole"))
        middle = heavy.groupBy("top").agg(F.min_by("node", "size").alias("middle"), F.min("size").alias("below"), F.first("whole").alias("__rows"))
        marked = pin(attach(large, middle, "top", "__rows").drop("__rows"))
        is_middle = F.col("node") == F.col("middle")
        cut = marked.withColumn("up", F.when(~is_middle & (F.col("up").isNull() | (F.col("up") != F.col("middle"))), F.col("up")))
        parted = pin(cut.join(_tops(cut.select("node", "up")).withColumnRenamed("top", "part"), "node"))
        # the totals of the parts that the centroid leaves below it, and of itself
        below = parted.where(is_middle | (F.col("part") != F.col("top")))
        total = below.groupBy("top").agg(*[F.sum(v).alias(t) for v, t in zip(own, totals, strict=True)], F.first("whole").alias("__rows"))
        summed = pin(attach(parted, total, "top", "__rows").drop("__rows"))
        done.append(summed.where(is_middle).select("node", *[(F.col(c) + F.col(t)).alias(v) for c, t, v in zip(carried, totals, own, strict=True)]))
        on_path = (2 * F.col("size") > F.col("whole")) & ~is_middle
        added = {c: F.when(on_path, F.col(c) + F.col(t)).otherwise(F.col(c)) for c, t in zip(carried, totals, strict=True)}
        todo = pin(
            summed.where(~is_middle).withColumns(added | {"size": F.when(on_path, F.col("size") - F.col("below")).otherwise(F.col("size"))})
            .select("node", "up", F.col("part").alias("top"), "size", *own, *carried)
        )
    rest = pin(_union(small))
    deals = max(-(-rest.count() // limit), 1)
    columns = ["node", *own]

    def finish(frames):
        frames = [f.astype(np.int64) for f in frames]
        if not frames:
            return
        frame = pd.concat(frames, ignore_index=True)
        number, above = frame["node"].to_numpy(), frame["up"].to_numpy()
        order = np.argsort(number)
        up = order[np.minimum(np.searchsorted(number, above, sorter=order), len(number) - 1)]
        sums = subtree_sums(np.where(number == above, -1, up), frame[own].to_numpy()) + frame[carried].to_numpy()
        yield pd.DataFrame({"node": number} | {v: sums[:, i] for i, v in enumerate(own)})

    kinds = ", ".join(f"{c} long" for c in columns)
    rest = rest.withColumn("up", F.coalesce("up", "node"))  # no nulls, which pandas would make floats of
    dealt = rest.repartitionById(deals, F.pmod(F.xxhash64("top"), F.lit(deals)).cast("int"))
    found = _union([dealt.mapInPandas(finish, kinds), *done])
    return found.select(F.col("node").alias(node), *[F.col(v).alias(name) for v, name in zip(own, values, strict=True)])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, depth, c1, c2, chars) with the digest (a, b) of the turns up to each one, and of those before it.

    A digest is the sum of two 64-bit hashes of (place, turn) over the turns, modulo a prime, so prefixes need running sums only,
    which cut a conversation of any length into parts.
    """
    terms = turns.withColumns({f"h{i}": F.xxhash64("depth", f"c{i}", F.lit(i)).cast("decimal(20,0)") for i in (1, 2)})
    limit = None if fits_one_task(turns, ["conv_id"]) else 0
    for i in (1, 2):
        terms = running_sum(terms, "conv_id", "depth", f"h{i}", f"s{i}", limit)
    mod = lambda c: (c % F.lit(PRIME).cast("decimal(19,0)")).cast("long")
    s1, s2, h1, h2 = (F.col(c) for c in ("s1", "s2", "h1", "h2"))
    return terms.select("conv_id", "depth", "chars", mod(s1).alias("a"), mod(s2).alias("b"), mod(s1 - h1).alias("pa"), mod(s2 - h2).alias("pb"))


def rebuilt(
    conversations: DataFrame, heads: Column | None = None, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
    text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, c1, c2, chars), and conversations (conv_id, n_turns), rebuilt with the heads of their groups.

    Turns go by number, null first, equal ones by a hash of role and text. Conversation c has the first h turns of
    conversation c - c % ``GROUP``, fewer if it has fewer, and then its own without its first h; ``heads`` gives h below
    ``HEADS`` from conv_id and is by default the CRC-32 of the number in decimal, modulo ``HEADS``. Null roles and
    texts are empty; turns without a conv_id are left out.
    """
    plain = take(conversations, conv_id=id_column, turn=turn_column, role=role_column, text=text_column).where("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = pin(plain.select("conv_id", "turn", F.xxhash64(role, text).alias("c1"), F.xxhash64(F.lit(7), text, role).alias("c2"), F.char_length(text).cast("long").alias("chars")))
    own = pin(row_number(turns, "conv_id", ["turn", "c1", "c2", "chars"], "place"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS if heads is None else heads
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows")).withColumns({"h": h.cast("int"), "first": F.col("conv_id") - F.col("conv_id") % GROUP})
    places = own.where((F.col("place") < HEADS) & (F.col("conv_id") % GROUP == 0))  # less than HEADS rows a conversation
    lent = places.groupBy(F.col("conv_id").alias("first")).agg(F.array_sort(F.collect_list(F.struct("place", "c1", "c2", "chars"))).alias("lent"))
    none = F.array().cast("array<struct<place:bigint,c1:bigint,c2:bigint,chars:bigint>>")
    lent = convs.join(lent, "first", "left").select("conv_id", "rows", "h", F.slice(F.coalesce("lent", none), F.lit(1), F.col("h")).alias("lent"))
    joined = pin(lent)
    size = F.size("lent")
    moved = attach(own, joined.select("conv_id", "rows", "h", size.alias("n_lent")), "conv_id", "rows").where("place > h")
    kept = moved.select("conv_id", (F.col("place") - F.col("h") + F.col("n_lent")).alias("depth"), "c1", "c2", "chars")
    taken = joined.select("conv_id", F.explode("lent").alias("x")).select("conv_id", F.col("x.place").alias("depth"), "x.c1", "x.c2", "x.chars")
    lengths = joined.select("conv_id", (size + F.greatest(F.col("rows") - F.col("h"), F.lit(0))).cast("long").alias("n_turns"))
    return taken.unionByName(kept), lengths


def _ends(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of ``ends`` (conv_id, depth, a, b): the numbers that end at a node, in order, as one text's digest.

    A digest of one text cannot be made of parts, so a node's numbers are read one after the other from Spark's sort, which
    spills: a task holds a batch of them, however many end at the node.
    """
    keys = ["depth", "a", "b"]

    def read(frames):
        key, sha = None, None
        for f in frames:
            found = []
            k, ids = f[keys].to_numpy(np.int64), f["conv_id"].to_numpy(np.int64)
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(k)], strict=True):
                text = ",".join(map(str, ids[i:j].tolist())).encode()
                if key == (here := tuple(k[i].tolist())):
                    sha.update(b"," + text)
                    continue
                if key is not None:
                    found.append((*key, sha.hexdigest()))
                key, sha = here, hashlib.sha256(text)
            if found:
                yield pd.DataFrame(found, columns=[*keys, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, sha.hexdigest())], columns=[*keys, "ends_sha256"])

    return ends.repartition(*keys).sortWithinPartitions(*keys, "conv_id").mapInPandas(read, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, limit: int = TASK_NODES, **columns: str) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The nodes are the distinct sequences of first turns (role, text) of the conversations that ``rebuilt`` gives, which
    takes ``columns``; the root is the empty one. ``conv_id`` is the smallest conversation that begins so, ``n_convs`` their
    number. ``n_leaves`` counts childless nodes of the subtree, ``saved_tokens`` adds up over it the characters that need
    not be kept because a last turn is shared, and ``ends_sha256`` is over the conversations that end at the node. Two
    sequences are one if two 64-bit sums agree. Repeated turns count once each; turns of equal number go by a hash of
    role and text; other columns are not read; an empty table gives no rows, not even a root.
    """
    turns, lengths = rebuilt(conversations, **columns)
    lengths, prefixes = pin(lengths), pin(_prefixes(turns))
    key = ["depth", "a", "b"]
    zero = [F.lit(0).cast("long").alias(c) for c in (*key, "pa", "pb", "chars")]
    nodes = prefixes.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in ("pa", "pb", "chars")])
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select("*", *zero)
    nodes = pin(nodes.unionByName(root).withColumn("node", F.monotonically_increasing_id()))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    edges = pin(nodes.where("depth > 0").join(above, ["depth", "pa", "pb"]).unionByName(nodes.where("depth = 0"), allowMissingColumns=True))
    children = edges.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    forest = pin(
        edges.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    )
    sums = rollup(forest, ["n_leaves", "saved_tokens"], limit=limit)
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("x")).select("conv_id", "x.*")
    turnless = lengths.where("n_turns = 0").select("conv_id", *zero[:3])
    ends = _ends(last.unionByName(turnless))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return forest.drop("n_leaves", "saved_tokens").join(sums, "node").join(ends, key, "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
