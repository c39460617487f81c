import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chartframes.llm import tries
from tests.llm.odd import against_duckdb


def slow(rows):
    """(conv_id, turn, role, text) rows to what the trie must be."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    members, ends = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        turns = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    out = []
    for path, who in members.items():
        below = [q for q in members if q[: len(path)] == path]
        childless = [q for q in below if not any(len(o) == len(q) + 1 and o[:-1] == q for o in below)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()
        children = sum(len(q) == len(path) + 1 for q in below)
        out.append((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), children, len(childless), saved, digest))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted(map(tuple, tries.prefix_trie(df, **kw).collect()), key=str)


def test_query_equals_duckdb(spark):
    rows = against_duckdb(spark, "op12_conversation_prefix_trie", "/root/testdata/sf0.01")
    assert len(rows) > 300 and max(r[3] for r in rows) == 100


ODD = [
    (0, 1, "system", "s"), (0, 2, "user", "é\U0001f600"), (0, 3, "user", None), (0, 4, None, "x"), (0, 5, None, None), (0, 6, "a", "end"),
    (1, 1, "q", "1"), (1, None, "first", "f"), (1, None, "first", "f"), (2, 7, "r", "y"), (3, 2, "a", "b" * 100_000), (3, 1, "a", "b"), (5, 1, "", "z"),
    (None, 1, "no", "id"), (150, 1, "g", "absent first"), (151, 1, "g", "absent first"), (151, 2, "g", "more"), (152, 1, "g", "absent first"),
    (-5, 1, "n", "minus"), (-105, 1, "n", "minus"), (7, 3, "t", "tie a"), (7, 3, "t", "tie b"), (8, 1, "long", "l"),
] + [(9, i, "deep", str(i)) for i in range(40)] + [(10, i, "deep", str(i)) for i in range(40)] + [(i, 1, "same", "turn") for i in range(200, 260)]


@pytest.mark.parametrize("limit", [tries.TASK_NODES, 6])
def test_odd_rows_against_brute_force(spark, limit):
    df = spark.createDataFrame([(*r, "x") for r in ODD if r[:2] != (7, 3)], "conv_id long, turn long, role string, text string, node string")
    assert got(df, limit=limit) == slow([r for r in ODD if r[:2] != (7, 3)])


def test_ties_and_the_empty_table(spark):
    df = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
    assert got(df) == got(df.repartition(5)) and len(got(df)) == len(slow(ODD))
    assert got(df.limit(0)) == [] == got(df.where("conv_id IS NULL"))


def slow_sums(up, values):
    out = values.copy()
    for i in range(len(up)):
        p = up[i]
        while p >= 0:
            out[p] += values[i]
            p = up[p]
    return out


def forest(n, shape, seed):
    """Parents' places of a forest: a chain, a star, a caterpillar or a random one."""
    rng = np.random.default_rng(seed)
    i = np.arange(n)
    up = {"chain": i - 1, "star": np.where(i, 0, -1), "caterpillar": np.where(i % 2, i - 1, i - 2), "random": np.where(i, (rng.random(n) * i).astype(int), -1)}[shape]
    up = np.where((i % 50 == 0) & (rng.random(n) < 0.5), -1, np.maximum(up, -1))
    order = rng.permutation(n)
    out = np.full(n, -1)
    out[order] = np.where(up < 0, -1, order[up])
    return out, rng.integers(-(10**12), 10**12, (n, 2))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.sampled_from(["chain", "star", "caterpillar", "random"]), st.integers(0, 10**6))
def test_subtree_sums(n, shape, seed):
    up, values = forest(n, shape, seed)
    assert (tries.subtree_sums(up, values) == slow_sums(up, values)).all()


@pytest.mark.parametrize("shape", ["chain", "star", "caterpillar", "random"])
def test_rollup_cuts_large_components_in_spark(spark, shape):
    up, values = forest(300, shape, 5)
    number = np.arange(300) * (1 << 40) + 3
    rows = [(int(number[i]), int(number[u]) if u >= 0 else None, int(v[0]), int(v[1])) for i, (u, v) in enumerate(zip(up, values, strict=True))]
    df = spark.createDataFrame(rows, "node long, parent long, x long, y long")
    found = {r.node: (r.x, r.y) for r in tries.rollup(df, ["x", "y"], limit=40).collect()}
    assert found == {int(number[i]): tuple(s) for i, s in enumerate(slow_sums(up, values).tolist())}
