import hashlib
import re
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chartframes.llm import mixing
from tests.llm.odd import against_duckdb


def slow_targets(sizes, most=3):
    """Shares by weight; what is above a bound is shared again among the others, in rounds. Null comes last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(i % 3 + 1) for i, s in enumerate(names)}
    total, bound = Fraction(sum(sizes.values())), set()
    while True:
        rest = total - sum(most * sizes[s] for s in bound)
        left = sum(weight[s] for s in names if s not in bound)
        want = {s: Fraction(most * sizes[s]) if s in bound else rest * weight[s] / left for s in names}
        above = {s for s in names if want[s] > most * sizes[s]}
        if not above:
            return want
        bound |= above


def slow_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_coin(doc_id, text):
    parts = "".join("/" if x is None else f"/={x}" for x in (doc_id, text))
    return int(hashlib.md5(f"1{parts}".encode()).hexdigest()[:13], 16) / 2**52


def slow_copies(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + slow_size(text)
    want = slow_targets(sizes)
    out = []
    for doc_id, text, source in rows:
        rate = float(want[source]) / sizes[source] if sizes[source] else 0.0
        out.append((doc_id, slow_size(text), sizes[source], float(want[source]), int(rate) + (slow_coin(doc_id, text) < rate - int(rate))))
    return out


def test_query_equals_duckdb_and_is_near_its_targets(spark):
    rows = against_duckdb(spark, "op11_source_mix", "/root/testdata/sf0.01")  # doc_id, size, source_size, target, taken
    assert len(rows) == 1000 and all(0 <= r[4] <= 3 * r[1] for r in rows)
    by_source = {}
    for _, _, size, target, taken in rows:
        by_source.setdefault((size, target), []).append(taken)
    assert sum(t for _, t in by_source) == pytest.approx(sum(s for s, _ in by_source))
    assert sum(sum(x) for x in by_source.values()) == pytest.approx(sum(s for s, _ in by_source), rel=0.1)
    assert all(target <= 3 * size and abs(sum(x) - target) < 0.5 * target for (size, target), x in by_source.items())


ODD = [
    (1, None, None), (2, "", "a"), (3, "one two", "a"), (4, "three", None), (4, "three", None), (None, "no id", "b"), (None, None, "b"),
    (5, "x\u00a0y\x85z \t\n\r\x0b\x0c w", ""), (6, "word " * 60_000, "\U0001f600"), (7, "few", "\uffff"), (8, " ", "empty"), (9, "a b c d", "a"),
]


def test_odd_rows_against_brute_force(spark):
    df = spark.createDataFrame([(*r, 1) for r in ODD], "doc_id long, text string, source string, size int")
    got = mixing.with_copies(mixing.measured(df)).select("doc_id", "size", "source_size", "target", "copies").collect()
    key = lambda r: tuple(str(x) for x in (r[0], r[1], r[2], r[4]))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(slow_copies(ODD), key=key), strict=True):
        assert (g[0], g[1], g[2], g[4]) == (w[0], w[1], w[2], w[4]) and g[3] == pytest.approx(w[3])
    mixed = mixing.mix(df)
    assert mixed.columns == ["doc_id", "text", "source", "size", "copy"]
    want = [(d, t, s, c) for (d, t, s), w in zip(ODD, slow_copies(ODD), strict=True) for c in range(1, w[4] + 1)]
    assert sorted(map(tuple, mixed.drop("size").collect()), key=str) == sorted(want, key=str)
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.with_copies(mixing.measured(df.limit(0))).collect() == []
    nothing = mixing.with_copies(mixing.measured(df.where("size(split(trim(text), ' ')) = 1 AND trim(text) = ''"))).collect()
    assert nothing and all(r.copies == 0 and r.target == 0 for r in nothing)


def test_reruns_and_partitions_agree(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    ids = lambda d: sorted((str(r.doc_id), r.copy) for r in mixing.mix(d).collect())
    assert ids(df) == ids(df.repartition(7)) == ids(df.orderBy("text"))


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text("ab\u00e9\U0001f600", max_size=3)), st.integers(0, 10**12), min_size=1, max_size=12), st.booleans())
def test_targets_are_those_of_sharing_in_rounds(spark, sizes, small):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    limit = mixing.TASK_ROWS if small else 0  # 0: the way of many sources, sorted
    got = {r.source: r.target for r in mixing.targets(mixing.turning_weights(df, limit=limit), limit=limit).collect()}
    want = slow_targets(sizes)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(float(v), rel=1e-9) for k, v in want.items())
    assert all(got[k] <= 3 * v for k, v in sizes.items())


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    plan = mixing.mix(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
