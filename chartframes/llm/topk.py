"""Exact nearest binary codes by incremental multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartframes.llm.common import tasks

SEGMENTS = 4
SEGMENT_BITS = 16
BITS = SEGMENTS * SEGMENT_BITS
#: Codes of the searched table, and query codes, that one task holds at most.
INDEX_BLOCK = 1 << 18
QUERY_BLOCK = 1 << 14
#: Queries that a task takes forward together, which bounds its candidates.
TOGETHER = 64


def sign_code(vector: Column) -> Column:
    """64 bits of a vector: bit i is set if element i is above 0. Null gives null; a longer vector fails the job, as it needs a longer code."""
    long_ = F.raise_error(F.concat(F.lit(f"a code has {BITS} bits, a vector has "), F.size(vector).cast("string"), F.lit(" elements")))
    fitting = F.when(F.size(vector) > BITS, long_).otherwise(vector)
    bits = F.transform(fitting, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


class Index:
    """Codes by the value of each segment."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order, self.first = [], []
        for s in range(SEGMENTS):
            value = self.segment(codes, s)
            self.order.append(np.argsort(value, kind="stable"))
            self.first.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << SEGMENT_BITS))]))

    @staticmethod
    def segment(codes: np.ndarray, s: int) -> np.ndarray:
        return (codes >> np.uint64(SEGMENT_BITS * s) & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, held: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) of all codes up to each query's kth distance; a code counts ``held`` times.

        In round r every bucket is looked up whose segment differs in exactly r bits. A code is taken by the
        first round and segment that meet it. After round r all codes within SEGMENTS * (r + 1) - 1 bits have
        been met, so a query ends once its kth distance is no larger; one with too few codes ends with the last round.
        """
        active = np.arange(len(queries))
        met = [np.zeros((3, 0), np.int64)]
        tally = np.zeros((len(queries), BITS + 1), np.int64)
        for r in range(SEGMENT_BITS + 1):
            flips = np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT_BITS), r)], np.int64)
            for s in range(SEGMENTS):
                value = (self.segment(queries[active], s)[:, None] ^ flips).ravel()
                low, high = self.first[s][value], self.first[s][value + 1]
                size = high - low
                if not size.any():
                    continue
                q = np.repeat(np.repeat(active, len(flips)), size)
                c = self.order[s][np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]
                other = queries[q] ^ self.codes[c]
                new = np.ones(len(q), bool)
                for t in range(SEGMENTS):
                    if t != s:
                        apart = np.bitwise_count(self.segment(other, t))
                        new &= apart > r if t < s else apart >= r
                q, c, d = q[new], c[new], np.bitwise_count(other[new]).astype(np.int64)
                np.add.at(tally, (q, d), held[c])
                met.append(np.stack([q, c, d]))
            sure = tally[active, : min(SEGMENTS * (r + 1), BITS + 1)].sum(1) >= k
            active = active[~sure]
            kth = np.minimum((np.cumsum(tally, 1) < k).sum(1), BITS)
            together = np.concatenate(met, 1)
            met = [together[:, together[2] <= kth[together[0]]]]
            if not len(active):
                break
        return tuple(met[0])


def _search_block(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    asked = rows["ids"].isna().to_numpy()
    queries = np.unique(rows["code"].to_numpy(np.int64)[asked])
    codes = rows["code"].to_numpy(np.int64)[~asked]
    ids = [np.asarray(x) for x in rows["ids"].to_numpy()[~asked]]
    if not len(codes) or not len(queries):
        return pd.DataFrame({"query": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "distance": np.zeros(0, np.int32)})
    index, held = Index(codes.view(np.uint64)), np.array([len(x) for x in ids])
    out = []
    for at in range(0, len(queries), TOGETHER):
        q, c, d = index.search(queries[at : at + TOGETHER].view(np.uint64), held, k)
        n = held[c]
        found = np.stack([np.repeat(q, n), np.concatenate([ids[i] for i in c]), np.repeat(d, n)])
        found = found[:, np.lexsort([found[1], found[2], found[0]])]
        start = np.searchsorted(found[0], found[0])
        found = found[:, np.arange(found.shape[1]) - start < k]
        out.append(pd.DataFrame({"query": queries[at : at + TOGETHER][found[0]], "id": found[1], "distance": found[2].astype(np.int32)}))
    return pd.concat(out)


def nearest(table: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "id", code_column: str = "code") -> DataFrame:
    """Rows (query_id, rank, id, distance): the ``k`` rows of ``table`` nearest to each row of ``queries`` by Hamming distance.

    Ties go to the smaller id. Both tables have an integer id and a 64-bit code; rows without either are left out, a
    repeated row of ``queries`` has its answers once for each time, a repeated row of ``table`` may come several times.
    Fewer than ``k`` rows are all returned, an empty table gives none; a row that is in both tables finds itself.

    Equal codes are one: of an often repeated code only its ``k`` smallest ids can be an answer, and a
    repeated query is searched once. Blocks of codes meet blocks of queries, each pair in one task, which
    holds a bounded number of both; the answers of the blocks are merged by rank.
    """
    def clean(df):
        return df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{code_column}`").alias("code")).dropna()

    few = Window.partitionBy("code").orderBy("id")
    codes = clean(table).withColumn("n", F.row_number().over(few)).where(F.col("n") <= k)
    codes = codes.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asked = clean(queries)
    distinct = asked.select("code").distinct()
    spread = tasks(table.sparkSession)
    n_codes, n_asked = (-(-clean(t).count() // size) or 1 for t, size in ((table, INDEX_BLOCK), (queries, QUERY_BLOCK)))
    n_asked = max(n_asked, min(spread, 16) // n_codes, 1)
    block = lambda n: F.pmod(F.xxhash64("code"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = codes.select("code", "ids", block(n_codes).alias("i"), every(n_asked).alias("j"))
    right = distinct.select("code", F.lit(None).cast("array<long>").alias("ids"), block(n_asked).alias("j"), every(n_codes).alias("i"))
    found = left.unionByName(right).groupBy("i", "j").applyInPandas(lambda rows: _search_block(rows, k), "query long, id long, distance int")
    order = Window.partitionBy("query").orderBy("distance", "id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(best, "query").select("query_id", "rank", "id", "distance")
