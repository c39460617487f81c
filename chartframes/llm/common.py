"""Helpers shared by the operators: column checks, pinned tables, small-side joins, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartframes.session import scratch_path

#: A side of a join is broadcast only while its counted rows take no more than this.
BROADCAST_BYTES = 32 << 20


def text_batches(spark: SparkSession) -> None:
    """Let Arrow batches of texts take 4 MiB instead of Spark's default, if the session has no size of its own.

    A Python worker holds a batch several times over: as Arrow data, as strings and as what is made of them.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("64MB", "67108864b", "67108864"):
        spark.conf.set(key, "4194304b")


def give_back() -> None:
    """Return memory that is no longer used to the system: workers are kept for later stages, and their heaps with them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def frugal(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A function over a task's batches that gives memory back when the task ends."""

    @wraps(run)
    def to_the_end(*args):
        try:
            yield from run(*args)
        finally:
            give_back()

    return to_the_end


def take(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that no other column can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def pin(df: DataFrame, compression: str = "snappy", shuffles: bool = True) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, computed once and read back.

    The folder goes when the session ends. Parquet is several times smaller than a checkpoint of rows. Without ``shuffles`` the
    shuffle files of the write go with its end, instead of staying until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    if not shuffles:
        spark.conf.set(key, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        if not shuffles:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh path below the shared checkpoint folder, deleted when the session ends."""
    path = scratch_path(spark, "table")
    parent = spark._jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
    parent.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(parent)
    return path


def join_small(df: DataFrame, small: DataFrame, on: Sequence[str], row_bytes: int, how: str = "left") -> DataFrame:
    """Join a pinned table, by broadcast if its counted rows fit ``BROADCAST_BYTES``, else by shuffle.

    ``row_bytes`` is what a row takes; for tables with arrays or binaries pass what ``payload_bytes`` gives.
    Both ways give the same rows; both sides are plain tables, so AQE can split a hot key of the shuffle.
    """
    if small.count() * row_bytes <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return df.join(small, list(on), how)


def payload_bytes(df: DataFrame, column: str) -> int:
    """Mean bytes of a row with one binary column and a few fixed ones, rounded up, for ``join_small``."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("b")).first()
    return 64 + -(-(row.b or 0) // max(row.n, 1))


def tasks(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the documents that no classifier learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, root) per node, root one of the component's nodes.

    Each round maps every node to the one with the smallest hash among itself and its neighbours, and contracts the
    edges to the images; the rounds' maps are then composed. As the hash differs by round, a constant
    share of the nodes goes in each, also on long chains. Minima are combined before the shuffle, so a hub
    with many edges costs no task more than others; joins read pinned tables, so AQE splits hubs there.
    """
    edges = pin(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda name: F.struct(F.xxhash64(name, F.lit(len(maps))).alias("h"), F.col(name).alias("b"))  # noqa: E731, B023
        least = F.least(F.min(rank("b")), F.min(rank("a")))
        nearest = pin(both.groupBy(F.col("a").alias("node")).agg(least.alias("x")).select("node", F.col("x.b").alias("up")))
        maps.append(nearest)
        left = nearest.select(F.col("node").alias("a"), F.col("up").alias("a_up"))
        right = nearest.select(F.col("node").alias("b"), F.col("up").alias("b_up"))
        edges = pin(
            edges.join(left, "a").join(right, "b").where("a_up <> b_up")
            .select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct()
        )
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = maps[-1].select("node", F.col("up").alias("root"))
    for earlier in reversed(maps[:-1]):
        later = found.select(F.col("node").alias("up"), "root")
        found = pin(earlier.join(later, "up", "left").select("node", F.coalesce("root", "up").alias("root")))
    return found


def labelled_sample(texts: DataFrame, labelled: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents, equal shares of the labels, chosen by hash of the id.

    ``texts`` is (doc_id, text), ``labelled`` (doc_id, label); rows without id or label are left out. An id is chosen once,
    with the smallest of its labels, and comes with one text, the one of the smallest hash, however often it occurs. Ids are
    cut by their hash before they are ordered, so a task orders few of any label; the chosen ones are broadcast
    (their number is bounded), so no other text is shuffled. Long texts come whole; no labels give no rows.
    """
    known = labelled.where("label IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "label", F.xxhash64("doc_id").alias("__hash"))
    labels = pin(known.groupBy("label").agg(F.count(F.lit(1)).alias("__rows")))
    share = max(rows // max(labels.count(), 1), 1)
    # twice as many as are wanted, and some: what is beyond the bound would hardly ever be among the first
    bound = F.lit(-float(1 << 63)) + F.lit(float(1 << 64)) * (2 * share + 100) / F.col("__rows")
    few = known.join(labels, "label").where(F.col("__hash").cast("double") <= bound)
    one = few.groupBy("doc_id", "__hash").agg(F.min("label").alias("label"))
    first = Window.partitionBy("label").orderBy("__hash", "doc_id")
    chosen = one.withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= share).select("doc_id", "label").limit(rows)
    met = texts.join(F.broadcast(chosen), "doc_id")
    text = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text")))
    return met.groupBy("doc_id", "label").agg(text.alias("x")).select("doc_id", "x.text", "label")


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows named by ``gone`` (doc_id, text_hash), where text_hash is ``xxhash64(text)``.

    Ids of any plain type are compared as text. A null doc_id matches a null one, so rows without an id are told apart by their
    texts. Repeated rows go or stay together; columns of any other name come along.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    gone = pin(gone.select(named.alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    keyed = docs.withColumns({"__id": named, "__hash": F.xxhash64("text")})
    return join_small(keyed, gone, ["__id", "__hash"], 64, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
