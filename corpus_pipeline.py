"""A corpus made ready for training: each stage's rows are written as Parquet and read again by the next.

Stages take and return the columns of ``documents``, the last one returns pieces with their places. Rows are
told apart by doc_id and text, so nulls and repeated ids are handled like any other; other columns come along.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartframes.llm import decontaminate, language, packing, simhash, suffix
from chartframes.llm.common import held_out, pin, text_batches


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, or with a letter if none is learned; null texts and those without a letter go."""
    return language.known_language(docs, ~held_out())


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies, by op7's fingerprints."""
    return simhash.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has; a character cut in two goes whole."""
    cut = suffix.remove_repeats(docs, carry=True)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(
        *[F.when(F.col("n_removed") > 0, changed[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns]
    )


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequence and place they are packed to; the encoder that takes less memory."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), together=False)


def _stage(function):
    """A stage with Arrow batches that suit texts."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        text_batches(spark)
        return function(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _stage(known_language)),
    ("near copies", _stage(first_of_near_copies)),
    ("repeated passages", _stage(without_repeats)),
    ("benchmark", _stage(without_benchmark)),
    ("packing", _stage(packed)),
]
#: Machines, fingerprints and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
