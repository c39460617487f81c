"""Mixing of sources to target weights: repetition rates per source, and hash-seeded copies of each document.

Everything is built-in expressions and aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartframes.llm.common import take
from chartframes.operators.ordered import row_number, running_sum
from chartframes.operators.skew import TASK_ROWS, attach
from chartframes.session import pin

#: No source is repeated more often than this on the whole, and so no document.
MOST_REPEATS = 3
#: Weights of the sources in the order of their names, over and over.
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]++"
#: Hexadecimal digits of a digest that a coin is made of, so that it is exact as a double.
COIN_DIGITS = 13


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(seed: int, *values: Column) -> Column:
    """A number from 0 up to 1 that depends on the seed and the values only; null differs from the empty text."""
    parts = [F.concat(F.lit("/"), F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit(""))) for v in values]
    digits = F.substring(F.md5(F.concat(F.lit(str(seed)), *parts).cast("binary")), 1, COIN_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**COIN_DIGITS))


def turning_weights(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int | None = TASK_ROWS) -> DataFrame:
    """``sizes`` with a column weight: ``weights`` in turn over the sources by code point, null last."""
    numbered = row_number(sizes, None, F.col("source").asc_nulls_last(), "__n", limit)
    turn = F.pmod(F.col("__n") - 1, F.lit(len(weights))) + 1
    return numbered.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int")).cast("long")).drop("__n")


def targets(sizes: DataFrame, most: int = MOST_REPEATS, limit: int | None = TASK_ROWS) -> DataFrame:
    """``sizes`` (source, source_size, weight and others) with a column target.

    The targets add up to all sizes and are in proportion to the whole-number weights, but none is above ``most`` times its
    source's size: what is too much for one is shared among the others by weight, over and over. It need not be done
    in rounds. With the sources in the order of size / weight, those that end at their bound come first, and source i
    is one if all targets together stay below the total when every source after it has the level at which i is
    full. So two running sums tell all of them apart, in exact whole numbers.
    """
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    rated = pin(sizes.withColumn("__full", F.col("source_size") * most))
    # ratios that are equal as doubles may stand in any order: the level is the same, but for the last bit
    order = [F.col("source_size").cast("double") / F.col("weight"), F.col("source").asc_nulls_first()]
    summed = running_sum(rated, None, order, "__full", "__fulls", limit)
    summed = pin(running_sum(summed, None, order, "weight", "__weights", limit))
    total, weights = summed.agg(F.sum("source_size").alias("x")).scalar(), summed.agg(F.sum("weight").alias("x")).scalar()
    level = whole("__fulls") * whole("weight") + whole("__full") * (weights - F.col("__weights")).cast("decimal(38,0)")
    marked = pin(summed.withColumn("__bound", level <= total.cast("decimal(38,0)") * whole("weight")))
    taken = marked.agg(F.coalesce(F.sum(F.when(F.col("__bound"), F.col("__full"))), F.lit(0)).alias("x")).scalar()
    open_ = marked.agg(F.sum(F.when(~F.col("__bound"), F.col("weight"))).alias("x")).scalar()
    share = (total - taken).cast("double") / open_.cast("double") * F.col("weight")
    target = F.when(F.col("__bound"), F.col("__full").cast("double")).otherwise(share)
    return marked.withColumn("target", target).select(*sizes.columns, "target")


def measured(docs: DataFrame, seed: int = 1, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One narrow row (doc_id, source, size, coin) per document; the coin depends on seed, doc_id and text."""
    plain = take(docs, doc_id=id_column, text=text_column, source=source_column)
    return plain.select("doc_id", "source", words(F.col("text")).alias("size"), coin(seed, F.col("doc_id"), F.col("text")).alias("coin"))


def with_copies(rows: DataFrame, most: int = MOST_REPEATS, weights: tuple[int, ...] = WEIGHTS, limit: int | None = TASK_ROWS) -> DataFrame:
    """``rows`` (source, size, coin and others) with source_size, target, rate and copies.

    A source's rate is its target over its size. A document is taken floor(rate) times, and once more if its coin is
    below the fraction that is left. Sizes are combined before the shuffle, and the rates are brought to the rows
    by broadcast while they are small, else by a join that splits hot sources; rows of a source are never together.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__rows"))
    wanted = targets(turning_weights(pin(sizes), weights, limit), most, limit)
    rated = wanted.withColumn("rate", F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))).drop("weight")
    extra = F.when(F.col("coin") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return attach(rows, rated, "source", "__rows").drop("__rows").withColumn("copies", (F.floor("rate") + extra).cast("int"))


def mix(
    docs: DataFrame, seed: int = 1, most: int = MOST_REPEATS, weights: tuple[int, ...] = WEIGHTS, id_column: str = "doc_id",
    text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with a column ``copy`` from 1.

    Sources, null being one, have whole-number ``weights`` in turn by name and share the words of all documents; none is
    repeated more than ``most`` times. Reruns give the same rows, whatever the files and partitions. Null and
    empty texts have no words and are taken at the rate of their source; a source without words is not taken. Rows that are
    equal in doc_id and text share a coin. All columns come along, but one that is called copy already is replaced. An
    empty table gives no rows.
    """
    names = {c: F.col(f"`{c}`") for c in docs.columns}
    row = F.struct(*[v.alias(c) for c, v in names.items() if c != "copy"]).alias("row")
    size, flip = words(names[text_column]), coin(seed, names[id_column], names[text_column])
    rows = docs.select(row, names[source_column].alias("source"), size.alias("size"), flip.alias("coin"))
    taken = with_copies(rows, most, weights).where("copies > 0")
    return taken.select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
