"""Licence texts by canonical digest: whole texts, and lines of their own such as notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartframes.llm.common import join_small, pin, take
from chartframes.llm.licence_texts import LICENCES

#: Spellings that count as one, each written as the second.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("organisation", "organization"),
    ("non-infringement", "noninfringement"), ("non infringement", "noninfringement"), ("wilful", "willful"), ("favour", "favor"),
    ("copyright owner", "copyright holder"), ("acknowledgement", "acknowledgment"), ("initialise", "initialize"), ("per cent", "percent"),
]
#: A line that only says whose the rights are; leading signs may be marks of a comment.
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n]*(copyright[ \t]*(\(c\)|©|[0-9]|:|<|\[|by )|\(c\)[ \t]*[0-9]|©|all rights reserved)[^\n]*"
#: ASCII signs and blanks, Latin-1 signs, and typographic signs; not the line feed.
SIGNS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F\x{A0}-\x{BF}\x{2010}-\x{206F}]+"


def _canonical(text: Column) -> Column:
    """The lines of a text in canonical form: lower case, one spelling, no copyright lines, signs as single blanks."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, COPYRIGHT_LINE, "\n")
    out = F.regexp_replace(out, SIGNS, " ")
    return F.transform(F.split(out, "\n"), lambda x: F.trim(x))


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, none empty."""
    return F.filter(_canonical(text), lambda x: x != "")


def paragraphs(lines: Column) -> Column:
    """Runs of two or more lines in canonical form without an empty one between, each as one line."""
    runs = F.filter(F.split(F.array_join(lines, "\n"), "\n\n+"), lambda x: F.trim(F.replace(x, F.lit("\n"), F.lit(" "))) != "")
    runs = F.transform(runs, lambda x: F.regexp_replace(x, "^\n+|\n+$", ""))
    return F.transform(F.filter(runs, lambda x: F.contains(x, F.lit("\n"))), lambda x: F.replace(x, F.lit("\n"), F.lit(" ")))


def digest(lines: Column) -> Column:
    """The SHA-256 of canonical lines as one text, so that line breaks do not matter."""
    return F.sha2(F.array_join(lines, " "), 256)


def known_licences(spark: SparkSession) -> DataFrame:
    """(license_id, text) of the licences and notices that the library knows."""
    rows = [F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, text in LICENCES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan(
    docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    license_column: str = "license_id", license_text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text_sha256, license, notices, n_notices.

    ``license`` is the known text that the whole document equals in canonical form, else null; ``text_sha256`` is
    the digest it is looked up by. ``notices`` are the known texts that lines of the document equal, or paragraphs of
    several lines, sorted and joined by commas, '' if none; ``n_notices`` counts such lines and paragraphs. Of known texts with one canonical form the
    first by name counts; empty ones are left out. Null and empty texts, and those of copyright lines only, equal
    nothing. Repeated documents come out once each with the same result, null doc_ids like any other.
    An empty table gives no rows, no known text gives no matches, other columns are not read.
    """
    plain = take(docs, doc_id=id_column, text=text_column)
    texts = take(known, license=license_column, text=license_text_column)
    digests = pin(
        texts.select("license", canonical_lines(F.col("text")).alias("lines")).where(F.size("lines") > 0)
        .groupBy(digest(F.col("lines")).alias("sha")).agg(F.min("license").alias("license")).where("license IS NOT NULL")
    )
    lines = plain.select("doc_id", F.monotonically_increasing_id().alias("row"), _canonical(F.col("text")).alias("all"))
    lines = lines.select("doc_id", "row", F.filter("all", lambda x: x != "").alias("lines"), paragraphs(F.col("all")).alias("runs"))
    units = F.concat(
        F.array(F.struct(digest(F.col("lines")).alias("sha"), F.lit(True).alias("whole"))),
        F.transform(F.concat("lines", "runs"), lambda x: F.struct(F.sha2(x, 256).alias("sha"), F.lit(False).alias("whole"))),
    )
    each = lines.select("row", "doc_id", F.explode(units).alias("u")).select("row", "doc_id", "u.*")
    # a row for each document and one for each line that is known go on; they meet again by the row's number
    found = join_small(each, digests, ["sha"], 128).where("whole OR license IS NOT NULL")
    whole, line = F.when(F.col("whole"), F.col("license")), F.when(~F.col("whole"), F.col("license"))
    return found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max(F.when(F.col("whole"), F.col("sha"))).alias("text_sha256"),
        F.max(whole).alias("license"), F.array_join(F.array_sort(F.collect_set(line)), ",").alias("notices"), F.count(line).alias("n_notices"),
    ).drop("row")
