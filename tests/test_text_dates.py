"""Text and time expressions."""
import re

from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartframes.functions import (
    bold_label,
    calendar_parts,
    localize,
    pad_end,
    parse_date,
    parse_datetime,
    replace_all,
    replace_first,
    replace_literal,
    slice_text,
    split_get,
    title_case,
    wrap_text,
    year_month,
    zero_pad,
)


def text(spark, values, *expressions):
    return [tuple(r) for r in spark.createDataFrame([(v,) for v in values], "t string").select(*expressions).collect()]


def test_replace_first_only(spark):
    found = text(spark, ["1,234,567", "NA", None, ""], replace_first("t", ",", ""), replace_first("t", "NA", "0"))
    assert found == [("1234,567", "1,234,567"), ("NA", "0"), (None, None), ("", "")]


def test_replace_takes_the_value_as_it_is(spark):
    assert text(spark, ["a.b.c"], replace_literal("t", ".", "$1\\"), replace_all("t", ".", "$")) == [("a$1\\b.c", "a$b$c")]
    assert text(spark, ["xay\nxby"], replace_first("t", "a|b", "-")) == [("x-y\nxby",)]


@pytest.mark.parametrize("offset,length", [(0, 4), (3, None), (-2, 2), (-2, None), (-9, 3), (-9, 8), (2, 0), (9, 1)])
def test_slices_like_a_list(spark, offset, length):
    for value in ("abcdef", "a", ""):
        start = offset if offset >= 0 else len(value) + offset
        stop = len(value) if length is None else start + length
        expected = value[max(start, 0) : max(stop, 0)]
        assert text(spark, [value], slice_text("t", offset, length)) == [(expected,)]


def test_split_get(spark):
    assert text(spark, ["San Jose, California", "x"], split_get("t", ","), split_get("t", ",", 1)) == [
        ("San Jose", " California"),
        ("x", None),
    ]


def test_title_case(spark):
    found = text(spark, ["o'neil-SMITH mccain 3rd", "BUSH_jr", "élan vital", "", None], title_case("t"))
    assert found == [("O'Neil-Smith Mccain 3rd",), ("Bush_Jr",), ("Élan Vital",), ("",), (None,)]


def test_padding_keeps_longer_text(spark):
    found = text(spark, ["7", "-7", "123", None], zero_pad("t", 3), pad_end("t", 2, "0"))
    assert found == [("007", "70"), ("-07", "-7"), ("123", "123"), (None, None)]


def test_label_with_null_is_null(spark):
    assert text(spark, ["a", None], bold_label("t", F.lit("b"))) == [("<b>a</b><br>b",), (None,)]


def follows_the_rule(value, out, width):
    """Blanks become marks, no piece but the last is short, and none could have ended earlier."""
    pieces = out.split("<br>")
    pattern = r"\s".join(re.escape(p) for p in pieces)
    early = [p for p in pieces if re.search(r"\s", p[width:])]
    return re.fullmatch(pattern, value) is not None and all(len(p) >= width for p in pieces[:-1]) and not early


ALPHABET = "ab é\n\t  \U0001f600"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=20), st.integers(1, 9))
def test_wrap_follows_the_rule(spark, values, width):
    found = text(spark, values, wrap_text("t", width))
    assert all(follows_the_rule(v, w, width) for v, (w,) in zip(values, found, strict=True))


def test_wrap_by_hand(spark):
    found = text(spark, ["one two three", "one  two", "longer", " a b", "ab\ncd ef", ""], wrap_text("t", 3))
    assert found == [("one<br>two<br>three",), ("one<br> two",), ("longer",), (" a b",), ("ab\ncd<br>ef",), ("",)]


def test_wrap_of_whole_documents(tables):
    for r in tables.documents.select("text", wrap_text("text", 28).alias("w")).collect():
        assert follows_the_rule(r.text, r.w, 28)


def test_parse_dates(spark):
    found = text(spark, ["03/04/2024", None], parse_date("t", "MM/dd/yyyy"))
    assert found == [(date(2024, 3, 4),), (None,)]
    assert text(spark, ["2024-03"], parse_date("t", "yyyy-MM")) == [(date(2024, 3, 1),)]
    assert text(spark, ["1901"], parse_date("t", "yyyy")) == [(date(1901, 1, 1),)]
    assert text(spark, ["03/04/2024 17:05"], parse_datetime("t", "MM/dd/yyyy HH:mm")) == [(datetime(2024, 3, 4, 17, 5),)]
    with pytest.raises(PySparkException):
        text(spark, ["2024-13"], parse_date("t", "yyyy-MM"))


def local(spark, values, *args):
    data = [(datetime.fromisoformat(v) if v else None,) for v in values]
    df = spark.createDataFrame(data, "t timestamp_ntz")
    return [r[0] and r[0].isoformat(" ", "minutes") for r in df.select(localize("t", *args)).collect()]


AUTUMN = ["2024-11-03 00:59", "2024-11-03 01:00", "2024-11-03 01:59", "2024-11-03 02:00", None]


def test_repeated_hour(spark):
    assert local(spark, AUTUMN, "US/Eastern") == [
        "2024-11-03 04:59", "2024-11-03 06:00", "2024-11-03 06:59", "2024-11-03 07:00", None
    ]
    assert local(spark, AUTUMN, "US/Eastern", "earliest") == [
        "2024-11-03 04:59", "2024-11-03 05:00", "2024-11-03 05:59", "2024-11-03 07:00", None
    ]


def test_skipped_hour(spark):
    spring = ["2024-03-10 01:59", "2024-03-10 02:00", "2024-03-10 02:59", "2024-03-10 03:00"]
    expected = ["2024-03-10 06:59", None, None, "2024-03-10 07:00"]
    assert local(spark, spring, "US/Eastern", "latest", "null") == expected
    with pytest.raises(PySparkException):
        local(spark, spring, "US/Eastern")


def test_half_hour_change(spark):
    # Lord Howe Island puts its clock back by half an hour at 02:00
    values = ["2024-04-07 01:29", "2024-04-07 01:45", "2024-04-07 02:00"]
    found = local(spark, values, "Australia/Lord_Howe")
    assert found == ["2024-04-06 14:29", "2024-04-06 15:15", "2024-04-06 15:30"]


def test_the_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert local(spark, ["2024-11-03 01:30"], "US/Eastern") == ["2024-11-03 06:30"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_parts(spark):
    df = spark.createDataFrame([(datetime(2024, 12, 30, 17, 5),)], "t timestamp_ntz")
    row = df.select(*[c.alias(n) for n, c in calendar_parts("t").items()], year_month("t").alias("ym")).first()
    assert row.asDict() == {
        "year": 2024, "month": 12, "month_name": "Dec", "day": 30, "day_name": "Mon", "day_num": 1,
        "hour": 17, "week": 1, "ym": "2024_12",
    }
