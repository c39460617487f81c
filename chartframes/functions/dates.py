"""Dates, calendar parts and local time. Works on ``timestamp_ntz``; the session zone never matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartframes.columns import Name, col
from chartframes.functions.text import zero_pad


def parse_date(text: Name, pattern: str) -> Column:
    """Strict parse with a Java pattern; missing month and day are 1."""
    text = col(text)
    date = F.try_to_date(text, pattern)
    return F.when(text.isNull() | date.isNotNull(), date).otherwise(
        F.raise_error(F.concat(F.lit(f"not a date like {pattern}: "), text))
    )


def parse_datetime(text: Name, pattern: str) -> Column:
    """Strict parse into a time without zone."""
    return F.to_timestamp_ntz(col(text), F.lit(pattern))


def date_of(ts: Name) -> Column:
    return col(ts).cast("date")


def iso_week(ts: Name) -> Column:
    return F.weekofyear(col(ts))


def weekday_number(ts: Name) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(col(ts)) - 1


def year_month(ts: Name, separator: str = "_") -> Column:
    """``2024_03``."""
    return F.concat(F.year(col(ts)).cast("string"), F.lit(separator), zero_pad(F.month(col(ts)), 2))


def calendar_parts(ts: Name) -> dict[str, Column]:
    """Year, month, day, hour, weekday and week of a time, by name."""
    ts = col(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "month_name": F.date_format(ts.cast("date"), "MMM"),
        "day": F.dayofmonth(ts),
        "day_name": F.date_format(ts.cast("date"), "E"),
        "day_num": weekday_number(ts),
        "hour": F.hour(ts),
        "week": iso_week(ts),
    }


def localize(ts: Name, zone: str, ambiguous: str = "latest", nonexistent: str = "raise") -> Column:
    """UTC time of a local time in ``zone``, both without zone.

    A repeated hour takes the ``latest`` or ``earliest`` of its two instants. A skipped hour fails
    the job or gives null. The candidates use the offset in force at the time itself and some hours
    later; only near a change of offset do they differ and are checked by converting back.
    """
    ts = col(ts)
    later = ts + F.expr("INTERVAL 6 HOURS")
    here = F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)
    after = ts - (later - F.convert_timezone(F.lit(zone), F.lit("UTC"), later))
    fits_here = F.convert_timezone(F.lit("UTC"), F.lit(zone), here) == ts
    fits_after = F.convert_timezone(F.lit("UTC"), F.lit(zone), after) == ts
    found = F.when(here == after, here)
    if ambiguous == "latest":
        found = found.when(fits_after, after).when(fits_here, here)
    elif ambiguous == "earliest":
        found = found.when(fits_here, here).when(fits_after, after)
    else:
        raise ValueError(f"unknown choice {ambiguous!r}")
    if nonexistent == "null":
        return found
    message = F.concat(F.lit(f"no such local time in {zone}: "), ts.cast("string"))
    return found.when(ts.isNotNull(), F.raise_error(message).cast("timestamp_ntz"))
