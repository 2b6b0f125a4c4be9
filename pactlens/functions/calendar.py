"""Calendar parts with the numbering of the features table (all bigint; Sunday is 0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: Column, end: Column) -> Column:
    return F.date_diff(end, start).cast("bigint")


def month_of(day: Column) -> Column:
    return F.month(day).cast("bigint")


def year_of(day: Column) -> Column:
    return F.year(day).cast("bigint")


def weekday_of(day: Column) -> Column:
    return (F.dayofweek(day) - 1).cast("bigint")


def iso_timestamp(ts: Column) -> Column:
    """ISO text without a zone, the form of timestamps in the source."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def text_bound(ts: Column) -> Column:
    """Bound for ISO text in text order: without the time at midnight, so that plain dates compare as well."""
    return F.regexp_replace(iso_timestamp(ts), "T00:00:00$", "")
