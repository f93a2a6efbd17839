"""Timestamps, dates and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: str | Column) -> Column:
    """Text to TIMESTAMP; NULL, not an error, where the text is malformed."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def parse_date(text: str | Column) -> Column:
    """Leading ``yyyy-MM-dd`` of a text as DATE; NULL where malformed."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("date")


def date_key(date: str) -> Column:
    """``yyyyMMdd`` as INT; NULL where that is no INT.

    Years of four digits are computed without going through text. A year
    before 0 gives the negative number its text reads as, one beyond the
    range of INT gives NULL.
    """
    plain = F.year(date) * 10000 + F.month(date) * 100 + F.day(date)
    odd = F.date_format(date, "yyyyMMdd").try_cast("int")
    return F.when(F.year(date).between(0, 9999), plain).otherwise(odd)


def calendar_columns(date: str) -> dict[str, Column]:
    """``withColumns`` argument with the calendar attributes of a date."""
    sunday, saturday = 1, 7
    return {
        "date_key": date_key(date),
        "year": F.year(date),
        "quarter": F.quarter(date),
        "month": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "day": F.day(date),
        "day_of_week": F.date_format(date, "EEEE"),
        "week_of_year": F.weekofyear(date),
        "is_weekend": F.dayofweek(date).isin(sunday, saturday),
    }
