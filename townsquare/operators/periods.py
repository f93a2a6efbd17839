"""Splitting dated rows into a trailing window and the time before it."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECENT = "past_year"
EARLIER = "prior"

NullDates = Literal["exclude", "prior"]


def trailing_cutoff(df: DataFrame, date: str, days: int) -> Column:
    """First day of the window that ends on the latest date in ``df``.

    A scalar subquery: it stays in the plan, reads the one date column and is
    computed once, so nothing is joined to every row.
    """
    return df.agg(F.date_sub(F.max(date), days)).scalar()


def in_window(date: str, cutoff: Column, null_dates: NullDates = "exclude") -> Column:
    """Whether a row lies on or after ``cutoff``.

    A row without a date is earlier (False) under ``"prior"`` and in neither
    period (NULL) under ``"exclude"``.
    """
    if null_dates not in ("exclude", "prior"):
        raise ValueError(f"null_dates must be 'exclude' or 'prior', not {null_dates!r}")
    recent = F.col(date) >= cutoff
    return F.coalesce(recent, F.lit(False)) if null_dates == "prior" else recent


def tag_period(
    df: DataFrame, date: str, cutoff: Column, null_dates: NullDates = "prior", into: str = "period"
) -> DataFrame:
    """Label each row as recent or earlier; NULL where it is neither."""
    recent = F.col("_recent")
    label = F.when(recent, F.lit(RECENT)).when(~recent, F.lit(EARLIER))
    flagged = df.withColumn("_recent", in_window(date, cutoff, null_dates))
    return flagged.withColumn(into, label).drop("_recent")


def period_totals(df: DataFrame, key: str, measure: str, recent: str) -> DataFrame:
    """Per key: recent row count and the mean of ``measure`` in both periods.

    ``recent`` names a boolean column; rows where it is NULL are in neither
    period. One hash aggregate with a map-side partial step; a mean over no
    rows is NULL.
    """
    is_recent = F.col(recent)
    return df.groupBy(key).agg(
        F.count_if(is_recent).alias("recent_count"),
        F.avg(F.when(is_recent, F.col(measure))).alias("recent_mean"),
        F.avg(F.when(~is_recent, F.col(measure))).alias("earlier_mean"),
    )


def in_years(
    df: DataFrame, first_day: str, last_day: str, date: str = "review_date", year: str = "review_year"
) -> DataFrame:
    """Rows dated within ``[first_day, last_day]`` (``yyyy-MM-dd`` text).

    A date predicate alone does not prune year partitions, so the implied
    year range is stated next to it.
    """
    first, last = (F.lit(day).cast("date") for day in (first_day, last_day))
    years = F.col(year).between(int(first_day[:4]), int(last_day[:4]))
    return df.where(years & F.col(date).between(first, last))
