"""BI reports on the star schema.

Each report reduces the fact on its join key first and joins the dimension
afterwards, so a key with most of the rows reaches the join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count() -> Column:
    return F.count(F.lit(1))


def top_categories(bridge: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with most businesses; ties by name."""
    sizes = bridge.groupBy("category").agg(_count().alias("n_businesses"))
    return sizes.orderBy(F.col("n_businesses").desc(), "category").limit(n)


def reviews_by_year(fact_review: DataFrame) -> DataFrame:
    """Review count and mean stars per year; undated reviews form one group."""
    return (
        fact_review.groupBy("review_year")
        .agg(_count().alias("reviews"), F.round(F.avg("stars"), 3).alias("avg_stars"))
        .orderBy("review_year")
    )


def _by_calendar(daily: DataFrame, dim_date: DataFrame, *attributes: str) -> DataFrame:
    """Attach calendar attributes to per-day rows."""
    return daily.join(dim_date.select("date_key", *attributes), "date_key")


def _reviews_per(fact_review: DataFrame, key: str) -> DataFrame:
    """Partial sums per join key, from which counts and means can be merged."""
    return fact_review.groupBy(key).agg(
        _count().alias("n"), F.count("stars").alias("rated"), F.sum("stars").alias("total")
    )


def _merged_mean() -> Column:
    return F.round(F.try_divide(F.sum("total"), F.sum("rated")), 3)


def month_over_month(fact_review: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Reviews of every month of the calendar, 0 where there are none, next to
    those of the month before it.

    The join with the month before meets one row per month, whatever the size
    of the fact.
    """
    daily = _reviews_per(fact_review, "date_key").select("date_key", "n")
    monthly = (
        dim_date.select("date_key", "year", "month")
        .join(daily, "date_key", "left")
        .groupBy("year", "month")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("reviews"))
        .withColumn("number", F.col("year") * 12 + F.col("month"))
    )
    before = monthly.select((F.col("number") + 1).alias("number"), F.col("reviews").alias("previous_reviews"))
    return (
        monthly.join(before, "number", "left")
        .drop("number")
        .withColumn("change", F.col("reviews") - F.col("previous_reviews"))
    )


def weekend_split(fact_review: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Reviews and mean stars on weekdays and at weekends."""
    return (
        _by_calendar(_reviews_per(fact_review, "date_key"), dim_date, "is_weekend")
        .groupBy("is_weekend")
        .agg(F.sum("n").alias("reviews"), _merged_mean().alias("avg_stars"))
    )


def reviews_by_category(fact_review: DataFrame, bridge: DataFrame) -> DataFrame:
    """Reviews and mean stars per category.

    A review counts once for every category of its business.
    """
    return (
        _reviews_per(fact_review, "business_id")
        .join(bridge, "business_id")
        .groupBy("category")
        .agg(F.sum("n").alias("reviews"), _merged_mean().alias("avg_stars"))
    )


def daily_checkins(fact_checkin: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Check-ins per calendar day with its weekday."""
    per_day = fact_checkin.groupBy("date_key").agg(F.sum("checkin_count").alias("checkins"))
    return _by_calendar(per_day, dim_date, "date", "day_of_week").select(
        "date", "day_of_week", "checkins"
    )
