"""Silver to gold: star schema of dimensions, bridge and facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.functions import calendar_columns, date_key

# Fixed value: length of the hexadecimal surrogate key.
CATEGORY_KEY_LENGTH = 12

# Output columns, in order.
DIM_BUSINESS = (
    "business_id", "name", "address", "city", "state", "postal_code", "latitude", "longitude",
    "stars AS avg_stars_alltime", "review_count AS review_count_alltime", "is_open", "category_array",
)
DIM_USER = (
    "user_id", "name", "yelping_since_date", "review_count AS review_count_alltime",
    "average_stars AS avg_stars_given", "fans", "friend_count", "is_elite", "elite_years",
)
FACT_REVIEW = (
    "review_id", "business_id", "user_id", "date_key", "review_date", "review_year", "stars", "useful", "funny", "cool",
)
FACT_CHECKIN = ("business_id", "date_key", "checkin_date", "checkin_count")
FACT_TIP = ("business_id", "user_id", "date_key", "tip_date", "compliment_count")


def date_span(df: DataFrame, date: str) -> DataFrame:
    """One row: first and last date, NULL dates ignored."""
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def dim_date(review: DataFrame, tip: DataFrame, checkin: DataFrame) -> DataFrame:
    """One row per day from the first to the last event of any kind.

    Each source is reduced to its own span before the union, so one row per
    source is shuffled. The bounds stay in the plan: an input without dates
    gives an empty calendar. Years are dealt out before their days are made,
    so no array has over 366 days and a long calendar is built by many tasks.
    """
    spans = [
        date_span(review, "review_date"),
        date_span(tip, "tip_date"),
        date_span(checkin, "checkin_date"),
    ]
    overall = reduce(DataFrame.union, spans).agg(
        F.min("min_date").alias("first_day"), F.max("max_date").alias("last_day")
    )
    years = overall.where(F.col("first_day").isNotNull()).select(
        "first_day", "last_day", F.explode(F.sequence(F.year("first_day"), F.year("last_day"))).alias("y")
    )
    start = F.greatest("first_day", F.make_date("y", F.lit(1), F.lit(1)))
    end = F.least("last_day", F.make_date("y", F.lit(12), F.lit(31)))
    days = F.sequence(start, end, F.expr("interval 1 day"))
    return years.repartition("y").select(F.explode(days).alias("date")).withColumns(calendar_columns("date"))


def _renamed(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Columns by name, ``source AS name`` where the name changes."""
    return df.selectExpr(*columns)


def dim_business(business: DataFrame) -> DataFrame:
    """Business attributes and location."""
    return _renamed(business, DIM_BUSINESS)


def dim_user(user: DataFrame) -> DataFrame:
    """Reviewer attributes."""
    return _renamed(user, DIM_USER)


def dim_category(business_category: DataFrame) -> DataFrame:
    """Distinct categories with a hashed key."""
    key = F.sha2("category", 256).substr(1, CATEGORY_KEY_LENGTH)
    return business_category.select("category").distinct().withColumn("category_key", key)


def bridge_business_category(business_category: DataFrame) -> DataFrame:
    """Business to category, many to many, by natural key."""
    return business_category.select("business_id", "category")


def fact_review(review: DataFrame) -> DataFrame:
    """One row per review. A projection: no shuffle."""
    return review.withColumn("date_key", date_key("review_date")).select(*FACT_REVIEW)


def fact_checkin(checkin: DataFrame) -> DataFrame:
    """Check-ins per business and day.

    Counts are combined in the map tasks first, so a busy business shuffles
    one row per day and task rather than its events.
    """
    per_day = checkin.groupBy("business_id", "checkin_date").agg(
        F.count(F.lit(1)).alias("checkin_count")
    )
    return per_day.withColumn("date_key", date_key("checkin_date")).select(*FACT_CHECKIN)


def fact_tip(tip: DataFrame) -> DataFrame:
    """One row per tip. A projection: no shuffle."""
    return tip.withColumn("date_key", date_key("tip_date")).select(*FACT_TIP)
