"""Bronze to silver: clean, type, de-duplicate, expand.

Wide raw columns (review text, friend lists) are projected away before any
shuffle. Malformed values become NULL; only rows without a key, with stars out
of range or with an unreadable check-in time are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.functions import (
    is_filled,
    parse_date,
    parse_timestamp,
    split_trimmed,
    token_count,
    trimmed,
)
from townsquare.operators import explode_tokens, keep_latest

# The star range and the word for "no friends".
MIN_STARS, MAX_STARS = 1, 5
NO_FRIENDS = "None"

# Review columns taken over as they are.
REVIEW_COLUMNS = ("review_id", "business_id", "user_id", "stars", "useful", "funny", "cool")
RATED_COLUMNS = REVIEW_COLUMNS[: REVIEW_COLUMNS.index("stars") + 1]

_LOAD_TIME = "_ingested_at"


def _load_time(df: DataFrame) -> list[str]:
    return [_LOAD_TIME] if _LOAD_TIME in df.columns else []


def silver_business(bronze: DataFrame) -> DataFrame:
    """One row per business, padding stripped, categories as an array."""
    cleaned = bronze.where(F.col("business_id").isNotNull()).withColumns(
        trimmed("name", "city", "state")
    )
    businesses = keep_latest(cleaned, ["business_id"], latest=_load_time(cleaned))
    return businesses.withColumn("category_array", split_trimmed("categories"))


def silver_business_category(business: DataFrame, unique_businesses: bool = False) -> DataFrame:
    """One row per business and non-blank category.

    Where the caller knows that there is one row per business, as
    :func:`silver_business` gives, ``unique_businesses`` saves the shuffle:
    repeats can then only sit inside one array and are removed in place.
    """
    pairs = business.select(
        "business_id", F.explode(F.array_distinct("category_array")).alias("category")
    ).where(is_filled("category"))
    return pairs if unique_businesses else pairs.distinct()


def valid_reviews(bronze: DataFrame, columns: Sequence[str] = REVIEW_COLUMNS) -> DataFrame:
    """Reviews with keys and stars in range, their time parsed; repeats are kept."""
    valid = bronze.where(
        F.col("review_id").isNotNull()
        & F.col("business_id").isNotNull()
        & F.col("stars").between(MIN_STARS, MAX_STARS)
    )
    return valid.select(*columns, parse_timestamp("date").alias("review_ts"))


def latest_reviews(typed: DataFrame) -> DataFrame:
    """One row per review; columns derived from the timestamp are added after
    the shuffle."""
    return keep_latest(typed, ["review_id"], latest=["review_ts"]).withColumns(
        {"review_date": F.to_date("review_ts"), "review_year": F.year("review_ts")}
    )


def silver_review(bronze: DataFrame) -> DataFrame:
    """One row per review with stars in range; a bad date stays as NULL.

    The range check comes before the de-duplication, so an out-of-range copy
    never displaces a valid one.
    """
    return latest_reviews(valid_reviews(bronze))


def rated_review(bronze: DataFrame) -> DataFrame:
    """:func:`silver_review` without the votes, for reports on ratings.

    Ties are settled column by column and the votes come last, so the
    survivors' other columns are the same; the shuffle carries fewer bytes.
    """
    return latest_reviews(valid_reviews(bronze, RATED_COLUMNS))


def silver_user(bronze: DataFrame) -> DataFrame:
    """One row per user; elite years as an array, friends as a count."""
    typed = (
        bronze.where(F.col("user_id").isNotNull())
        .withColumns(
            {
                "yelping_since_date": parse_date("yelping_since"),
                "friend_count": token_count("friends", placeholder=NO_FRIENDS),
            }
        )
        .drop("friends", "yelping_since")
    )
    users = keep_latest(typed, ["user_id"], latest=_load_time(typed))
    elite_years = split_trimmed(F.when(is_filled("elite"), F.col("elite")))
    return users.withColumns(
        {"elite_years": elite_years, "is_elite": F.size(elite_years) > 0}
    ).drop("elite")


def silver_checkin(bronze: DataFrame) -> DataFrame:
    """One row per readable check-in time; repeats are kept."""
    tokens = explode_tokens(
        bronze.where(F.col("business_id").isNotNull()), "date", into="token", keep=["business_id"]
    )
    times = tokens.select("business_id", parse_timestamp("token").alias("checkin_ts"))
    return times.where(F.col("checkin_ts").isNotNull()).withColumn(
        "checkin_date", F.to_date("checkin_ts")
    )


def silver_tip(bronze: DataFrame) -> DataFrame:
    """Tips of known businesses with a typed time; repeats are kept."""
    when = parse_timestamp("date")
    return bronze.where(F.col("business_id").isNotNull()).select(
        "user_id",
        "business_id",
        "text",
        "compliment_count",
        when.alias("tip_ts"),
        F.to_date(when).alias("tip_date"),
    )
