"""Rising stars: businesses rated clearly better in the trailing window.

A business qualifies with enough recent reviews and a recent mean at least
``min_gain`` stars above its mean before the window. Without earlier reviews
there is nothing to rise from, and the comparison with a NULL mean drops it.
The window ends on the latest review date, not today.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townsquare.operators.periods import NullDates, in_window, period_totals, trailing_cutoff

# Default thresholds and the row limit of the short report.
WINDOW_DAYS = 365
MIN_REVIEWS = 10
MIN_GAIN = 1.0
SHORT_LIMIT = 50

# Column names of the short report.
SHORT_NAMES = {
    "reviews_past_year": "reviews_py",
    "avg_rating_past_year": "avg_past_year",
    "avg_rating_prior": "avg_prior",
    "rating_improvement": "improvement",
}


def _report(
    totals: DataFrame, business: DataFrame, min_reviews: int, min_gain: float, limit: int | None
) -> DataFrame:
    """Threshold, name, round and rank per-business totals.

    Thresholds compare unrounded means. They run before the join, which then
    meets one row per qualifying business; whether that side is small enough
    to broadcast is for AQE to decide from its measured size.
    """
    risers = totals.where(
        (F.col("recent_count") >= min_reviews)
        & (F.col("recent_mean") >= F.col("earlier_mean") + F.lit(min_gain))
    )

    def two_places(value: Column, name: str) -> Column:
        return F.round(value, 2).alias(name)

    report = risers.join(business.select("business_id", "name"), "business_id").select(
        "business_id",
        "name",
        F.col("recent_count").alias("reviews_past_year"),
        two_places(F.col("recent_mean"), "avg_rating_past_year"),
        two_places(F.col("earlier_mean"), "avg_rating_prior"),
        two_places(F.col("recent_mean") - F.col("earlier_mean"), "rating_improvement"),
    )
    ranked = report.orderBy(
        F.col("rating_improvement").desc(), F.col("reviews_past_year").desc(), "business_id"
    )
    return ranked if limit is None else ranked.limit(limit)


def rising_star(
    reviews: DataFrame,
    business: DataFrame,
    window_days: int = WINDOW_DAYS,
    min_reviews: int = MIN_REVIEWS,
    min_gain: float = MIN_GAIN,
    null_dates: NullDates = "exclude",
    limit: int | None = None,
) -> DataFrame:
    """Businesses on the rise, biggest gain first.

    Works on silver or gold tables. ``null_dates`` says whether a review
    without a date counts as earlier (``"prior"``) or not at all
    (``"exclude"``).
    """
    cutoff = trailing_cutoff(reviews, "review_date", window_days)
    rated = reviews.select(
        "business_id", "stars", in_window("review_date", cutoff, null_dates).alias("is_recent")
    )
    totals = period_totals(rated, "business_id", "stars", recent="is_recent")
    return _report(totals, business, min_reviews, min_gain, limit)


def rising_star_short(
    reviews: DataFrame, business: DataFrame, limit: int = SHORT_LIMIT, **rule: object
) -> DataFrame:
    """The top rows only, under short column names."""
    return rising_star(reviews, business, limit=limit, **rule).withColumnsRenamed(SHORT_NAMES)


def daily_ratings(reviews: DataFrame) -> DataFrame:
    """Reviews, ratings and star total per business and day: a compact rollup."""
    return reviews.groupBy("business_id", "review_date").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count("stars").alias("rating_count"),
        F.sum("stars").alias("rating_total"),
    )


def rising_star_daily(
    daily: DataFrame,
    business: DataFrame,
    window_days: int = WINDOW_DAYS,
    min_reviews: int = MIN_REVIEWS,
    min_gain: float = MIN_GAIN,
    limit: int | None = None,
) -> DataFrame:
    """Rising stars from a stored :func:`daily_ratings` table.

    Both the latest date and the means come from the rollup, so the review
    fact is not scanned. Reviews without a date do not count.
    """
    is_recent = F.col("review_date") >= trailing_cutoff(daily, "review_date", window_days)

    def total(column: str, wanted: Column) -> Column:
        return F.sum(F.when(wanted, F.col(column)))

    def mean(wanted: Column) -> Column:
        return F.try_divide(total("rating_total", wanted), total("rating_count", wanted))

    totals = daily.groupBy("business_id").agg(
        F.coalesce(total("review_count", is_recent), F.lit(0)).alias("recent_count"),
        mean(is_recent).alias("recent_mean"),
        mean(~is_recent).alias("earlier_mean"),
    )
    return _report(totals, business, min_reviews, min_gain, limit)


_RISING_STAR_SQL = """
WITH rated AS (
    SELECT business_id,
           stars,
           CASE WHEN review_date IS NULL THEN CASE WHEN :undated_is_prior THEN false END
                ELSE review_date >= date_sub((SELECT max(review_date) FROM {reviews}), :window_days)
           END AS is_recent
    FROM {reviews}
), totals AS (
    SELECT business_id,
           count_if(is_recent) AS recent_count,
           avg(stars) FILTER (WHERE is_recent) AS recent_mean,
           avg(stars) FILTER (WHERE NOT is_recent) AS earlier_mean
    FROM rated
    GROUP BY business_id
), risers AS (
    SELECT *, recent_mean - earlier_mean AS gain
    FROM totals
    WHERE recent_count >= :min_reviews AND recent_mean >= earlier_mean + :min_gain
)
SELECT business_id,
       name,
       recent_count AS reviews_past_year,
       round(recent_mean, 2) AS avg_rating_past_year,
       round(earlier_mean, 2) AS avg_rating_prior,
       round(gain, 2) AS rating_improvement
FROM risers JOIN {business} USING (business_id)
ORDER BY rating_improvement DESC, reviews_past_year DESC, business_id
"""


def rising_star_sql(
    spark: SparkSession,
    reviews: DataFrame,
    business: DataFrame,
    window_days: int = WINDOW_DAYS,
    min_reviews: int = MIN_REVIEWS,
    min_gain: float = MIN_GAIN,
    null_dates: NullDates = "exclude",
    limit: int | None = None,
) -> DataFrame:
    """The report as one parameterised SQL text, with the options of
    :func:`rising_star`."""
    if null_dates not in ("exclude", "prior"):
        raise ValueError(f"null_dates must be 'exclude' or 'prior', not {null_dates!r}")
    rule = {
        "window_days": window_days,
        "min_reviews": min_reviews,
        "min_gain": min_gain,
        "undated_is_prior": null_dates == "prior",
    }
    text = _RISING_STAR_SQL
    if limit is not None:
        text, rule["most_rows"] = f"{text}LIMIT :most_rows", limit
    named = business.select("business_id", "name")
    return spark.sql(text, args=rule, reviews=reviews, business=named)
