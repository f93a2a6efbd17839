from datetime import date, timedelta

import pytest

from conftest import rows
from townsquare.plans import rising

LAST = date(2020, 12, 31)
CUTOFF = date(2020, 1, 1)  # 365 days before, in a leap year
SCHEMA = "business_id string, review_date date, stars double"


def ratings(business, recent, earlier, undated=()):
    """Reviews of a business: star lists inside, before and outside the window."""
    rows_ = [(business, LAST - timedelta(days=i), s) for i, s in enumerate(recent)]
    rows_ += [(business, CUTOFF - timedelta(days=1 + i), s) for i, s in enumerate(earlier)]
    return rows_ + [(business, None, s) for s in undated]


@pytest.fixture
def names(spark):
    ids = ["anchor", "a", "b", "c", "d"]
    return spark.createDataFrame([(i, f"name {i}") for i in ids], "business_id string, name string")


def run(spark, names, data, **rule):
    anchored = [("anchor", LAST, 1.0), *data]
    return rows(rising.rising_star(spark.createDataFrame(anchored, SCHEMA), names, **rule))


def test_review_count_threshold(spark, names):
    data = ratings("a", [5.0] * 9, [1.0]) + ratings("b", [5.0] * 10, [1.0])
    assert run(spark, names, data) == [("b", "name b", 10, 5.0, 1.0, 4.0)]


def test_gain_is_inclusive_and_unrounded(spark, names):
    exact = ratings("a", [4.0] * 10, [3.0])
    short = ratings("b", [4.0] * 10, [3.0] * 199 + [4.0])  # mean 3.005, gain 0.995
    assert [row[0] for row in run(spark, names, exact + short)] == ["a"]


def test_needs_both_periods(spark, names):
    data = ratings("a", [5.0] * 10, []) + ratings("b", [], [1.0] * 10)
    assert run(spark, names, data) == []


def test_cutoff_day_is_recent(spark, names):
    data = ratings("a", [5.0] * 9, [1.0]) + [("a", CUTOFF, 5.0)]
    assert [row[:3] for row in run(spark, names, data)] == [("a", "name a", 10)]


def test_undated_reviews(spark, names):
    data = ratings("a", [4.0] * 10, [3.0], undated=[5.0]) + ratings("b", [4.0] * 10, [], undated=[1.0])
    assert [row[0] for row in run(spark, names, data)] == ["a"]
    assert [row[0] for row in run(spark, names, data, null_dates="prior")] == ["b"]


def test_business_without_dimension_row_drops_out(spark, names):
    assert run(spark, names, ratings("orphan", [5.0] * 10, [1.0])) == []


def test_order_and_limit(spark, names):
    data = ratings("c", [4.0] * 10, [2.0]) + ratings("a", [4.0] * 10, [2.0]) + ratings("b", [4.0] * 11, [2.0])
    data += ratings("d", [5.0] * 10, [2.0])
    reviews = spark.createDataFrame([("anchor", LAST, 1.0), *data], SCHEMA)
    ranked = [row["business_id"] for row in rising.rising_star(reviews, names).collect()]
    assert ranked == ["d", "b", "a", "c"]
    short = rising.rising_star_short(reviews, names, limit=2)
    assert [row["business_id"] for row in short.collect()] == ["d", "b"]
    assert short.columns == ["business_id", "name", "reviews_py", "avg_past_year", "avg_prior", "improvement"]


def test_rounding_is_half_up(spark, names):
    recent = [5.0] * 7 + [4.0] * 1  # 4.875
    data = ratings("a", recent, [1.0] * 7 + [2.0])  # 1.125
    assert run(spark, names, data, min_reviews=8) == [("a", "name a", 8, 4.88, 1.13, 3.75)]


def test_sql_and_rollup_agree_with_the_plan(spark, names):
    data = ratings("a", [5.0] * 12, [3.0, 3.5], undated=[1.0]) + ratings("b", [4.5] * 10, [2.0, 5.0])
    data += ratings("c", [4.0] * 6, [1.0])
    reviews = spark.createDataFrame([("anchor", LAST, 1.0), *data], SCHEMA)
    plan = rows(rising.rising_star(reviews, names))
    assert plan and rows(rising.rising_star_sql(spark, reviews, names)) == plan
    assert rows(rising.rising_star_daily(rising.daily_ratings(reviews), names)) == plan


def test_unrated_reviews_count_but_do_not_weigh(spark, names):
    data = ratings("a", [5.0] * 9 + [None], [1.0, None]) + ratings("b", [None] * 10, [None, 1.0])
    reviews = spark.createDataFrame([("anchor", LAST, 1.0), *data], SCHEMA)
    expected = [("a", "name a", 10, 5.0, 1.0, 4.0)]
    assert rows(rising.rising_star(reviews, names)) == expected
    assert rows(rising.rising_star_daily(rising.daily_ratings(reviews), names)) == expected


def test_empty_input(spark, names):
    assert rows(rising.rising_star(spark.createDataFrame([], SCHEMA), names)) == []


def test_plan_joins_only_qualifying_rows(spark, names):
    reviews = spark.createDataFrame(ratings("a", [5.0] * 10, [1.0]), SCHEMA)
    plan = rising.rising_star(reviews, names)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan
    assert plan.index("Join Inner") < plan.index("Filter (") < plan.index("Aggregate [")
