from datetime import date

import pytest

from conftest import rows
from townsquare.plans import gold, reports


@pytest.fixture
def facts(spark):
    data = [
        ("a", date(2020, 1, 4), 2020, 5.0),  # Saturday
        ("a", date(2020, 1, 6), 2020, 4.0),  # Monday
        ("a", date(2020, 3, 2), 2020, 3.0),
        ("b", date(2021, 3, 2), 2021, 2.0),
        ("c", None, None, 1.0),
    ]
    df = spark.createDataFrame(data, "business_id string, review_date date, review_year int, stars double")
    return df.selectExpr("*", "cast(date_format(review_date, 'yyyyMMdd') AS int) AS date_key")


@pytest.fixture
def days(spark, facts):
    none = spark.createDataFrame([], "tip_date date, checkin_date date")
    return gold.dim_date(facts, none, none)


@pytest.fixture
def bridge(spark):
    pairs = [("a", "Food"), ("a", "Bars"), ("b", "Food"), ("x", "Empty")]
    return spark.createDataFrame(pairs, "business_id string, category string")


def test_top_categories_breaks_ties_by_name(bridge):
    assert [tuple(r) for r in reports.top_categories(bridge, 2).collect()] == [("Food", 2), ("Bars", 1)]


def test_reviews_by_year_keeps_undated(facts):
    got = [tuple(r) for r in reports.reviews_by_year(facts).collect()]
    assert got == [(None, 1, 1.0), (2020, 3, 4.0), (2021, 1, 2.0)]


def test_month_over_month_knows_empty_months(facts, days):
    got = sorted(tuple(r) for r in reports.month_over_month(facts, days).collect())
    assert len(got) == 15
    assert got[:4] == [(2020, 1, 2, None, None), (2020, 2, 0, 2, -2), (2020, 3, 1, 0, 1), (2020, 4, 0, 1, -1)]
    assert got[-3:] == [(2021, 1, 0, 0, 0), (2021, 2, 0, 0, 0), (2021, 3, 1, 0, 1)]


def test_weekend_split(facts, days):
    assert rows(reports.weekend_split(facts, days)) == [(False, 3, 3.0), (True, 1, 5.0)]


def test_reviews_by_category(facts, bridge):
    assert rows(reports.reviews_by_category(facts, bridge)) == [("Bars", 3, 4.0), ("Food", 4, 3.5)]


def test_daily_checkins(spark, facts, days):
    checkins = spark.createDataFrame([("a", 20200104, 2), ("b", 20200104, 3)], "business_id string, date_key int, checkin_count long")
    assert rows(reports.daily_checkins(checkins, days)) == [(date(2020, 1, 4), "Saturday", 5)]
