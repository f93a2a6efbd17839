import hashlib
from datetime import date, timedelta

from conftest import executed_plan, rows
from townsquare.plans import gold


def dated(spark, column, *days):
    return spark.createDataFrame([(day,) for day in days], f"{column} date")


def calendar(spark, reviews=(), tips=(), checkins=()):
    return gold.dim_date(
        dated(spark, "review_date", *reviews),
        dated(spark, "tip_date", *tips),
        dated(spark, "checkin_date", *checkins),
    )


def test_dim_date_spans_all_sources(spark):
    got = calendar(spark, [date(2020, 12, 30), None], [date(2021, 1, 2)], [date(2020, 12, 31)])
    first = date(2020, 12, 30)
    assert rows(got, "date") == [(first + timedelta(days=i),) for i in range(4)]
    assert got.columns[0] == "date"
    assert [row["week_of_year"] for row in got.orderBy("date").collect()] == [53] * 4


def test_dim_date_single_day_and_leap_day(spark):
    assert rows(calendar(spark, [date(2020, 2, 29)]), "date_key", "day", "is_weekend") == [(20200229, 29, True)]


def test_dim_date_without_dates_is_empty(spark):
    assert calendar(spark).count() == 0
    assert calendar(spark, [None], [None], [None]).count() == 0


def test_dim_business_and_user_rename(spark):
    business = spark.createDataFrame(
        [("b", "n", "a", "c", "s", "p", 1.0, 2.0, 4.5, 7, 1, ["x"], "raw")],
        "business_id string, name string, address string, city string, state string, postal_code string,"
        "latitude double, longitude double, stars double, review_count long, is_open int,"
        "category_array array<string>, categories string",
    )
    assert gold.dim_business(business).first().asDict() == {
        **{"business_id": "b", "name": "n", "address": "a", "city": "c", "state": "s", "postal_code": "p"},
        **{"latitude": 1.0, "longitude": 2.0, "avg_stars_alltime": 4.5, "review_count_alltime": 7},
        **{"is_open": 1, "category_array": ["x"]},
    }
    user = spark.createDataFrame(
        [("u", "n", date(2010, 1, 1), 3, 4.0, 5, 6, True, ["2015"], 9)],
        "user_id string, name string, yelping_since_date date, review_count long, average_stars double,"
        "fans long, friend_count int, is_elite boolean, elite_years array<string>, useful long",
    )
    assert gold.dim_user(user).first().asDict() == {
        **{"user_id": "u", "name": "n", "yelping_since_date": date(2010, 1, 1)},
        **{"review_count_alltime": 3, "avg_stars_given": 4.0, "fans": 5, "friend_count": 6},
        **{"is_elite": True, "elite_years": ["2015"]},
    }


def test_dim_category_key(spark):
    pairs = spark.createDataFrame([("a", "Food"), ("b", "Food"), ("b", "Bars")], "business_id string, category string")
    expected = [(c, hashlib.sha256(c.encode()).hexdigest()[:12]) for c in ("Bars", "Food")]
    assert rows(gold.dim_category(pairs)) == expected
    assert rows(gold.bridge_business_category(pairs)) == rows(pairs)


def test_fact_checkin(spark):
    day, next_day = date(2020, 1, 1), date(2020, 1, 2)
    events = spark.createDataFrame(
        [("a", day), ("a", day), ("a", next_day), ("b", day)], "business_id string, checkin_date date"
    )
    got = gold.fact_checkin(events)
    assert rows(got) == [("a", 20200101, day, 2), ("a", 20200102, next_day, 1), ("b", 20200101, day, 1)]
    assert executed_plan(got).count("HashAggregate") >= 2  # partial and final


def test_facts_are_projections(spark):
    review = spark.createDataFrame(
        [("r", "b", "u", 4.0, 1, 2, 3, None, None), ("s", "b", "u", 4.0, 1, 2, 3, date(2020, 3, 4), 2020)],
        "review_id string, business_id string, user_id string, stars double, useful long, funny long, cool long,"
        "review_date date, review_year int",
    )
    fact = gold.fact_review(review)
    assert rows(fact, "review_id", "date_key") == [("r", None), ("s", 20200304)]
    assert "Exchange" not in executed_plan(fact)
    tip = spark.createDataFrame(
        [("b", "u", "text", 1, date(2020, 3, 4))],
        "business_id string, user_id string, text string, compliment_count long, tip_date date",
    )
    assert rows(gold.fact_tip(tip)) == [("b", "u", 20200304, date(2020, 3, 4), 1)]
