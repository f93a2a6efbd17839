from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan, rows
from townsquare.plans import silver


def test_business(raw):
    got = silver.silver_business(
        raw(
            "business",
            {"business_id": None, "name": "dropped"},
            {"business_id": "a", "name": " Cafe ", "city": " X", "state": "Y ", "categories": "A, B,,C,"},
            {"business_id": "a", "name": " Cafe ", "city": " X", "state": "Y ", "categories": "A, B,,C,"},
            {"business_id": "b", "name": "\tTab ", "categories": None, "hours": {"Mon": "9-5"}},
            {"business_id": "c", "categories": ""},
        )
    )
    assert rows(got, "business_id", "name", "city", "state", "category_array") == [
        ("a", "Cafe", "X", "Y", ["A", "B", "", "C", ""]),
        ("b", "\tTab", None, None, []),
        ("c", None, None, None, [""]),
    ]
    assert {"categories", "attributes", "hours"} <= set(got.columns)


def test_business_prefers_the_newest_load(raw):
    first = raw("business", {"business_id": "a", "name": "old"})
    second = raw("business", {"business_id": "a", "name": "aaa new"})
    loads = first.withColumn("_ingested_at", F.lit("2020-01-02").cast("timestamp")).union(
        second.withColumn("_ingested_at", F.lit("2020-01-03").cast("timestamp"))
    )
    assert silver.silver_business(loads).first()["name"] == "aaa new"


def test_business_survivor_with_differing_maps_is_stable(raw):
    one = {"business_id": "a", "attributes": {"x": "1"}}
    two = {"business_id": "a", "attributes": {"x": "2"}}
    picked = {silver.silver_business(raw("business", *pair)).first()["attributes"]["x"] for pair in ((one, two), (two, one))}
    assert len(picked) == 1


def test_business_category(raw):
    business = silver.silver_business(
        raw("business", {"business_id": "a", "categories": "A, B,,A, "}, {"business_id": "b"}, {"business_id": "c", "categories": " "})
    )
    pairs = silver.silver_business_category(business)
    assert rows(pairs) == [("a", "A"), ("a", "B")]
    repeated = business.union(business)
    assert rows(silver.silver_business_category(repeated)) == rows(pairs)


def test_business_category_adds_no_shuffle(raw):
    business = raw("business", {"business_id": "a", "categories": "A,B"}).withColumn(
        "category_array", F.split("categories", ",")
    )
    assert "Exchange" not in executed_plan(silver.silver_business_category(business, unique_businesses=True))


REVIEW = {"review_id": "r", "business_id": "b", "user_id": "u", "stars": 3.0, "date": "2020-01-01 10:00:00"}


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({"review_id": None}, False),
        ({"business_id": None}, False),
        ({"user_id": None}, True),
        ({"stars": 1.0}, True),
        ({"stars": 5.0}, True),
        ({"stars": 0.0}, False),
        ({"stars": 6.0}, False),
        ({"stars": None}, False),
        ({"stars": float("nan")}, False),
        ({"date": "garbage"}, True),
        ({"date": None}, True),
    ],
)
def test_review_filters(raw, change, kept):
    assert silver.silver_review(raw("review", REVIEW | change)).count() == int(kept)


def test_review_types_and_columns(raw):
    got = silver.silver_review(raw("review", REVIEW | {"text": "long text", "useful": 2}, REVIEW | {"review_id": "s", "date": "bad"}))
    assert got.columns == [
        *("review_id", "business_id", "user_id", "stars", "useful", "funny", "cool"),
        *("review_ts", "review_date", "review_year"),
    ]
    assert rows(got, "review_id", "review_ts", "review_date", "review_year") == [
        ("r", datetime(2020, 1, 1, 10), date(2020, 1, 1), 2020),
        ("s", None, None, None),
    ]


def test_review_range_check_precedes_dedupe(raw):
    newer_but_invalid = REVIEW | {"stars": 0.0, "date": "2021-01-01 00:00:00"}
    assert rows(silver.silver_review(raw("review", REVIEW, newer_but_invalid)), "stars") == [(3.0,)]


def test_review_keeps_the_newest_copy(raw):
    copies = [REVIEW | {"date": d, "stars": s} for d, s in (("2020-01-01 00:00:00", 1.0), ("2020-06-01 00:00:00", 4.0), ("bad", 5.0))]
    assert rows(silver.silver_review(raw("review", *copies)), "stars") == [(4.0,)]


def test_review_text_never_reaches_the_shuffle(raw):
    plan = executed_plan(silver.silver_review(raw("review", REVIEW)))
    assert "Partial" in plan
    assert all("text#" not in line for line in plan.splitlines() if "Exchange" in line)


def test_user(raw):
    people = [
        {"user_id": None},
        {"user_id": "a", "friends": None, "elite": None, "yelping_since": "2010-05-06 07:08:09"},
        {"user_id": "b", "friends": "None", "elite": "", "yelping_since": "bad"},
        {"user_id": "c", "friends": "none", "elite": " "},
        {"user_id": "d", "friends": "", "elite": "2015"},
        {"user_id": "e", "friends": "x, y", "elite": "2015, 2016"},
        {"user_id": "e", "friends": "x, y", "elite": "2015, 2016"},
    ]
    got = silver.silver_user(raw("user", *people))
    assert rows(got, "user_id", "friend_count", "elite_years", "is_elite", "yelping_since_date") == [
        ("a", 0, [], False, date(2010, 5, 6)),
        ("b", 0, [], False, None),
        ("c", 1, [], False, None),
        ("d", 1, ["2015"], True, None),
        ("e", 2, ["2015", "2016"], True, None),
    ]
    assert not {"friends", "elite", "yelping_since"} & set(got.columns)
    assert "compliment_photos" in got.columns


def test_checkin(raw):
    got = silver.silver_checkin(
        raw(
            "checkin",
            {"business_id": None, "date": "2020-01-01 00:00:00"},
            {"business_id": "a", "date": None},
            {"business_id": "b", "date": ""},
            {"business_id": "c", "date": "2020-01-01 10:00:00"},
            {"business_id": "d", "date": "2020-01-01 10:00:00, 2020-01-01 10:00:00,garbage,"},
        )
    )
    when = datetime(2020, 1, 1, 10)
    assert rows(got) == [(b, when, date(2020, 1, 1)) for b in ("c", "d", "d")]


def test_tip(raw):
    tips = [
        {"business_id": None, "text": "dropped"},
        {"business_id": "b", "user_id": None, "text": "t", "date": "2020-01-01 10:00:00", "compliment_count": 1},
        {"business_id": "b", "user_id": None, "text": "t", "date": "2020-01-01 10:00:00", "compliment_count": 1},
        {"business_id": "c", "date": "soon"},
    ]
    got = silver.silver_tip(raw("tip", *tips))
    assert got.columns == ["user_id", "business_id", "text", "compliment_count", "tip_ts", "tip_date"]
    assert rows(got, "business_id", "tip_date") == [("b", date(2020, 1, 1))] * 2 + [("c", None)]


def test_rated_review_is_the_review_without_votes(raw):
    tied = [REVIEW | {"user_id": u, "stars": s, "useful": n} for u, s, n in (("v", 1.0, 1), ("u", 5.0, 3), ("u", 5.0, 2), ("u", 4.0, 9), (None, 2.0, 8))]
    bronze = raw("review", *tied, REVIEW | {"review_id": "s", "date": "bad"}, REVIEW | {"review_id": "t", "stars": 9.0})
    rated = silver.rated_review(bronze)
    assert rows(rated) == rows(silver.silver_review(bronze).select(*rated.columns))
    plan = executed_plan(rated)
    assert all("useful#" not in line for line in plan.splitlines() if "Exchange" in line)
