from datetime import date, datetime

import pytest

from townsquare import functions as fn


def value(spark, literal, make):
    df = spark.createDataFrame([(literal,)], "x string")
    return df.select(make("x")).first()[0]


@pytest.mark.parametrize(
    "text, tokens",
    [
        (None, []),
        ("", [""]),
        ("A", ["A"]),
        ("A, B,,C,", ["A", "B", "", "C", ""]),
        ("\tA , B", ["\tA", "B"]),
    ],
)
def test_split_trimmed(spark, text, tokens):
    assert value(spark, text, fn.split_trimmed) == tokens


@pytest.mark.parametrize(
    "text, count",
    [(None, 0), ("None", 0), ("none", 1), ("", 1), ("a", 1), ("a, b", 2)],
)
def test_token_count(spark, text, count):
    assert value(spark, text, lambda c: fn.token_count(c, "None")) == count


@pytest.mark.parametrize("text, filled", [("a", True), ("  ", False), ("", False), (None, None), ("\t", True)])
def test_is_filled(spark, text, filled):
    assert value(spark, text, fn.is_filled) is filled


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("2020-02-29 10:20:30", datetime(2020, 2, 29, 10, 20, 30)),
        (" 2020-01-01 00:00:00 ", datetime(2020, 1, 1)),
        ("2019-02-29 00:00:00", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, parsed):
    assert value(spark, text, fn.parse_timestamp) == parsed


@pytest.mark.parametrize(
    "text, parsed",
    [("2015-03-04 05:06:07", date(2015, 3, 4)), ("2015-03-04", date(2015, 3, 4)), ("soon", None), (None, None)],
)
def test_parse_date(spark, text, parsed):
    assert value(spark, text, fn.parse_date) == parsed


def test_calendar_columns(spark):
    days = [(date(2021, 1, 1),), (date(2020, 2, 29),), (date(2023, 12, 31),), (None,)]
    df = spark.createDataFrame(days, "date date").withColumns(fn.calendar_columns("date"))
    got = [tuple(row)[1:] for row in df.collect()]
    assert got == [
        (20210101, 2021, 1, 1, "January", 1, "Friday", 53, False),
        (20200229, 2020, 1, 2, "February", 29, "Saturday", 9, True),
        (20231231, 2023, 4, 12, "December", 31, "Sunday", 52, True),
        (None,) * 9,
    ]
    assert dict(df.dtypes)["date_key"] == "int"


def test_date_key_equals_formatted_date(spark):
    spans = "explode(sequence(date'0001-01-01', date'9999-12-31', interval 97 day)) AS d"
    df = spark.range(1).selectExpr(spans).withColumn("k", fn.date_key("d"))
    assert df.where("k <> cast(date_format(d, 'yyyyMMdd') AS int)").count() == 0


def test_date_key_of_odd_years(spark):
    """The formatted date read as INT where it is one, else NULL; never an error."""
    days = "date'+220000-01-01' AS far, date'-0044-03-15' AS bc, date'0000-12-31' AS zero, date'+10000-01-01' AS more"
    df = spark.range(1).selectExpr(*days.split(", "))
    got = df.select(*(fn.date_key(name).alias(name) for name in df.columns)).first()
    assert tuple(got) == (None, -440315, 1231, 100000101)
