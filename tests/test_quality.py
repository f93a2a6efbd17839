import pytest
from pyspark.sql import functions as F

from conftest import rows
from townsquare.plans import quality


def keyed(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def test_row_count_audit(spark):
    audit = quality.row_count_audit({"a": keyed(spark, "x", "y"), "b": keyed(spark)})
    assert rows(audit) == [("a", 2), ("b", 0)]


def test_pk_null_check(spark):
    audit = quality.pk_null_check({"a": (keyed(spark, "x", None, None), "k"), "b": (keyed(spark), "k")})
    assert rows(audit) == [("a", "k", 3, 2), ("b", "k", 0, 0)]


def test_duplicate_key_check(spark):
    assert rows(quality.duplicate_key_check(keyed(spark, "x", "x", "y"), "k")) == [(1,)]


def test_orphan_count(spark):
    child = keyed(spark, "a", "b", "b", "c", None)
    assert rows(quality.orphan_count(child, keyed(spark, "a"), "k")) == [(2, 3)]
    assert rows(quality.orphan_count(child, child, "k")) == [(0, 0)]


def test_orphan_join_meets_each_key_once(spark):
    """The hot child key is reduced before the anti join, not after it."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        audit = quality.orphan_count(keyed(spark, "a", "a"), keyed(spark, "b"), "k")
        plan = audit._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert plan.index("Join LeftAnti") < plan.rindex("Aggregate [k")


def test_expansion_check(spark):
    assert rows(quality.expansion_check(keyed(spark, "a"), keyed(spark, "a", "a"))) == [(1, 2)]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "b", {"x": "1"}, ["q"]), (2, None, None, None), (2, "a", None, ["p"])],
        "n int, s string, m map<string,string>, a array<string>",
    )
    assert quality.profile(df).drop("approx_distinct").collect() == [
        ("n", 3, 0, "1", "2"),
        ("s", 3, 1, "a", "b"),
        ("m", 3, 2, None, None),
        ("a", 3, 1, "[p]", "[q]"),
    ]


def test_profile_distinct_is_close(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("v"))
    assert abs(quality.profile(df).first()["approx_distinct"] - 5000) < 750


def test_enforce(spark):
    checks = spark.createDataFrame([("fine", 0), ("orphans", 3)], "check string, violations long")
    quality.enforce(checks.where("violations = 0"))
    with pytest.raises(quality.DataQualityError, match="orphans: 3"):
        quality.enforce(checks)
    many = spark.range(25).selectExpr("concat('check ', id) AS check", "id + 1 AS violations")
    with pytest.raises(quality.DataQualityError) as raised:
        quality.enforce(many)
    assert all(f"check {i}: {i + 1}" in str(raised.value).split("; ") for i in range(25))
