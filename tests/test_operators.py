from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import executed_plan, rows
from townsquare.operators import (
    cluster_rows,
    comes_first,
    explode_tokens,
    in_years,
    keep_latest,
    rebalance_rows,
    tag_period,
    trailing_cutoff,
    zorder_rows,
)
from townsquare.operators.layout import bits_for, bounds_passed, _spread_bits, with_zorder_key


def test_keep_latest_prefers_newest_then_smallest(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "n"), ("b", 0, "m"), (None, 5, "q")],
        "k string, t int, v string",
    )
    assert rows(keep_latest(df, ["k"], ["t"])) == [("a", 3, "y"), ("b", 0, "m"), (None, 5, "q")]


def test_keep_latest_ignores_input_order(spark):
    data = [(i % 7, i % 5, f"v{i % 11}", {"m": str(i % 3)}) for i in range(300)]
    schema = "k int, t int, v string, m map<string,string>"
    forward = keep_latest(spark.createDataFrame(data, schema), ["k"], ["t"])
    backward = keep_latest(spark.createDataFrame(data[::-1], schema).repartition(3), ["k"], ["t"])
    assert rows(forward) == rows(backward)


def test_keep_latest_on_keys_only(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(keep_latest(df, ["k"])) == [("a",), ("b",)]


def test_comes_first_decides_as_keep_latest_does(spark):
    """Every pair of rows, NULLs, NaN and maps among them."""
    data = [(t, d, v, m) for t in (None, 1, 2) for d in (None, 0.0, -0.0, float("nan")) for v in (None, "", "x") for m in (None, {}, {"b": "1", "a": "2"})]
    df = spark.createDataFrame(data, "t int, d double, v string, m map<string,string>").withColumn("i", F.monotonically_increasing_id())
    one = df.select(F.struct(*df.columns).alias("a"))
    pairs = one.crossJoin(one.withColumnRenamed("a", "b")).where("a.i <> b.i").withColumn("k", F.struct("a.i", F.col("b.i").alias("j")))
    fields = df.drop("i").schema.fields
    first = pairs.select("k", comes_first("a", "b", fields, ["t"]).alias("a_first"), comes_first("b", "a", fields, ["t"]).alias("b_first"))
    both = pairs.select("k", F.explode(F.array("a", "b")).alias("r")).select("k", "r.t", "r.d", "r.v", "r.m")
    names = ("t", "d", "v", "m")
    survivor = keep_latest(both, ["k"], ["t"]).select("k", F.struct(*names).alias("s"))

    def same(side):
        parts = [F.struct(f"{side}.t", f"{side}.d", f"{side}.v", F.array_sort(F.map_entries(f"{side}.m"))) for side in (side, "s")]
        return parts[0].eqNullSafe(parts[1])

    wrong = pairs.join(survivor, "k").join(first, "k").where((F.col("a_first") & ~same("a")) | (F.col("b_first") & ~same("b")) | (~F.col("a_first") & ~F.col("b_first") & ~(same("a") & same("b"))))
    assert wrong.count() == 0
    assert first.where("a_first AND b_first").count() == 0


def test_keep_latest_limits_rows_before_the_shuffle(spark):
    """A key with most of the rows reaches the reducers as one row per task."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = executed_plan(keep_latest(df, ["k"], ["id"]))
    assert "row_number(), 1, Partial" in plan
    assert keep_latest(df, ["k"], ["id"]).where("k = 0").collect()[0]["id"] == 8997


def test_explode_tokens(spark):
    df = spark.createDataFrame([("a", "1, 2,,"), ("b", None), ("c", "")], "k string, packed string")
    got = explode_tokens(df, "packed", into="token", keep=["k"])
    assert rows(got) == [("a", ""), ("a", ""), ("a", "1"), ("a", "2"), ("c", "")]


@pytest.mark.parametrize(
    "null_dates, label", [("prior", "prior"), ("exclude", None)]
)
def test_tag_period_cutoff_is_inclusive(spark, null_dates, label):
    days = [(date(2020, 12, 31),), (date(2020, 1, 1),), (date(2019, 12, 31),), (None,)]
    df = spark.createDataFrame(days, "d date")
    tagged = tag_period(df, "d", trailing_cutoff(df, "d", 365), null_dates)
    assert [row["period"] for row in tagged.collect()] == ["past_year", "past_year", "prior", label]


def test_tag_period_rejects_unknown_rule(spark):
    with pytest.raises(ValueError):
        tag_period(spark.createDataFrame([], "d date"), "d", F.lit(None), "sometimes")


def test_in_years_prunes_partitions(spark, tmp_path):
    days = [(date(year, month, 1), year) for year in range(2010, 2020) for month in (1, 7)]
    df = spark.createDataFrame(days, "review_date date, review_year int")
    rebalance_rows(df, "review_year").write.partitionBy("review_year").parquet(str(tmp_path / "t"))
    picked = in_years(spark.read.parquet(str(tmp_path / "t")), "2014-02-01", "2015-06-30")
    assert rows(picked.select("review_date")) == [(date(2014, 7, 1),), (date(2015, 1, 1),)]
    scan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(review_year" in scan


def test_rebalance_splits_a_hot_value(spark, tmp_path):
    df = spark.range(200000).select("id", F.xxhash64("id").alias("v"), F.lit(2001).alias("year"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256KB")
    try:
        rebalance_rows(df, "year").write.partitionBy("year").parquet(str(tmp_path / "t"))
    finally:
        spark.conf.set(size, before)
    written = spark.read.parquet(str(tmp_path / "t"))
    assert written.count() == 200000
    assert len(written.inputFiles()) > 1


def test_cluster_rows_keeps_all_rows_and_splits_a_hot_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("b"), "id")
    laid = cluster_rows(df, ["b"], partitions=4).withColumn("p", F.spark_partition_id())
    assert laid.count() == 30000
    sizes = [row["count"] for row in laid.groupBy("p").count().collect()]
    assert max(sizes) < 12000
    ranges = laid.groupBy("p").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).orderBy("p").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))


def test_cluster_rows_splits_identical_rows(spark):
    copies = spark.range(0, 8000, 1, 8).select(F.lit("same").alias("b"))
    laid = cluster_rows(copies, ["b"], partitions=4).groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in laid) == 8000 and max(row["count"] for row in laid) < 4000


def test_spread_bits():
    assert [_spread_bits(v, 2) for v in range(4)] == [0, 1, 4, 5]
    assert _spread_bits(0b101, 3) == 0b1000001


def test_zorder_narrows_both_columns(spark):
    df = spark.range(6400).select((F.col("id") % 80).alias("x"), F.floor(F.col("id") / 80).alias("y"))
    laid = zorder_rows(df, ["x", "y"], partitions=16)
    assert rows(laid) == rows(df)
    span = (
        laid.groupBy(F.spark_partition_id())
        .agg((F.max("x") - F.min("x")).alias("x"), (F.max("y") - F.min("y")).alias("y"))
        .agg(F.avg("x"), F.avg("y"))
        .first()
    )
    assert max(span) < 50  # a sort on one column leaves the other at 79


def test_zorder_key_orders_text_and_tolerates_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "s string")
    keyed = {row["s"]: row["z"] for row in with_zorder_key(df, ["s"], "z").collect()}
    assert keyed["a"] <= keyed["b"] <= keyed["c"] and keyed[None] == 0


def test_zorder_compares_whole_texts(spark):
    """Cities that agree in their first bytes still differ."""
    df = spark.createDataFrame([("San Francisco",), ("San Francisquito",), ("San Fraxxx",), ("San Fran",)], "s string")
    keys = {row["s"]: row["z"] for row in with_zorder_key(df, ["s"], "z", bits=2).collect()}
    assert [keys[s] for s in sorted(keys)] == [0, 1, 2, 3]


def test_zorder_bits_follow_the_files():
    assert bits_for(16, 2) == 3 and bits_for(100_000, 2) == 9 and bits_for(1, 4) == 1
    assert bits_for(10**9, 40) == 1


def test_zorder_bits_follow_a_sized_session(spark):
    from townsquare.config import session_sized_for, shuffle_width

    wide = session_sized_for(spark, 100 * 2**40)  # 100 TB
    assert shuffle_width(wide) == 409_600 and bits_for(shuffle_width(wide), 2) == 10
    assert shuffle_width(session_sized_for(spark, 0)) == shuffle_width(spark)


@pytest.mark.parametrize("bounds", [[], [5], [1, 3], [0, 2, 4], list(range(0, 200, 3)), list(range(1023))])
def test_binary_search_over_bounds(spark, bounds):
    df = spark.createDataFrame([(v,) for v in [None, *range(-3, 1100, 7)]], "v int")
    found = df.select("v", bounds_passed(F.col("v"), bounds, T.IntegerType()).alias("n")).collect()
    assert all(r.n == (0 if r.v is None else sum(b <= r.v for b in bounds)) for r in found)


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    from types import SimpleNamespace

    from townsquare import config

    def session(**conf):
        settings = {"spark.sql.warehouse.dir": "/w"} | {k.replace("_", "."): v for k, v in conf.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))

    assert config.shared_dir(session(spark_master="local[4]"), "x").startswith("/w/_scratch/")
    assert config.shared_dir(session(spark_master="yarn", spark_checkpoint_dir="/s"), "x").startswith("/s/")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            config.shared_dir(session(spark_master=master), "x")
