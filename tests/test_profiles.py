import uuid

import pytest
from pyspark.sql import functions as F

from townsquare.plans.bronze import ingest_bronze
from townsquare.plans.changes import take_back
from townsquare.plans.profiles import (
    MOST_SEGMENTS,
    merge_sketches,
    profile_loads,
    profile_table,
    read_sketches,
    sketch_columns,
    stored_profile,
)
from townsquare.sinks import TableStore
from townsquare.sources import scan_json
from townsquare.streaming import ingest_incremental, stream_table


def by_column(df):
    return {row["column"]: row for row in df.collect()}


def test_merged_sketches_equal_the_whole(spark):
    df = spark.range(40_000).select(
        F.col("id"), (F.col("id") % 500).cast("string").alias("name"), F.when(F.col("id") % 4 > 0, F.col("id") / 10).alias("x")
    )
    parts = [sketch_columns(df.where(F.col("id") % 3 == i)) for i in range(3)]
    merged = by_column(read_sketches(merge_sketches(merge_sketches(parts[0].union(parts[1])).union(parts[2]))))
    whole = by_column(read_sketches(sketch_columns(df)))
    for name, row in merged.items():
        assert row[:3] == whole[name][:3] and row[4:6] == whole[name][4:6]
        assert row["approx_distinct"] == pytest.approx(df.select(name).where(f"{name} IS NOT NULL").distinct().count(), rel=0.06)
    assert merged["x"]["nulls"] == 10_000 and merged["id"]["max_value"] == "39999"  # compared as numbers
    assert merged["id"]["quantiles"] == pytest.approx([10_000, 20_000, 30_000], abs=800)
    assert merged["name"]["quantiles"] is None


def test_empty_null_and_map_columns(spark):
    df = spark.createDataFrame([(None, None, {"a": "b"})], "n int, s string, m map<string,string>")
    for rows in (df, df.limit(0)):
        found = by_column(read_sketches(merge_sketches(sketch_columns(rows).union(sketch_columns(rows)))))
        assert found["n"]["quantiles"] is None and found["n"]["min_value"] is None
        assert found["n"]["approx_distinct"] == 0 and found["m"]["approx_distinct"] is None
        assert found["s"]["nulls"] == 2 * rows.count()


def test_an_empty_load_does_not_hide_extremes(spark):
    df = spark.range(5, 9)
    found = by_column(read_sketches(merge_sketches(sketch_columns(df).union(sketch_columns(df.limit(0))))))
    assert (found["id"]["min_value"], found["id"]["max_value"], found["id"]["rows"]) == ("5", "8", 4)


@pytest.fixture
def lake(spark, tmp_path, land):
    store = TableStore(spark, str(tmp_path / "tables"), prefix=f"f{uuid.uuid4().hex}")
    store.ensure_layers()

    def ingest(batch, *lines):
        land(f"in/{batch}.json", *lines)
        ingest_incremental(
            *(spark, "tip", str(tmp_path / "in"), store.name("bronze", stream_table("tip")), str(tmp_path / "cp")),
            path=str(tmp_path / "stream"),
            batch_id=batch,
        ).awaitTermination()

    return store, ingest


def tips(first, last):
    return [{"business_id": f"b{i}", "user_id": "u", "compliment_count": i} for i in range(first, last)]


def test_each_load_is_read_once(spark, lake, land):
    store, ingest = lake
    ingest_bronze(store, "tip", scan_json(spark, "tip", land("first.json", *tips(0, 10))), "base")
    (base,) = profile_loads(store, "tip")
    ingest("A", *tips(5, 30))
    with pytest.raises(ValueError, match="A"):
        stored_profile(store, "tip")
    assert profile_loads(store, "tip") == ["A"] and profile_loads(store, "tip") == []
    found = by_column(stored_profile(store, "tip"))["compliment_count"]
    assert (found["rows"], found["approx_distinct"], found["min_value"], found["max_value"]) == (35, 30, "0", "29")
    ingest_bronze(store, "tip", scan_json(spark, "tip", land("next.json", *tips(40, 42))), "next")
    (following,) = profile_loads(store, "tip")
    assert following != base
    assert by_column(stored_profile(store, "tip"))["business_id"]["rows"] == 27  # the replaced load counts no longer


def test_a_batch_taken_back_leaves_the_profile(lake):
    store, ingest = lake
    ingest("A", *tips(0, 10))
    ingest("B", *tips(10, 30))
    assert profile_loads(store, "tip") == ["A", "B"]
    take_back(store, "B", window_days=365, min_reviews=1)
    found = by_column(stored_profile(store, "tip"))["compliment_count"]
    assert (found["rows"], found["max_value"]) == (10, "9")


def test_many_loads_are_stored_as_one(spark, lake):
    store, ingest = lake
    ingest("A", *tips(0, 2))
    profile_loads(store, "tip")
    for _ in range(MOST_SEGMENTS - 1):
        store.append("bronze", profile_table("tip"), store.read("bronze", profile_table("tip")).limit(0))
    ingest("B", *tips(2, 4))
    profile_loads(store, "tip")
    assert len(store.contents("bronze", profile_table("tip")).segments) == 1
    assert by_column(stored_profile(store, "tip"))["compliment_count"]["rows"] == 4
