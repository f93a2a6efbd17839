import os
from dataclasses import replace
from urllib.parse import urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from townsquare.sinks import Retention, TableStore, ensure_layers, export_frames, read_export, run_writes, write_files


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "tables"), prefix=f"t{abs(hash(str(tmp_path)))}")
    made.ensure_layers()
    return made


def test_ensure_layers_twice(spark):
    names = ensure_layers(spark, "again")
    assert names == ensure_layers(spark, "again")
    assert list(names) == ["landing", "bronze", "silver", "gold"]
    assert all(spark.catalog.databaseExists(name) for name in names.values())


def test_layers_without_prefix(spark, tmp_path):
    names = ensure_layers(spark, "")
    assert names["silver"].endswith(".silver")
    store = TableStore(spark, str(tmp_path), prefix="")
    store.write("silver", "plain", spark.range(2))
    assert spark.sql("SELECT count(*) FROM silver.plain").first()[0] == 2


def test_write_counts_without_reading_back(spark, tmp_path):
    assert write_files(spark.range(1234).repartition(5), str(tmp_path / "a")) == 1234
    assert write_files(spark.range(0), str(tmp_path / "b")) == 0


def test_overwrite_replaces_rows_and_schema(spark, store):
    assert store.write("silver", "t", spark.range(3)) == 3
    held = store.read("silver", "t")
    assert store.write("silver", "t", spark.range(2).select(F.lit("x").alias("other"))) == 2
    assert rows(store.read("silver", "t")) == [("x",), ("x",)]
    assert held.count() == 3  # a query on the old snapshot still finds its files


@pytest.mark.parametrize("by", [[], ["part"]])
def test_table_can_replace_itself(spark, store, by):
    store.write("silver", "t", spark.range(6).withColumn("part", F.col("id") % 2), partition_by=by)
    store.write("silver", "t", store.read("silver", "t").where("id > 1"), partition_by=by)
    assert rows(store.read("silver", "t"), "id") == [(2,), (3,), (4,), (5,)]


def test_failed_write_keeps_the_old_table(spark, store):
    store.write("silver", "t", spark.range(3))
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        store.write("silver", "t", broken)
    assert store.read("silver", "t").count() == 3


def test_partitioned_table_with_null_partition(spark, store):
    df = spark.createDataFrame([("a", 2020), ("b", None), ("c", 2021)], "id string, review_year int")
    assert store.write("gold", "f", df, partition_by=["review_year"]) == 3
    stored = store.read("gold", "f")
    assert rows(stored, "id", "review_year") == [("a", 2020), ("b", None), ("c", 2021)]
    assert dict(stored.dtypes)["review_year"] == "int"
    only_null = df.where("review_year IS NULL")
    store.write("gold", "f", only_null, partition_by=["review_year"])
    assert dict(store.read("gold", "f").dtypes)["review_year"] == "int"


def test_partitioned_and_clustered_table(spark, store):
    df = spark.range(4000).select(
        (F.col("id") % 50).cast("string").alias("business_id"), (2015 + F.col("id") % 3).cast("int").alias("year"), "id"
    )
    store.write("gold", "f", df, partition_by=["year"], cluster_by=["business_id"])
    stored = store.read("gold", "f")
    assert rows(stored, *df.columns) == rows(df)
    spans = stored.groupBy(F.input_file_name()).agg(F.count_distinct("year").alias("n")).collect()
    assert {row["n"] for row in spans} == {1}


def test_zordered_table(spark, store):
    df = spark.range(500).select(F.concat(F.lit("c"), F.col("id") % 20).alias("city"), (F.col("id") % 7).cast("string").alias("state"))
    store.write("gold", "d", df, cluster_by=["city", "state"])
    assert rows(store.read("gold", "d")) == rows(df)


def test_run_writes_reports_failures(spark, store):
    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        run_writes(spark, {"a": lambda: store.write("gold", "a", spark.range(1)), "b": fail})
    assert run_writes(spark, {}) == {}


def test_read_of_missing_table(store):
    with pytest.raises(AnalysisException):
        store.read("gold", "nothing")


def test_export(spark, tmp_path):
    frames = {"a": spark.range(3), "f": spark.range(4).withColumn("review_year", F.lit(2020))}
    out = str(tmp_path / "out")
    assert export_frames(frames, out, {"f": ["review_year"]}) == {"a": 3, "f": 4}
    assert export_frames(frames, out, {"f": ["review_year"]}) == {"a": 3, "f": 4}
    found = read_export(spark, out)
    assert found["f"].count() == 4 and found["a"].count() == 3
    assert all("/review_year=2020/" in path for path in found["f"].inputFiles())


def test_failed_export_leaves_the_old_one(spark, tmp_path):
    out = str(tmp_path / "out")
    export_frames({"a": spark.range(3), "b": spark.range(4)}, out)
    held = read_export(spark, out)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        export_frames({"a": spark.range(30), "b": broken}, out)
    found = read_export(spark, out)
    assert {name: df.count() for name, df in found.items()} == {"a": 3, "b": 4}
    export_frames({"a": spark.range(5)}, out)
    found = read_export(spark, out)
    assert {name: df.count() for name, df in found.items()} == {"a": 5}, "a table left out is not in the new export"
    assert held["b"].count() == 4  # a reader of the old export goes on


def test_read_export_of_nothing(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_export(spark, str(tmp_path))


def test_retention_keeps_versions_and_running_readers(spark, store):
    for n in range(1, 4):
        store.write("silver", "t", spark.range(n).withColumn("p", F.lit("a")), ["p"])
    reader = store.read("silver", "t")
    store.replace_partitions("silver", "t", spark.range(7).withColumn("p", F.lit("b")), "p", ["b"])
    assert store.retain(Retention(keep=9, least_age=0)) == {}
    assert store.retain(Retention(keep=1, least_age=3600)) == {}, "shown an hour ago or later"
    assert len(store.retain(Retention(keep=2, least_age=0))["silver.t"]) == 1
    store.write("silver", "t", spark.range(5).withColumn("p", F.lit("c")), ["p"])
    assert len(store.snapshots("silver", "t")) == 4
    store.retain(Retention(keep=2, least_age=0))  # the version before has two snapshots, both stay
    assert len(store.snapshots("silver", "t")) == 3 and reader.count() == 3
    assert list(store.retain(Retention(keep=1, least_age=0))) == ["silver.t"]
    assert len(store.snapshots("silver", "t")) == 1 and store.read("silver", "t").count() == 5
    store.write("silver", "t", spark.range(1).withColumn("p", F.lit("c")), ["p"])
    assert len(store.contents("silver", "t").left) == 1, "dropped ones are forgotten"


def test_failing_publish_keeps_the_old_rows(spark, store, monkeypatch):
    store.write("silver", "t", spark.range(3))

    def fail(*_):
        raise RuntimeError("metastore away")

    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_publish", fail)
        with pytest.raises(RuntimeError):
            store.write("silver", "t", spark.range(9))
    assert store.read("silver", "t").count() == 3


def test_publish_is_one_metastore_operation(spark, store, monkeypatch):
    """A reader during the swap sees the old rows or the new ones."""
    write = lambda n: store.write("silver", "p", spark.range(n).withColumn("part", F.col("id") % 2), partition_by=["part"])
    write(10)
    seen = []
    publish = TableStore._publish

    def watched(self, layer, table, snapshot):
        seen.append(self.read(layer, table).count())
        publish(self, layer, table, snapshot)
        seen.append(self.read(layer, table).count())

    monkeypatch.setattr(TableStore, "_publish", watched)
    write(4)
    assert seen == [10, 4]


def test_old_snapshots_are_dropped(spark, store):
    for n in range(1, 4):
        store.write("silver", "t", spark.range(n))
    store.write("silver", "t_other", spark.range(7))
    files = store.read("silver", "t").inputFiles()
    assert len(store.snapshots("silver", "t")) == 3
    assert len(store.drop_old_snapshots("silver", "t", keep=2)) == 1
    assert len(store.drop_old_snapshots("silver", "t")) == 1
    assert store.drop_old_snapshots("silver", "t", keep=0) == [], "the published one stays"
    assert store.read("silver", "t").inputFiles() == files and store.read("silver", "t").count() == 3
    assert store.read("silver", "t_other").count() == 7


def test_stored_bytes(spark, store):
    store.write("silver", "t", spark.range(10).withColumn("part", F.col("id") % 2), partition_by=["part"])
    paths = [path.removeprefix("file://").removeprefix("file:") for path in store.read("silver", "t").inputFiles()]
    assert store.stored_bytes("silver", "t") == sum(os.path.getsize(p) for p in paths) > 0


def test_stored_tables_are_packed_whatever_the_session_says(spark, store):
    own = replace(store, spark=spark.newSession())
    own.spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    own.write("silver", "packed", own.spark.range(5))
    files = [urlparse(f).path for f in own.read("silver", "packed").inputFiles()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
