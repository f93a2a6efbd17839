import os
import uuid

import pytest
from pyspark.errors import StreamingQueryException

from townsquare.streaming import ingest_incremental


@pytest.fixture
def ingest(spark, tmp_path):
    table = f"bronze_tip_{uuid.uuid4().hex}"

    def run(**options):
        query = ingest_incremental(
            *(spark, "tip", str(tmp_path / "in"), table, str(tmp_path / "checkpoint")),
            path=str(tmp_path / "out"),
            **options,
        )
        query.awaitTermination()
        return spark.table(table)

    return run


def test_only_new_files_are_taken(ingest, land):
    land("in/a.json", {"business_id": "a", "text": "x"}, {"business_id": "b"})
    first = ingest()
    assert first.count() == 2
    assert first.columns[-2:] == ["_source_file", "_ingested_at"]
    assert first.where("_source_file LIKE '%a.json' AND _ingested_at IS NOT NULL").count() == 2

    assert ingest().count() == 2  # rerun, nothing new

    land("in/b.json", {"business_id": "c"})
    assert sorted(row["business_id"] for row in ingest().collect()) == ["a", "b", "c"]

    land("in/b.json", {"business_id": "changed"}, {"business_id": "more"})
    assert ingest().count() == 3  # same name, already taken


def test_rows_are_packed_as_stored_tables_are(spark, ingest, land, tmp_path):
    was = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        land("in/a.json", {"business_id": "a"})
        ingest()
        land("in/b.json", {"business_id": "b"})
        assert ingest().count() == 2
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", was)
    files = [p.name for p in (tmp_path / "out").rglob("*.parquet")]
    assert len(files) == 2 and all(name.endswith(".zstd.parquet") for name in files)


def test_backlog_in_several_batches(ingest, land, tmp_path):
    for i in range(4):
        land(f"in/{i}.json", {"business_id": str(i)})
    assert ingest(max_bytes_per_batch=1).count() == 4
    commits = [p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()]
    assert len(commits) == 4


def test_bad_lines_and_duplicates_are_kept(ingest, land):
    land("in/a.json", {"business_id": "a"}, {"business_id": "a"}, "{bad")
    got = ingest()
    assert got.count() == 3 and got.where("business_id IS NULL").count() == 1


def _refusing_folder():
    """An empty folder in which nobody can make files, if there is one."""
    for path in ("/sys/kernel/security", "/sys/kernel/debug", "/sys/kernel/config", "/sys/kernel/tracing"):
        if os.path.isdir(path) and not os.listdir(path):
            return path
    return None


def _states(tmp_path, batch):
    """Whether a batch's files are published and whether its offsets are committed."""
    return (tmp_path / "out" / "_spark_metadata" / batch).exists(), (tmp_path / "checkpoint" / "commits" / batch).exists()


@pytest.mark.skipif(_refusing_folder() is None, reason="needs a folder that refuses files")
@pytest.mark.parametrize("batch_id", [None, "b"])
def test_death_between_files_and_offsets(ingest, land, tmp_path, batch_id):
    """The query dies when the files of a batch are published and its offsets
    cannot be committed; the next run neither repeats nor loses a row."""
    land("in/1.json", {"business_id": "1"}, {"business_id": "1"}, {"business_id": "2"})
    commits = tmp_path / "checkpoint" / "commits"
    commits.parent.mkdir()
    commits.symlink_to(_refusing_folder())
    with pytest.raises(StreamingQueryException):
        ingest(batch_id=batch_id)
    commits.unlink()
    assert _states(tmp_path, "0") == (True, False), "it died between the two"
    land("in/3.json", {"business_id": "3"})
    for _ in range(2):
        assert sorted(row["business_id"] for row in ingest(batch_id=batch_id).collect()) == ["1", "1", "2", "3"]
    assert _states(tmp_path, "0") == (True, True)


def test_offsets_lost_after_several_batches(ingest, land, tmp_path):
    """The same with batches before and a backlog of several batches after."""
    for i in range(3):
        land(f"in/{i}.json", {"business_id": str(i)})
    ingest(max_bytes_per_batch=1)
    for name in ("2", ".2.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    assert _states(tmp_path, "2") == (True, False)
    for i in range(3, 5):
        land(f"in/{i}.json", {"business_id": str(i)})
    assert sorted(row["business_id"] for row in ingest(max_bytes_per_batch=1).collect()) == list("01234")


def test_files_without_a_published_batch_are_not_read(ingest, land, tmp_path):
    """A task's file whose batch was never published (the query died before)
    is no row, and the batch is loaded by the next run."""
    land("in/0.json", {"business_id": "0"})
    ingest()
    (stray,) = (tmp_path / "out").glob("*.parquet")
    (tmp_path / "out" / "part-00000-stray.snappy.parquet").write_bytes(stray.read_bytes())
    land("in/1.json", {"business_id": "1"})
    assert sorted(row["business_id"] for row in ingest().collect()) == ["0", "1"]
