import pytest

from conftest import rows
from townsquare.sources import (
    ENTITIES,
    landed_frames,
    landing_inventory,
    new_batch_id,
    register_views,
    scan_json,
    source_paths,
    with_lineage,
)


def test_entities_declare_their_key(spark):
    assert set(ENTITIES) == {"business", "review", "user", "checkin", "tip"}
    assert all(entity.key in entity.schema.names for entity in ENTITIES.values())
    assert len(ENTITIES["user"].schema) == 22
    assert all(entity.names == entity.schema.names for entity in ENTITIES.values())


def test_scan_is_permissive(spark, land):
    path = land(
        "business.json",
        {"business_id": "b1", "stars": 4.5, "is_open": 1, "extra": "x"},
        "{not json",
        "",
        {"business_id": "b2", "stars": "4.5", "is_open": 1.0},
        {"business_id": "b3", "attributes": {"A": {"n": 1}, "B": "True"}, "hours": None},
    )
    got = scan_json(spark, "business", path)
    assert rows(got, "business_id", "stars", "is_open") == [
        ("b1", 4.5, 1),
        ("b2", None, None),
        ("b3", None, None),
        (None, None, None),
    ]
    nested = got.where("business_id = 'b3'").first()
    assert nested["attributes"] == {"A": '{"n": 1}', "B": "True"} and nested["hours"] is None
    assert "extra" not in got.columns


def test_lineage_columns(spark, land):
    path = land("tip.json", {"business_id": "b"}, {"business_id": "c"})
    batch = new_batch_id()
    got = with_lineage(scan_json(spark, "tip", path), batch).collect()
    assert {row["_batch_id"] for row in got} == {batch}
    assert all(row["_source_file"].endswith("tip.json") for row in got)
    assert len({row["_ingested_at"] for row in got}) == 1
    assert "_batch_id" not in with_lineage(scan_json(spark, "tip", path)).columns
    assert new_batch_id() != batch


def test_inventory_reads_no_content(spark, land, tmp_path):
    land("in/a.json", "{}")
    land("in/b.json", "{}", "{}")
    found = landing_inventory(spark, str(tmp_path / "in"))
    assert rows(found, "file_name", "bytes") == [("a.json", 3), ("b.json", 6)]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_landed_frames_skips_absent_files(spark, land, tmp_path):
    land("tip.json", "{}")
    paths = source_paths(str(tmp_path))
    assert list(landed_frames(spark, paths)) == ["tip"]
    assert source_paths("/x/", "set_{entity}.json")["tip"] == "/x/set_tip.json"


def test_landed_frames_accepts_folders_and_globs(spark, land, tmp_path):
    land("tip/part-1.json", "{}")
    assert landed_frames(spark, {"tip": str(tmp_path / "tip")})
    assert landed_frames(spark, {"tip": str(tmp_path / "tip" / "*.json")})
    assert not landed_frames(spark, {"tip": str(tmp_path / "tip" / "*.csv")})


def test_register_views(spark):
    register_views({"one": spark.range(1), "two": spark.range(2)}, prefix="v_")
    assert spark.sql("SELECT count(*) FROM v_two").first()[0] == 2


def test_unknown_entity(spark):
    with pytest.raises(KeyError):
        scan_json(spark, "photo", "/nowhere")
