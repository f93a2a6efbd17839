import uuid

import pytest

from townsquare.__main__ import main
from townsquare.sources import ENTITIES


def test_run_prints_row_counts(spark, land, tmp_path, capsys):
    for entity in ENTITIES:
        land(f"in/set_{entity}.json", {"business_id": "b", "user_id": "u", "review_id": "r", "stars": 3.0, "date": "2020-01-01 00:00:00"})
    prefix = f"m{uuid.uuid4().hex}"
    main(["run", "--landing", str(tmp_path / "in"), "--file-name", "set_{entity}.json", "--root", str(tmp_path / "lake"), "--prefix", prefix])
    printed = capsys.readouterr().out
    assert "bronze.review: 1 rows" in printed and "gold.dim_date: 1 rows" in printed
    assert "gold.rising_star_businesses: 0 rows" in printed


def test_ingest_appends_once(spark, land, tmp_path):
    land("tip/a.json", {"business_id": "a"})
    prefix = f"m{uuid.uuid4().hex}"
    for _ in range(2):
        main(["ingest", "--entity", "tip", "--landing", str(tmp_path / "tip"), "--root", str(tmp_path / "lake"), "--prefix", prefix])
    assert spark.table(f"{prefix}_bronze.tip_stream").count() == 1


def test_unknown_entity_is_refused(capsys):
    with pytest.raises(SystemExit):
        main(["ingest", "--entity", "photo", "--landing", "x", "--root", "y"])
