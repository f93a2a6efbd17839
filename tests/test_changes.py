import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from townsquare.plans import changes, quality
from townsquare.plans.bronze import ingest_bronze, ingest_observed
from townsquare.plans.changes import refresh_changes, take_back
from townsquare.plans.pipeline import READS, refresh, run_pipeline
from townsquare.sinks import TableStore
from townsquare.sources import scan_json
from townsquare.streaming import ingest_incremental, stream_table

RULE = {"window_days": 365, "min_reviews": 1}
SILVER = ("business", "business_category", "review", "user", "checkin", "tip")


def review(i, business="a", stars=4.0, date="2020-05-06 07:08:09", **more):
    return {"review_id": f"r{i}", "business_id": business, "user_id": "u", "stars": stars, "useful": 1, "date": date, "text": "t", **more}


@pytest.fixture
def lake(spark, tmp_path, land):
    store = TableStore(spark, str(tmp_path / "tables"), prefix=f"c{uuid.uuid4().hex}")
    store.ensure_layers()

    def ingest(entity, batch, *lines):
        land(f"in-{entity}/{batch}.json", *lines)
        ingest_incremental(
            *(spark, entity, str(tmp_path / f"in-{entity}"), store.name("bronze", stream_table(entity)), str(tmp_path / f"cp-{entity}")),
            path=str(tmp_path / f"stream-{entity}"),
            batch_id=batch,
        ).awaitTermination()

    return store, ingest


def tables(store):
    """All rows of silver and gold, without load times and places."""
    out = {}
    for layer, names in (("silver", SILVER), ("gold", [*READS, "rising_star_businesses"])):
        for name in names:
            df = store.read(layer, name)
            out[name] = rows(df.drop(*(c for c in df.columns if c.startswith("_")), "attributes", "hours"))
    return out


def same_as_rebuilt(store):
    found = tables(store)
    refresh(store, **RULE)
    assert found == tables(store)


def files(store, year):
    return {os.path.basename(f) for f in store.read("silver", "review").where(F.col("review_year").eqNullSafe(F.lit(year))).inputFiles()}


def start(lake):
    store, ingest = lake
    ingest("review", "b1", review(1), review(2, date="2019-01-01 00:00:00"), review(3, date="2018-01-01 00:00:00"), review(4, date="odd"))
    ingest("business", "b1", {"business_id": "a", "name": " x ", "categories": "P, Q"}, {"business_id": "b", "name": "y"})
    ingest("tip", "b1", {"business_id": "a", "user_id": "u", "text": "t", "date": "2020-01-01 00:00:00"})
    ingest("checkin", "b1", {"business_id": "a", "date": "2020-01-01 00:00:00, 2020-01-01 05:00:00"})
    refresh_changes(store, **RULE)
    return store, ingest


def test_only_touched_years_are_written(lake):
    store, ingest = start(lake)
    before = {y: files(store, y) for y in (2020, 2019, 2018, None)}
    ingest("review", "b2", review(2, stars=1.0, date="2020-06-01 00:00:00"), review(3, date="2017-01-01 00:00:00"), review(9, stars=9.0))
    counts = refresh_changes(store, **RULE)
    assert counts["silver.review"] == 2 and counts["gold.fact_review"] == 2  # r2 moved from 2019 to 2020, where r1 is
    assert {"gold.dim_user", "gold.fact_tip", "silver.tip", "gold.dim_business"}.isdisjoint(counts)
    after = {y: files(store, y) for y in before}
    assert after[2018] == before[2018] and after[None] == before[None]  # the older copy of r3 displaced nothing
    assert after[2020] != before[2020] and after[2019] == set()
    same_as_rebuilt(store)


def test_undated_and_repeated_rows(lake):
    store, ingest = start(lake)
    ingest("review", "b2", review(4, date="2015-01-01 00:00:00"), review(5, date=None), review(5, date=None), {"review_id": None}, "{bad")
    refresh_changes(store, **RULE)
    same_as_rebuilt(store)


def test_repeats_of_tips_and_checkins_are_added_once(lake):
    store, ingest = start(lake)
    ingest("tip", "b2", {"business_id": "a", "user_id": "u", "text": "t", "date": "2020-01-01 00:00:00"})
    ingest("checkin", "b2", {"business_id": "a", "date": "2020-01-01 06:00:00"})
    counts = refresh_changes(store, **RULE)
    assert counts["silver.tip"] == counts["gold.fact_tip"] == counts["silver.checkin"] == 1
    assert refresh_changes(store, **RULE) == {}
    same_as_rebuilt(store)


def test_changed_business(lake):
    store, ingest = start(lake)
    ingest("business", "b2", {"business_id": "b", "name": "z", "categories": "R"})
    counts = refresh_changes(store, **RULE)
    assert "silver.business_category" in counts and "gold.bridge_business_category" in counts and "silver.review" not in counts
    same_as_rebuilt(store)


def test_refresh_that_ended_half_way_goes_on(lake, monkeypatch):
    store, ingest = start(lake)
    ingest("review", "b2", review(7, date="2020-07-01 00:00:00"))
    ingest("tip", "b2", {"business_id": "b", "text": "s"})
    with monkeypatch.context() as patch:
        patch.setattr(changes, "_refresh_gold", lambda store: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_changes(store, **RULE)
    counts = refresh_changes(store, **RULE)
    assert counts["gold.fact_review"] == 2 and counts["gold.fact_tip"] == 1 and "silver.tip" not in counts
    same_as_rebuilt(store)


def test_many_segments_become_one(lake, monkeypatch):
    monkeypatch.setattr(changes, "MOST_SEGMENTS", 3)
    store, ingest = start(lake)
    for i in range(4):
        ingest("review", f"m{i}", review(20 + i, date=f"20{10 + i}-01-01 00:00:00"))
        refresh_changes(store, **RULE)
    assert len(store.contents("silver", "review").segments) < 4
    same_as_rebuilt(store)


def test_batch_of_increments_is_taken_back(lake):
    store, ingest = start(lake)
    before = tables(store)
    ingest("review", "b2", review(1, stars=1.0, date="2021-06-01 00:00:00"), review(8))
    ingest("tip", "b2", {"business_id": "b", "text": "s", "date": "2022-01-01 00:00:00"})
    refresh_changes(store, **RULE)
    assert tables(store) != before
    kept = files(store, 2018)
    take_back(store, "b2", **RULE)
    assert tables(store) == before and files(store, 2018) == kept
    assert store.read("bronze", stream_table("review")).where("_batch_id = 'b2'").count() == 2  # for the audit
    take_back(store, "b2", **RULE)  # once more changes nothing
    same_as_rebuilt(store)
    with pytest.raises(ValueError, match="nothing was loaded"):
        take_back(store, "unknown", **RULE)


def test_batch_load_is_taken_back(spark, tmp_path, land):
    store = TableStore(spark, str(tmp_path / "tables"), prefix=f"c{uuid.uuid4().hex}")
    land("a/review.json", review(1), review(2))
    land("b/review.json", review(1, stars=2.0))
    land("a/business.json", {"business_id": "a", "name": "x"})
    run_pipeline(store, {"review": str(tmp_path / "a/review.json"), "business": str(tmp_path / "a/business.json")}, "A", skip_missing=True, **RULE)
    before = tables(store)
    ingest_bronze(store, "review", scan_json(spark, "review", str(tmp_path / "b/review.json")), "B")
    refresh_changes(store, **RULE)
    assert tables(store) != before
    take_back(store, "B", **RULE)
    assert tables(store) == before
    with pytest.raises(ValueError, match="no earlier load"):
        take_back(store, "A", **RULE)


def test_checks_are_counted_while_writing(spark, lake, land):
    store, _ = lake
    found = ingest_observed(store, "review", scan_json(spark, "review", land("x/r.json", review(1), {"stars": 1.0}, "{bad")), "b")
    assert found == {"rows": 3, "null review_id": 2}
    assert rows(quality.observed_checks(spark, {"review": found})) == [("review null review_id", 2)]


def test_refused_write_leaves_the_old_rows(spark, lake):
    store, _ = lake
    store.write("silver", "t", spark.range(3))
    check = {"odd": F.col("id") % 2 == 1}
    with pytest.raises(quality.DataQualityError, match="t odd: 2"):
        store.write_observed("silver", "t", spark.range(5), checks=check, accept=quality.refuse_violations("t"))
    assert store.read("silver", "t").count() == 3 and len(store.snapshots("silver", "t")) == 1
    found = store.write_observed("silver", "t", spark.range(1), checks=check, accept=quality.refuse_violations("t"))
    assert found == {"rows": 1, "odd": 0}


def test_strict_run_fails_before_gold(spark, tmp_path, land):
    store = TableStore(spark, str(tmp_path / "tables"), prefix=f"c{uuid.uuid4().hex}")
    land("in/review.json", review(1, business="nowhere"))
    land("in/business.json", {"business_id": "a", "name": "x"})
    paths = {e: str(tmp_path / f"in/{e}.json") for e in ("review", "business")}
    with pytest.raises(quality.DataQualityError, match="unknown businesses: 1"):
        run_pipeline(store, paths, skip_missing=True, strict=True, **RULE)
    assert not store.exists("gold", "fact_review") and store.exists("silver", "dq_checks")


def test_partitions_replaced_by_value(spark, lake):
    store, _ = lake
    rows_of = lambda *pairs: spark.createDataFrame(pairs, "v string, p string")
    store.write("silver", "t", rows_of(("1", "a"), ("2", "it's"), ("3", None)), ["p"])
    store.replace_partitions("silver", "t", rows_of(("4", "it's"), ("5", "new")), "p", ["it's", "new"])
    assert rows(store.read("silver", "t"), "v", "p") == [("1", "a"), ("3", None), ("4", "it's"), ("5", "new")]
    store.append("silver", "t", rows_of(("6", "a")))
    store.replace_partitions("silver", "t", rows_of(("7", None)), "p", [None, "a"])
    assert rows(store.read("silver", "t"), "v", "p") == [("4", "it's"), ("5", "new"), ("7", None)]
    assert store.drop_old_snapshots("silver", "t") == []  # all are shown
    store.write("silver", "t", rows_of(("8", "x")), ["p"])
    assert len(store.drop_old_snapshots("silver", "t")) == 4


@pytest.mark.parametrize("withdrawn", [False, True])
def test_a_merge_keeps_only_touched_ids_and_what_changed(lake, monkeypatch, withdrawn):
    store, ingest = start(lake)
    ingest("review", "b2", review(1, date="2020-07-01 00:00:00"), review(2, date="2001-01-01 00:00:00"), review(8))
    if withdrawn:
        refresh_changes(store, **RULE)
    kept, keep = {}, changes._kept

    def seen(df, label):
        kept[label] = keep(df, label)
        return kept[label]

    monkeypatch.setattr(changes, "_kept", seen)
    take_back(store, "b2", **RULE) if withdrawn else refresh_changes(store, **RULE)
    assert [*kept] == ["touched", "changed"]
    assert rows(kept["changed"], "review_id") == [("r1",), ("r8",)]
    same_as_rebuilt(store)


def test_a_merge_exchanges_new_and_stored_rows_once(spark, lake, monkeypatch):
    store, ingest = start(lake)
    ingest("review", "b2", review(1, date="2020-07-01 00:00:00"), review(2, date="2001-01-01 00:00:00"), review(8))
    plans, keep = {}, changes._kept

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        kept = keep(df, label)
        if label == "changed":
            assert kept.columns == ["review_id", "stored", "review_year", "new"]  # of a stored row only what finds it
        return kept

    monkeypatch.setattr(changes, "_kept", seen)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        refresh_changes(store, **RULE)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plans["changed"].count("Exchange hashpartitioning(review_id") == 3  # the touched ids, stored rows, new rows


def test_a_merge_settles_ties_as_a_rebuild_does(lake):
    store, ingest = start(lake)
    same_time = [review(30 + i, business="b", user_id="m", useful=5, date="2020-01-01 00:00:00") for i in range(6)]
    ingest("review", "b2", *same_time, review(36, date=None, useful=3), review(37, date=None, useful=3))
    refresh_changes(store, **RULE)
    ingest(
        *("review", "b3", {**same_time[0], "business_id": "a"}, {**same_time[1], "business_id": "c"}, {**same_time[2], "user_id": None}),
        *({**same_time[3], "useful": 4}, {**same_time[3], "useful": None}, same_time[4], {**same_time[5], "stars": 5.0}),
        *(review(36, date=None, useful=2), review(37, date=None, useful=4), review(38, date=None), review(38, date="odd")),
    )
    refresh_changes(store, **RULE)
    found = {row["review_id"]: row for row in store.read("silver", "review").collect()}
    assert found["r30"]["business_id"] == "a" and found["r31"]["business_id"] == "b"
    assert found["r32"]["user_id"] is None and found["r33"]["useful"] is None and found["r35"]["stars"] == 4.0
    assert found["r36"]["useful"] == 2 and found["r37"]["useful"] == 3
    same_as_rebuilt(store)


def shuffled_files(spark):
    listed = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (listed.apply(i).getName() for i in range(listed.size())) if name.startswith("shuffle_")}


@pytest.mark.parametrize("first", [False, True])
def test_a_refresh_leaves_no_shuffle_files(spark, lake, first):
    store, ingest = lake if first else start(lake)
    ingest("business", "b2", {"business_id": "c", "name": "z", "categories": "R"})
    ingest("review", "b2", review(1, date="2020-07-01 00:00:00"), review(2, date="2001-01-01 00:00:00"), review(8))
    held = spark.range(9).repartition(3)  # a frame of the caller's session keeps its shuffle
    held.collect()
    before = shuffled_files(spark)
    refresh_changes(store, **RULE)
    assert shuffled_files(spark) <= before
    assert held.count() == 9
