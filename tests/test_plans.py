"""Plan shapes that matter at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan
from townsquare.acceptance.queries import PACKED, Layers
from townsquare.plans import reports, rising, silver
from townsquare.sinks import write_files
from townsquare.sources import ENTITIES, scan_json

SF_DIR = "/root/testdata/sf0.001"
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A few layer tables as Parquet, read back."""
    root = str(tmp_path_factory.mktemp("stored"))
    layers = Layers(spark, SF_DIR)
    frames = {
        **{"bronze_review": layers.bronze["review"], "bronze_user": layers.bronze["user"]},
        **{"fact_review": layers.gold["fact_review"], "dim_business": layers.gold["dim_business"]},
        **{"dim_date": layers.gold["dim_date"], "bridge": layers.gold["bridge_business_category"]},
    }
    for name, frame in frames.items():
        write_files(frame, f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in frames}


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    before = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    yield
    spark.conf.set(BROADCAST, before)


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_review_scan_is_pruned_and_filtered(stored):
    (scan,) = scans(silver.silver_review(stored["bronze_review"]))
    assert "text:string" not in scan
    for pushed in ("IsNotNull(review_id)", "IsNotNull(business_id)", "GreaterThanOrEqual(stars,1.0)", "LessThanOrEqual(stars,5.0)"):
        assert pushed in scan


def test_friend_lists_stay_out_of_the_shuffle(stored):
    plan = executed_plan(silver.silver_user(stored["bronze_user"]))
    exchanges = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert exchanges and all("friends#" not in line for line in exchanges)


def test_rising_star_reads_three_columns(stored):
    facts = scans(rising.rising_star(stored["fact_review"], stored["dim_business"]))
    schemas = {line.split("ReadSchema: ")[1].strip() for line in facts}
    assert schemas == {
        "struct<business_id:string,review_date:date,stars:double>",
        "struct<review_date:date>",
        "struct<business_id:string,name:string>",
    }


def test_rising_star_reuses_the_grouping_for_the_join(stored, no_broadcast):
    df = rising.rising_star(stored["fact_review"], stored["dim_business"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    by_business = [line for line in plan.splitlines() if "Exchange hashpartitioning(business_id" in line]
    assert len(by_business) == 2  # one per input: the aggregate is not shuffled again
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize(
    "report",
    [
        lambda t: reports.month_over_month(t["fact_review"], t["dim_date"]),
        lambda t: reports.weekend_split(t["fact_review"], t["dim_date"]),
        lambda t: reports.reviews_by_category(t["fact_review"], t["bridge"]),
    ],
)
def test_facts_are_reduced_before_the_join(stored, no_broadcast, report):
    plan = report(stored)._jdf.queryExecution().optimizedPlan().toString()
    fact = plan.index("Relation [review_id")
    below_join = plan[plan.rindex("Join ", 0, fact) : fact]
    assert "Aggregate [" in below_join


def test_hot_key_reaches_reducers_preaggregated(spark):
    """A third of the rows on one key: no reducer gets more than one row of
    that key per map task."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    raw = spark.range(0, 60000, 1, 4).select(
        hot.alias("review_id"),
        F.lit("b").alias("business_id"),
        F.lit("u").alias("user_id"),
        (1 + F.col("id") % 5).cast("double").alias("stars"),
        *(F.lit(0).cast("long").alias(c) for c in ("useful", "funny", "cool")),
        F.lit("2020-01-01 00:00:00").alias("date"),
    )
    reviews = silver.silver_review(raw)
    assert reviews.count() == 40001
    limited = executed_plan(reviews)
    assert limited.index("row_number(), 1, Final") < limited.index("row_number(), 1, Partial")


def test_raw_rows_landed_in_parts_are_joined_once(spark):
    layers = Layers(spark, SF_DIR)
    store = layers.new_store("once")
    once = layers.bronze_once(store, "review")
    assert "Join" not in executed_plan(once)
    assert once.exceptAll(layers.bronze["review"]).isEmpty() and layers.bronze["review"].exceptAll(once).isEmpty()


def test_packed_landing_files_hold_all_rows(spark, tmp_path):
    layers = Layers(spark, SF_DIR)
    path = layers.land("tip", str(tmp_path / "tip"), PACKED)
    assert all(name.endswith(".json.gz") for name in spark.read.text(path).inputFiles())
    assert scan_json(spark, "tip", path).exceptAll(layers.bronze["tip"].select(*ENTITIES["tip"].schema.names)).isEmpty()
    assert scan_json(spark, "tip", path).count() == layers.bronze["tip"].count()
