"""Registered queries: every operator over the supplied tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Mapping
from contextlib import suppress
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.acceptance.adapters import BRONZE_SQL, bronze_frame
from townsquare.config import session_sized_for, shared_dir
from townsquare.operators import in_years, tag_period, trailing_cutoff, zorder_rows
from townsquare.plans import gold, quality, reports, rising
from townsquare.plans.bronze import bronze_rows, ingest_bronze, ingest_observed, stream_rows
from townsquare.plans.changes import refresh_changes, take_back
from townsquare.plans.frames import LazyFrames
from townsquare.plans.profiles import QUANTILES, profile_loads, stored_profile
from townsquare.plans.pipeline import (
    SILVER_TABLES,
    export_gold,
    gold_plans,
    quality_checks,
    run_pipeline,
    silver_plans,
)
from townsquare.plans.silver import rated_review
from townsquare.sinks import TableStore, read_export, run_writes, write_files
from townsquare.sources import (
    ENTITIES,
    new_batch_id,
    register_views,
    scan_json,
    source_paths,
)
from townsquare.streaming import ingest_incremental, stream_table

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds that give rows on the small supplied tables.
RULE = {"window_days": 365, "min_reviews": 5}
WIDE_RULE = {"window_days": 730, "min_reviews": 5}

# Codec of landing files whose names no query compares.
PACKED = "gzip"


class Layers:
    """Bronze, silver and gold frames over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.bronze = LazyFrames(
            {entity: partial(bronze_frame, spark, sf_dir, entity) for entity in BRONZE_SQL}
        )
        self.silver = silver_plans(self.bronze)
        self.gold = gold_plans(self.silver)

    @property
    def rated(self) -> DataFrame:
        """What a report on ratings needs of the reviews."""
        return rated_review(self.bronze["review"])

    def new_store(self, label: str) -> TableStore:
        """An empty table store with databases of its own.

        Results are lazy, so its tables are dropped when the process ends.
        """
        store = TableStore(self.spark, shared_dir(self.spark, label), prefix=f"run_{uuid.uuid4().hex}")
        databases = store.ensure_layers()
        atexit.register(_drop, self.spark, list(databases.values()))
        return store

    def stored_silver(self, store: TableStore, *names: str) -> LazyFrames:
        """Silver tables written to a store once and read from there."""
        run_writes(self.spark, {name: partial(store.write, "silver", name, self.silver[name]) for name in names})
        return LazyFrames({name: partial(store.read, "silver", name) for name in names})

    def land(self, entity: str, path: str, compression: str | None = None) -> str:
        """Write a raw entity as newline-delimited JSON files."""
        self.bronze[entity].write.json(path, compression=compression)
        return path

    def bronze_once(self, store: TableStore, entity: str) -> DataFrame:
        """A raw entity whose joins run once, for queries that land it in parts."""
        path = f"{store.root}/raw-{entity}"
        self.derived(entity).write.parquet(path, compression="zstd")
        return self.spark.read.schema(self.bronze[entity].schema).parquet(path)

    def derived(self, entity: str) -> DataFrame:
        """A raw entity to be written once: what its joins shuffle goes with the write."""
        return bronze_frame(session_sized_for(self.spark, 0), self.sf_dir, entity)


def _drop(spark: SparkSession, databases: list[str]) -> None:
    with suppress(Exception):  # the session may have ended
        for database in databases:
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    """Register a query under its function's name."""
    _QUERIES[build.__name__] = lambda spark, sf_dir: build(Layers(spark, sf_dir))
    return build


def _frame_query(name: str, pick: Callable[[Layers], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: pick(Layers(spark, sf_dir))


# Comparable forms: arrays as text plus size, timestamps as text, maps by key.


def _listed(df: DataFrame, array: str, into: str) -> DataFrame:
    return df.withColumn(into, F.array_join(array, "|")).drop(array)


def _as_text(df: DataFrame, timestamp: str) -> DataFrame:
    return df.withColumn(timestamp, F.col(timestamp).cast("string"))


def _brand(df: DataFrame) -> DataFrame:
    return df.withColumn("attr_brand", F.col("attributes")["Brand"]).drop("attributes", "hours")


# Sources


def _json_roundtrip(layers: Layers, entity: str) -> DataFrame:
    path = layers.land(entity, shared_dir(layers.spark, f"landing-{entity}"))
    scanned = scan_json(layers.spark, entity, path)
    return _brand(scanned) if entity == "business" else scanned


@_query
def bronze_json_roundtrip(layers: Layers) -> DataFrame:
    return _json_roundtrip(layers, "review")


for _entity in ("business", "user", "checkin", "tip"):
    _frame_query(f"bronze_json_{_entity}", lambda layers, e=_entity: _json_roundtrip(layers, e))


@_query
def bronze_lineage(layers: Layers) -> DataFrame:
    path = layers.land("review", shared_dir(layers.spark, "landing-review"))
    store = layers.new_store("bronze-review")
    ingest_bronze(store, "review", scan_json(layers.spark, "review", path), new_batch_id())
    loaded = store.read("bronze", "review")
    batches = loaded.agg(F.count_distinct("_batch_id")).scalar()
    return loaded.select(
        *("review_id", "user_id", "business_id", "stars"),
        F.col("_source_file").endswith(".json").alias("has_source_file"),
        F.col("_ingested_at").isNotNull().alias("has_ingested_at"),
        F.length("_batch_id").alias("batch_id_length"),
        batches.alias("batch_ids"),
    )


@_query
def profile_review(layers: Layers) -> DataFrame:
    return quality.profile(layers.bronze["review"]).drop("approx_distinct")


@_query
def profile_review_distinct(layers: Layers) -> DataFrame:
    """Whether the sketched distinct counts are within 15 % of the exact ones."""
    reviews = layers.bronze["review"]
    exact = reviews.agg(*(F.count_distinct(name).alias(name) for name in reviews.columns))
    listed = exact.select(F.inline(F.array(*(F.struct(F.lit(n).alias("column"), F.col(n).alias("n")) for n in reviews.columns))))
    close = F.abs(F.col("approx_distinct") - F.col("n")) <= 0.15 * F.col("n")
    return quality.profile(reviews).join(listed, "column").select("column", close.alias("within_tolerance"))


@_query
def profile_merged_loads(layers: Layers) -> DataFrame:
    """Profile of the reviews from the stored sketches of a batch load and two incremental ones.

    Counts and extremes are exact. Each row tells whether the merged sketches are close to the exact figures of all rows:
    distinct values within 10 %, quantiles within 2 % of the rows by rank.
    """
    store = layers.new_store("profile-loads")
    rows = layers.bronze_once(store, "review")
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
    rows.where(part == 0).write.json(f"{store.root}/batch", compression=PACKED)
    ingest_bronze(store, "review", scan_json(layers.spark, "review", f"{store.root}/batch"), new_batch_id())
    profile_loads(store, "review")
    for number in (1, 2):
        rows.where(part == number).write.mode("append").json(f"{store.root}/landing", compression=PACKED)
        ingest_incremental(
            *(layers.spark, "review", f"{store.root}/landing", store.name("bronze", stream_table("review")), f"{store.root}/checkpoint"),
            path=f"{store.root}/{stream_table('review')}",
            batch_id=new_batch_id(),
        ).awaitTermination()
        profile_loads(store, "review")
    found = stored_profile(store, "review")
    whole = bronze_rows(store, "review").select(*rows.columns)
    numbers = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType)]
    sketched = {row["column"]: row for row in found.collect()}  # a row per column

    def placed(name: str) -> Column:
        column = F.col(name)
        sides = [
            (F.count_if(column < value) <= (q + 0.02) * F.count(column)) & (F.count_if(column <= value) >= (q - 0.02) * F.count(column))
            for q, value in zip(QUANTILES, sketched[name]["quantiles"], strict=True)
        ]
        return reduce(Column.__and__, sides)

    ranks = whole.agg(*(placed(name).alias(name) for name in numbers)).first()

    def exact(name: str) -> DataFrame:
        """One column at a time: several exact counts in one aggregate would repeat every row for each."""
        values = whole.where(F.col(name).isNotNull()).select(F.xxhash64(name).alias("value")).distinct()
        close = F.abs(F.lit(sketched[name]["approx_distinct"]) - F.count(F.lit(1))) <= 0.1 * F.count(F.lit(1))
        return values.agg(
            F.lit(name).alias("column"), close.alias("distinct_close"), F.lit(ranks[name] if name in numbers else True).alias("quantiles_close")
        )

    return found.drop("approx_distinct", "quantiles").join(reduce(DataFrame.union, map(exact, rows.columns)), "column")


# Sinks


@_query
def write_read_roundtrip(layers: Layers) -> DataFrame:
    store = layers.new_store("fact-checkin")
    store.write("gold", "fact", layers.gold["fact_tip"])
    rows = store.write("gold", "fact", layers.gold["fact_checkin"])  # other rows, other schema
    return store.read("gold", "fact").withColumn("rows_written", F.lit(rows).cast("bigint"))


@_query
def partition_pruned_year(layers: Layers) -> DataFrame:
    store = layers.new_store("fact-review-by-year")
    store.write("gold", "fact_review", layers.gold["fact_review"], partition_by=["review_year"])
    return in_years(store.read("gold", "fact_review"), "1999-07-01", "2000-06-30")


@_query
def clustered_read(layers: Layers) -> DataFrame:
    store = layers.new_store("fact-review-clustered")
    facts = layers.gold["fact_review"]
    store.write(
        "gold",
        "fact_review",
        facts,
        partition_by=["review_year"],
        cluster_by=["business_id"],
        key=["review_id"],
    )
    upper = store.read("gold", "fact_review").where(F.col("business_id") >= "5")
    return upper.groupBy("business_id", "review_year").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("stars").alias("total_stars")
    )


@_query
def zordered_read(layers: Layers) -> DataFrame:
    store = layers.new_store("dim-business-zordered")
    business = layers.stored_silver(store, "business")["business"]
    store.write("gold", "dim_business", gold.dim_business(business), cluster_by=["city", "state"], key=["business_id"])
    small = store.read("gold", "dim_business").where(F.col("state") == "SMALL")
    return small.groupBy("city", "state").agg(
        F.count(F.lit(1)).alias("businesses"), F.min("business_id").alias("first_business")
    )


@_query
def zorder_skipping(layers: Layers) -> DataFrame:
    """Per column: rows with its smallest value, and whether the bounds of the files let a reader skip half of them."""
    business = layers.stored_silver(layers.new_store("dim-business-skipping"), "business")["business"]
    path = shared_dir(layers.spark, "zordered")
    by = ["city", "state"]
    write_files(zorder_rows(gold.dim_business(business), by, partitions=16, key=["business_id"]), path)
    read = layers.spark.read.parquet(path)
    low = {c: read.agg(F.min(c)).scalar() for c in by}
    bounds = [F.min(c).alias(f"min_{c}") for c in by] + [F.count_if(F.col(c) == low[c]).alias(f"n_{c}") for c in by]
    files = read.groupBy(F.input_file_name()).agg(*bounds)

    def of(c: str) -> Column:
        skipped = F.count_if(F.col(f"min_{c}") > low[c])
        return F.struct(F.lit(c).alias("column"), F.sum(f"n_{c}").alias("matching"), (2 * skipped >= F.count(F.lit(1))).alias("skips_half"))

    return files.agg(F.array(*map(of, by)).alias("r")).select(F.inline("r"))


def _content(df: DataFrame, table: str) -> DataFrame:
    """(table, row_count, content): a sum over rows of a hash of all columns."""

    def text(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column * 1_000_000).cast("bigint")
        if isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "|")
        return F.coalesce(column.cast("string"), F.lit("~"))

    digest = F.md5(F.concat_ws("#", *map(text, df.schema.fields)))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.select(number.alias("n")).agg(
        F.lit(table).alias("table"), F.count(F.lit(1)).alias("row_count"), F.sum("n").alias("content")
    )


@_query
def gold_export(layers: Layers) -> DataFrame:
    """Contents of the exported gold tables and the report, and the year folders of the fact."""
    stored = layers.stored_silver(layers.new_store("silver"), *SILVER_TABLES)
    frames = dict(gold_plans(stored))
    frames["rising_star_businesses"] = rising.rising_star(frames["fact_review"], frames["dim_business"], **RULE)
    out = shared_dir(layers.spark, "gold-export")
    export_gold(frames, out)
    exported = read_export(layers.spark, out)
    read = {name: exported[name].select(*df.columns) for name, df in frames.items()}
    years = read["fact_review"].select(F.regexp_extract(F.input_file_name(), "review_year=([^/]*)", 1).alias("y"))
    folders = years.distinct().agg(
        F.lit("fact_review folders").alias("table"), F.count(F.lit(1)).alias("row_count"), F.sum(F.coalesce(F.col("y").try_cast("bigint"), F.lit(0))).alias("content")
    )
    return reduce(DataFrame.union, [_content(df, name) for name, df in read.items()]).union(folders)


# Streaming


def _streamed(layers: Layers, store: TableStore, entity: str) -> DataFrame:
    """Land an entity in two parts, ingest after each and once more at the end."""
    landing = f"{store.root}/landing"
    rows = layers.bronze[entity]
    second = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 1
    for part in (rows.where(~second), rows.where(second), None):
        if part is not None:
            part.write.mode("append").json(landing)
        ingest_incremental(
            layers.spark,
            entity,
            landing,
            table=store.name("bronze", stream_table(entity)),
            checkpoint=f"{store.root}/checkpoint",
            path=f"{store.root}/{stream_table(entity)}",
        ).awaitTermination()
    return bronze_rows(store, entity)


@_query
def stream_bronze_tip(layers: Layers) -> DataFrame:
    return _streamed(layers, layers.new_store("stream-tip"), "tip").select(
        *("user_id", "business_id", "text", "date", "compliment_count"),
        F.col("_source_file").endswith(".json").alias("has_source_file"),
        F.col("_ingested_at").isNotNull().alias("has_ingested_at"),
    )


@_query
def stream_to_gold_tip(layers: Layers) -> DataFrame:
    """Incremental rows through stored silver to the stored fact."""
    store = layers.new_store("stream-gold-tip")
    _streamed(layers, store, "tip")
    store.write("silver", "tip", silver_plans({"tip": bronze_rows(store, "tip")})["tip"])
    store.write("gold", "fact_tip", gold.fact_tip(store.read("silver", "tip")))
    return store.read("gold", "fact_tip")


def _landed(layers: Layers, store: TableStore, entity: str) -> DataFrame:
    return scan_json(layers.spark, entity, layers.land(entity, f"{store.root}/landing/{entity}", PACKED))


def _ingested(layers: Layers, store: TableStore, entity: str, rows: DataFrame, batch_id: str) -> None:
    """Land rows and ingest them as one batch."""
    landing = f"{store.root}/landing-{entity}"
    rows.write.mode("append").json(landing, compression=PACKED)
    ingest_incremental(
        layers.spark,
        entity,
        landing,
        table=store.name("bronze", stream_table(entity)),
        checkpoint=f"{store.root}/checkpoint-{entity}",
        path=f"{store.root}/{stream_table(entity)}",
        batch_id=batch_id,
    ).awaitTermination()


def _refreshed_twice(layers: Layers, entity: str) -> TableStore:
    """An entity that came in two batches, each carried to gold by itself."""
    store = layers.new_store(f"changes-{entity}")
    ingest_bronze(store, "business", _landed(layers, store, "business"), "first")
    rows = layers.bronze_once(store, entity)
    late = F.pmod(F.xxhash64(*rows.columns), F.lit(4)) == 1
    for batch, part in (("early", rows.where(~late)), ("late", rows.where(late))):
        _ingested(layers, store, entity, part, batch)
        refresh_changes(store, **RULE)
    return store


@_query
def incremental_refresh_review(layers: Layers) -> DataFrame:
    """The fact after two batches with a refresh each, which decides touched reviews anew."""
    return _refreshed_twice(layers, "review").read("gold", "fact_review")


@_query
def incremental_refresh_tip(layers: Layers) -> DataFrame:
    return _refreshed_twice(layers, "tip").read("gold", "fact_tip")


@_query
def batch_taken_back(layers: Layers) -> DataFrame:
    """The fact after a batch that displaced reviews and brought new ones, and was taken back."""
    store = layers.new_store("taken-back")
    ingest_bronze(store, "business", _landed(layers, store, "business"), "first")
    _ingested(layers, store, "review", layers.derived("review"), "good")
    refresh_changes(store, **RULE)
    rows = stream_rows(store, "review", ["good"]).select(*layers.bronze["review"].columns)  # as they were landed
    wrong = rows.where("useful < 4").withColumns({"date": F.lit("2001-02-03 04:05:06"), "stars": F.lit(2.0)})
    fresh = rows.where("useful = 4").withColumn("review_id", F.concat(F.lit("new-"), "review_id"))
    _ingested(layers, store, "review", wrong.unionByName(fresh), "wrong")
    refresh_changes(store, **RULE)
    take_back(store, "wrong", **RULE)
    return store.read("gold", "fact_review")


# Silver


@_query
def silver_business(layers: Layers) -> DataFrame:
    counted = _brand(layers.silver["business"]).withColumn("category_count", F.size("category_array"))
    return _listed(counted, "category_array", "category_list")


@_query
def silver_review(layers: Layers) -> DataFrame:
    return _as_text(layers.silver["review"], "review_ts")


@_query
def silver_user(layers: Layers) -> DataFrame:
    counted = layers.silver["user"].withColumn("elite_count", F.size("elite_years"))
    return _listed(counted, "elite_years", "elite_list")


@_query
def silver_checkin(layers: Layers) -> DataFrame:
    return _as_text(layers.silver["checkin"], "checkin_ts")


@_query
def silver_tip(layers: Layers) -> DataFrame:
    return _as_text(layers.silver["tip"], "tip_ts")


_frame_query("silver_business_category", lambda layers: layers.silver["business_category"])


# Gold


@_query
def gold_dim_business(layers: Layers) -> DataFrame:
    return _listed(layers.gold["dim_business"], "category_array", "category_list")


@_query
def gold_dim_user(layers: Layers) -> DataFrame:
    return _listed(layers.gold["dim_user"], "elite_years", "elite_list")


for _table in (
    *("dim_date", "dim_category", "bridge_business_category"),
    *("fact_review", "fact_checkin", "fact_tip"),
):
    _frame_query(f"gold_{_table}", lambda layers, t=_table: layers.gold[t])


@_query
def review_date_span(layers: Layers) -> DataFrame:
    return gold.date_span(layers.silver["review"], "review_date")


# Reports


@_query
def rising_star(layers: Layers) -> DataFrame:
    return rising.rising_star(layers.rated, layers.gold["dim_business"], **RULE)


@_query
def rising_star_sql(layers: Layers) -> DataFrame:
    return rising.rising_star_sql(
        layers.spark, layers.rated, layers.gold["dim_business"], **RULE
    )


@_query
def rising_star_sql_tagged(layers: Layers) -> DataFrame:
    return rising.rising_star_sql(
        layers.spark, layers.rated, layers.silver["business"], null_dates="prior", **RULE
    )


@_query
def rising_star_tagged(layers: Layers) -> DataFrame:
    return rising.rising_star(
        layers.rated, layers.silver["business"], null_dates="prior", **RULE
    )


@_query
def review_periods(layers: Layers) -> DataFrame:
    reviews = layers.silver["review"]
    tagged = tag_period(reviews, "review_date", trailing_cutoff(reviews, "review_date", 365))
    return tagged.groupBy("period").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("stars").alias("total_stars")
    )


@_query
def rising_star_default_rule(layers: Layers) -> DataFrame:
    return rising.rising_star(layers.rated, layers.gold["dim_business"])


@_query
def rising_star_two_years(layers: Layers) -> DataFrame:
    return rising.rising_star(
        layers.rated, layers.gold["dim_business"], window_days=730
    )


@_query
def rising_star_top50(layers: Layers) -> DataFrame:
    return rising.rising_star_short(
        layers.rated, layers.gold["dim_business"], **WIDE_RULE
    )


@_query
def rising_star_daily(layers: Layers) -> DataFrame:
    path = shared_dir(layers.spark, "daily-ratings")
    write_files(rising.daily_ratings(layers.rated), path)
    daily = layers.spark.read.parquet(path)
    return rising.rising_star_daily(daily, layers.gold["dim_business"], **RULE)


@_query
def rising_star_pipeline(layers: Layers) -> DataFrame:
    """The whole run, from landed JSON files to the stored report."""
    paths = source_paths(shared_dir(layers.spark, "landing"))
    for entity, path in paths.items():
        layers.land(entity, path, PACKED)
    store = layers.new_store("pipeline")
    run_pipeline(store, paths, **RULE)
    return store.read("gold", "rising_star_businesses")


@_query
def top_categories(layers: Layers) -> DataFrame:
    return reports.top_categories(layers.gold["bridge_business_category"])


@_query
def reviews_by_year(layers: Layers) -> DataFrame:
    prefix = f"v{uuid.uuid4().hex}_"
    register_views({"fact_review": layers.gold["fact_review"]}, prefix)
    return reports.reviews_by_year(layers.spark.table(f"{prefix}fact_review"))


@_query
def bi_month_over_month(layers: Layers) -> DataFrame:
    return reports.month_over_month(layers.gold["fact_review"], layers.gold["dim_date"])


@_query
def bi_weekend_split(layers: Layers) -> DataFrame:
    return reports.weekend_split(layers.gold["fact_review"], layers.gold["dim_date"])


@_query
def bi_reviews_by_category(layers: Layers) -> DataFrame:
    return reports.reviews_by_category(
        layers.gold["fact_review"], layers.gold["bridge_business_category"]
    )


@_query
def bi_daily_checkins(layers: Layers) -> DataFrame:
    return reports.daily_checkins(layers.gold["fact_checkin"], layers.gold["dim_date"])


# Quality


@_query
def dq_row_counts(layers: Layers) -> DataFrame:
    return quality.row_count_audit(layers.silver)


@_query
def dq_pk_nulls(layers: Layers) -> DataFrame:
    return quality.pk_null_check(
        {name: (layers.bronze[name], entity.key) for name, entity in ENTITIES.items()}
    )


@_query
def dq_duplicate_keys(layers: Layers) -> DataFrame:
    return quality.duplicate_key_check(layers.bronze["review"], "review_id")


@_query
def dq_orphans(layers: Layers) -> DataFrame:
    return quality.orphan_count(layers.silver["review"], layers.silver["business"], "business_id")


@_query
def dq_checkin_expansion(layers: Layers) -> DataFrame:
    return quality.expansion_check(layers.bronze["checkin"], layers.silver["checkin"])


@_query
def dq_observed_keys(layers: Layers) -> DataFrame:
    """Rows and NULL keys per table as the tasks that wrote bronze counted them."""
    store = layers.new_store("observed")
    loads = {name: partial(ingest_observed, store, name, _landed(layers, store, name), "first") for name in ENTITIES}
    found = run_writes(layers.spark, loads)
    rows = [(name, ENTITIES[name].key, m["rows"], m[f"null {ENTITIES[name].key}"]) for name, m in found.items()]
    return layers.spark.createDataFrame(rows, "table string, key string, row_count bigint, null_keys bigint")


@_query
def dq_refused_write(layers: Layers) -> DataFrame:
    """What readers see, and what was counted, after a load with stars out of range was refused."""
    store = layers.new_store("refused")
    store.write("silver", "review", layers.silver["review"], ["review_year"])
    seen: dict[str, int] = {}
    unfit = {"stars": ~F.coalesce(F.col("stars").between(1, 5), F.lit(False))}

    def accept(found: Mapping[str, int]) -> None:
        seen.update(found)
        quality.refuse_violations("review")(found)

    try:
        store.write_observed("silver", "review", layers.bronze["review"], checks=unfit, accept=accept)
    except quality.DataQualityError:
        pass
    visible = store.read("silver", "review").agg(F.count(F.lit(1)).alias("row_count"), F.sum("stars").alias("total_stars"))
    return visible.withColumns({"refused_rows": F.lit(seen["rows"]).cast("bigint"), "violations": F.lit(seen["stars"]).cast("bigint")})


@_query
def dq_checks(layers: Layers) -> DataFrame:
    return quality_checks(layers.silver)


def queries() -> dict[str, Query]:
    """Query name -> function of the session and the table folder."""
    return dict(_QUERIES)
