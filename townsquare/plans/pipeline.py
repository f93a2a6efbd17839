"""The full run: landing files to bronze, silver, gold and the flagship report."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.config import session_sized_for
from townsquare.plans import gold, quality, rising, silver
from townsquare.plans.bronze import bronze_rows, ingest_bronze, stream_batches
from townsquare.plans.frames import LazyFrames
from townsquare.sinks.store import Retention, TableStore, export_frames, run_writes
from townsquare.sources.entities import ENTITIES
from townsquare.sources.landing import landed_frames, new_batch_id
from townsquare.sources.views import register_views
from townsquare.streaming.ingest import stream_table

# Table layout: partition column and clustering columns by table.
PARTITIONED = {"review": ["review_year"], "fact_review": ["review_year"]}
CLUSTERED = {"fact_review": ["business_id"], "dim_business": ["city", "state"]}
UNIQUE = {"fact_review": ["review_id"], "dim_business": ["business_id"]}

# Stored tables each table is built from.
READS = {
    "dim_date": ("review", "tip", "checkin"), "dim_business": ("business",), "dim_user": ("user",),
    "dim_category": ("business_category",), "bridge_business_category": ("business_category",),
    "fact_review": ("review",), "fact_checkin": ("checkin",), "fact_tip": ("tip",),
}

SILVER_TABLES = ("business", "business_category", "review", "user", "checkin", "tip")


def silver_plans(bronze: Mapping[str, DataFrame]) -> LazyFrames:
    """Silver frames from bronze frames."""
    plans = LazyFrames(
        {
            "business": lambda: silver.silver_business(bronze["business"]),
            "business_category": lambda: silver.silver_business_category(
                plans["business"], unique_businesses=True
            ),
            "review": lambda: silver.silver_review(bronze["review"]),
            "user": lambda: silver.silver_user(bronze["user"]),
            "checkin": lambda: silver.silver_checkin(bronze["checkin"]),
            "tip": lambda: silver.silver_tip(bronze["tip"]),
        }
    )
    return plans


def gold_plans(layer: Mapping[str, DataFrame]) -> LazyFrames:
    """Gold frames from silver frames."""
    return LazyFrames(
        {
            "dim_date": lambda: gold.dim_date(layer["review"], layer["tip"], layer["checkin"]),
            "dim_business": lambda: gold.dim_business(layer["business"]),
            "dim_user": lambda: gold.dim_user(layer["user"]),
            "dim_category": lambda: gold.dim_category(layer["business_category"]),
            "bridge_business_category": lambda: gold.bridge_business_category(
                layer["business_category"]
            ),
            "fact_review": lambda: gold.fact_review(layer["review"]),
            "fact_checkin": lambda: gold.fact_checkin(layer["checkin"]),
            "fact_tip": lambda: gold.fact_tip(layer["tip"]),
        }
    )


def row_comparisons(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check, violations) of the checks that no single row shows."""
    categories = gold.dim_category(tables["business_category"])
    orphans = quality.orphan_count(tables["review"], tables["business"], "business_id")
    collisions = quality.duplicate_key_check(categories, "category_key")
    return quality.as_checks(collisions, F.lit("category key collisions"), "duplicate_keys").union(
        quality.as_checks(orphans, F.lit("reviews of unknown businesses"), "orphan_rows")
    )


def quality_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check, violations) over stored silver tables, for a DQ table or
    :func:`townsquare.plans.quality.enforce`."""
    nulls = quality.pk_null_check({name: (tables[name], entity.key) for name, entity in ENTITIES.items()})
    return quality.as_checks(nulls, F.concat("table", F.lit(" null "), "key"), "null_keys").union(row_comparisons(tables))


def load_bronze(store: TableStore, landed: Mapping[str, DataFrame], batch_id: str) -> dict[str, int]:
    """Load the given entities; entity -> row count.

    :func:`townsquare.sources.landed_frames` leaves out entities without
    landing files.
    """
    loads = {name: partial(ingest_bronze, store, name, frame, batch_id) for name, frame in landed.items()}
    return run_writes(store.spark, loads)


def own_session(store: TableStore, input_bytes: int = 0) -> TableStore:
    """The store in a session of its own, as wide as its input needs."""
    return replace(store, spark=session_sized_for(store.spark, input_bytes))


def _sized_write(
    store: TableStore, layer: str, table: str, build: Callable[[TableStore], DataFrame], input_bytes: int, **more: object
) -> dict[str, int]:
    """Write one table in a session of its own, as wide as its input needs."""
    own = own_session(store, input_bytes)
    layout = (PARTITIONED.get(table, ()), CLUSTERED.get(table, ()), UNIQUE.get(table, ()))
    return own.write_observed(layer, table, build(own), *layout, **more)


def _store_layer(store: TableStore, layer: str, builds: Mapping[str, tuple]) -> dict[str, dict[str, int]]:
    """Store tables at the same time; ``builds`` has the plan, the input bytes
    and what else the write needs of each. Table -> rows and violations."""
    writes = {
        name: partial(_sized_write, store, layer, name, build, size, **more) for name, (build, size, more) in builds.items()
    }
    return run_writes(store.spark, writes)


def _rows(metrics: Mapping[str, Mapping[str, int]]) -> dict[str, int]:
    return {table: found["rows"] for table, found in metrics.items()}


def silver_sources(store: TableStore, entity: str) -> dict[str, list[str]]:
    """What the silver table of an entity is made from: bronze segments and
    incremental batches. ``unlabelled`` marks rows without batch ids."""
    batch = store.contents("bronze", entity)
    stream = stream_batches(store, entity)
    return {"batch": batch.names() if batch else [], "stream": stream or []} | ({"unlabelled": []} if stream is None else {})


def _key_checks(table: str, strict: bool) -> dict[str, object]:
    key = ENTITIES[table].key
    checks = {f"null {key}": F.col(key).isNull()}
    return {"checks": checks, "accept": quality.refuse_violations(table) if strict else None}


def loaded_bytes(store: TableStore, entity: str) -> int:
    """Size of an entity's stored bronze, batch and incremental rows."""
    return sum(store.stored_bytes("bronze", t) for t in (entity, stream_table(entity)) if store.exists("bronze", t))


def build_silver(store: TableStore, strict: bool = False, only: Iterable[str] = ENTITIES) -> dict[str, dict[str, int]]:
    """Store the silver layer from stored bronze, batch and incremental rows
    together; table -> rows and violations, counted by the writing tasks. With
    ``strict``, a table with violations is not replaced.

    The category bridge is derived from the stored business table, so the
    business de-duplication runs once.
    """
    sources = {e: silver_sources(store, e) for e in ENTITIES}

    def rows(own: TableStore, entity: str) -> DataFrame:
        return bronze_rows(own, entity, None if "unlabelled" in sources[entity] else sources[entity]["stream"])

    def plan(name: str) -> Callable[[TableStore], DataFrame]:
        return lambda own: silver_plans(LazyFrames({e: partial(rows, own, e) for e in ENTITIES}))[name]

    builds = {e: (plan(e), loaded_bytes(store, e), {"sources": sources[e]} | _key_checks(e, strict)) for e in only}
    found = _store_layer(store, "silver", builds)
    if "business" in found:
        pairs = lambda own: silver.silver_business_category(own.read("silver", "business"), unique_businesses=True)
        size = store.stored_bytes("silver", "business")
        found |= _store_layer(store, "silver", {"business_category": (pairs, size, {})})
    return found


def silver_layer(store: TableStore) -> LazyFrames:
    """The stored silver tables."""
    return LazyFrames({name: partial(store.read, "silver", name) for name in SILVER_TABLES})


def gold_layer(store: TableStore) -> LazyFrames:
    """The stored gold tables, the report included."""
    names = [*READS, "rising_star_businesses"]
    return LazyFrames({name: partial(store.read, "gold", name) for name in names if store.exists("gold", name)})


def register_layers(store: TableStore, prefix: str = "") -> list[str]:
    """Temp views over the stored silver and gold tables, under
    ``silver_<table>`` and the plain gold names, for SQL in one session."""
    silver_names = register_views(silver_layer(store), f"{prefix}silver_")
    return [*silver_names, *register_views(gold_layer(store), prefix)]


def audit_silver(store: TableStore, metrics: Mapping[str, Mapping[str, int]] | None = None, strict: bool = False) -> int:
    """Store the quality checks on the silver layer; returns their number.

    ``metrics`` are what the writes counted; with them only the checks that
    compare rows with each other (collisions, orphans) read anything.
    """
    layer = silver_layer(store)
    if metrics is None:
        checks = quality_checks(layer)
    else:
        checks = quality.observed_checks(store.spark, metrics).union(row_comparisons(layer))
    stored = store.write("silver", "dq_checks", checks)
    if strict:
        quality.enforce(store.read("silver", "dq_checks"))
    return stored


def gold_sources(store: TableStore, table: str) -> dict[str, list[str]]:
    """The silver segments a gold table is made from."""
    return {name: store.contents("silver", name).names() for name in READS[table]}


def build_gold(store: TableStore, only: Iterable[str] = READS) -> dict[str, int]:
    """Store the gold layer from stored silver; table -> row count."""
    sizes = {name: store.stored_bytes("silver", name) for name in SILVER_TABLES}

    def plan(name: str) -> Callable[[TableStore], DataFrame]:
        return lambda own: gold_plans(silver_layer(own))[name]

    builds = {n: (plan(n), sum(sizes[t] for t in READS[n]), {"sources": gold_sources(store, n)}) for n in only}
    return _rows(_store_layer(store, "gold", builds))


def build_report(store: TableStore, **rising_rule: object) -> int:
    """Store the rising stars; returns their number."""
    report = rising.rising_star(store.read("gold", "fact_review"), store.read("gold", "dim_business"), **rising_rule)
    return store.write("gold", "rising_star_businesses", report)


def refresh(
    store: TableStore, strict: bool = False, retention: Retention | None = Retention(), **rising_rule: object
) -> dict[str, int]:
    """Rebuild silver, checks, gold and the report from what bronze holds now,
    incremental rows included; ``layer.table`` -> rows. With ``strict`` a
    violation ends the run before gold is touched. Snapshots beyond
    ``retention`` are dropped at the end. See
    :func:`townsquare.plans.changes.refresh_changes` for the incremental way."""
    store = own_session(store)
    metrics = build_silver(store, strict)
    counts = {"silver": _rows(metrics)}
    counts["silver"]["dq_checks"] = audit_silver(store, metrics, strict)
    counts["gold"] = build_gold(store)
    counts["gold"]["rising_star_businesses"] = build_report(store, **rising_rule)
    if retention:
        store.retain(retention)
    return {f"{layer}.{name}": n for layer, tables in counts.items() for name, n in tables.items()}


def run_pipeline(
    store: TableStore,
    paths: Mapping[str, str],
    batch_id: str | None = None,
    skip_missing: bool = False,
    strict: bool = False,
    **rising_rule: object,
) -> dict[str, int]:
    """Landing to gold plus the rising-star table; ``layer.table`` -> rows.

    Quality checks land in ``silver.dq_checks``; with ``strict`` a violation
    fails the run (:class:`townsquare.plans.quality.DataQualityError`).
    Each layer is stored once and read back as Parquet, so no step parses the
    landing files again. Shuffles are sized table by table. An entity without
    landing files is an error, or is not loaded where ``skip_missing`` is set.
    """
    store.ensure_layers()
    landed = landed_frames(store.spark, paths)
    missing = ENTITIES.keys() - landed.keys()
    if missing and not skip_missing:
        raise FileNotFoundError(f"no landing files for: {', '.join(sorted(missing))}")
    loaded = load_bronze(store, landed, batch_id or new_batch_id())
    return {f"bronze.{name}": n for name, n in loaded.items()} | refresh(store, strict, **rising_rule)


def export_gold(tables: Mapping[str, DataFrame], out: str) -> dict[str, int]:
    """Gold tables, and any report given with them, as Parquet folders that
    :func:`townsquare.sinks.read_export` finds."""
    return export_frames(tables, out, partition_by=PARTITIONED)
