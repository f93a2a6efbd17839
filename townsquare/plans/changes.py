"""Change-driven maintenance: new and taken-back batches carried through silver and gold.

Every stored table keeps the names of what it was made from. A refresh compares
them with what is there now and redoes only what differs: reviews are decided
anew for the touched keys and only the years whose rows changed are written;
tips and check-ins, which keep repeats, get the new rows in files of their own;
tables whose sources did not change are left alone. A table's rows and the names
of their sources are published by one operation, so a refresh that ended half
way is simply run again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.config import SESSION_CONF, shared_dir
from townsquare.operators import comes_first
from townsquare.plans import gold, silver
from townsquare.plans.bronze import TAKEN_BACK, bronze_rows, stream_batches, stream_rows, taken_back
from townsquare.plans.pipeline import (
    CLUSTERED,
    READS,
    UNIQUE,
    audit_silver,
    build_gold,
    build_report,
    build_silver,
    gold_sources,
    loaded_bytes,
    own_session,
    refresh,
    silver_sources,
)
from townsquare.sinks.store import Retention, TableStore
from townsquare.sources.entities import ENTITIES

#: a table of more segments is written anew as one
MOST_SEGMENTS = 24

YEAR = "review_year"
_DERIVED = ("review_date", YEAR)
_APPENDED = {"checkin": silver.silver_checkin, "tip": silver.silver_tip}


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path, compression=SESSION_CONF["spark.sql.parquet.compression.codec"])
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_years(years: Sequence[int | None]) -> Column:
    """Rows of these partitions; None is the one without a year."""
    known = F.col(YEAR).isin([y for y in years if y is not None])
    return F.coalesce(known, F.lit(False)) | F.col(YEAR).isNull() if None in years else known


def _merge_reviews(store: TableStore, added: list[str], removed: list[str], sources: Mapping[str, list[str]]) -> int:
    """Decide the touched reviews anew and write the years whose rows changed.

    Without removals the old survivor stands for all older rows of its key:
    the order that picks survivors is total, so it meets the newest of the new
    rows. With removals the touched keys are looked up in bronze. Only ids and
    small columns are exchanged, and the rows of each side once.
    """
    store = own_session(store, loaded_bytes(store, "review") + store.stored_bytes("silver", "review"))
    stored = store.read("silver", "review")
    columns = stored.columns
    typed = [f for f in stored.schema.fields if f.name not in _DERIVED]
    touched = _kept(stream_rows(store, "review", [*added, *removed]).select("review_id").where("review_id IS NOT NULL").distinct(), "touched")
    before = stored.join(touched, "review_id", "left_semi")
    if removed:
        valid = silver.valid_reviews(bronze_rows(store, "review", sources["stream"]))
        after, how = silver.latest_reviews(valid.join(touched, "review_id", "left_semi")), "full_outer"
        same = F.struct(*(f"old.{f.name}" for f in typed)).eqNullSafe(F.struct(*(f"new.{f.name}" for f in typed)))
        differs = ~same
    else:
        after, how = silver.latest_reviews(silver.valid_reviews(stream_rows(store, "review", added))), "right_outer"
        differs = F.col("old").isNull() | comes_first("new", "old", [f for f in typed if f.name != "review_id"], ["review_ts"])
    # A row per key on both sides, which lie by key already: no exchange of their own.
    old = before.select("review_id", F.struct(*(f.name for f in typed), YEAR).alias("old"))
    pairs = old.join(after.select("review_id", F.struct(*columns).alias("new")), "review_id", how)
    changed = _kept(pairs.where(differs).select("review_id", F.col("old").isNotNull().alias("stored"), f"old.{YEAR}", "new"), "changed")
    gone, come = changed.where("stored"), changed.where("new IS NOT NULL").select("new.*")
    years = [row[0] for row in gone.select(YEAR).union(come.select(YEAR)).distinct().collect()]  # years there are
    if not years:
        store.keep_sources("silver", "review", sources)
        return 0
    rest = stored.where(_in_years(years)).join(gone.select("review_id"), "review_id", "left_anti")
    return store.replace_partitions("silver", "review", rest.select(*columns).union(come.select(*columns)), YEAR, sorted(years, key=str), sources=sources)


def _refresh_silver(store: TableStore, strict: bool) -> tuple[dict[str, int], dict[str, dict[str, int]]]:
    """Rows written per changed table, and the metrics of tables written as a whole."""
    written: dict[str, int] = {}
    whole = []
    for entity in ENTITIES:
        now, found = silver_sources(store, entity), store.contents("silver", entity)
        was = found.sources if found else None
        if was == now and "unlabelled" not in now:
            continue
        mergeable = was is not None and was["batch"] == now["batch"] and "unlabelled" not in {*was, *now}
        if not mergeable or len(found.segments) >= MOST_SEGMENTS or entity not in {"review", *_APPENDED}:
            whole.append(entity)
            continue
        added, removed = (sorted({*a} - {*b}) for a, b in ((now["stream"], was["stream"]), (was["stream"], now["stream"])))
        if entity == "review":
            written[entity] = _merge_reviews(store, added, removed, now)
        elif removed:
            whole.append(entity)
        else:
            written[entity] = store.append("silver", entity, _APPENDED[entity](stream_rows(store, entity, added)), now)
    metrics = build_silver(store, strict, whole) if whole else {}
    return written | {t: m["rows"] for t, m in metrics.items()}, metrics


def _refresh_gold(store: TableStore) -> dict[str, int]:
    written: dict[str, int] = {}
    whole = []
    for table in READS:
        now, found = gold_sources(store, table), store.contents("gold", table)
        was = found.sources if found else None
        if was == now:
            continue
        source = {"fact_review": "review", "fact_tip": "tip"}.get(table)
        same_base = was and source and was[source][0] == now[source][0]
        if not same_base or len(found.segments) >= MOST_SEGMENTS:
            whole.append(table)
            continue
        new = [s for s in store.contents("silver", source).segments if s.table not in was[source]]
        if table == "fact_review":
            years = sorted({v for s in new for v in s.values}, key=str)
            rows = gold.fact_review(store.read("silver", "review").where(_in_years(years)))
            written[table] = store.replace_partitions("gold", table, rows, YEAR, years, CLUSTERED[table], UNIQUE[table], now)
        else:
            rows = [gold.fact_tip(store.read("silver", s.table)) for s in new]
            for part in rows[1:]:
                rows[0] = rows[0].unionByName(part)
            written[table] = store.append("gold", table, rows[0], now)
    return written | (build_gold(store, whole) if whole else {})


def refresh_changes(
    store: TableStore, strict: bool = False, retention: Retention | None = Retention(), **rising_rule: object
) -> dict[str, int]:
    """Bring silver, gold and the report up to date with bronze; ``layer.table``
    -> rows written, for the tables that changed. The result equals
    :func:`townsquare.plans.pipeline.refresh`.

    Where nothing is stored yet, this is that. Businesses and users, and gold
    tables that aggregate, are written as a whole if their sources changed. An
    ingest must have ended before: a batch id stands for all its rows.
    Snapshots beyond ``retention`` are dropped at the end.
    """
    if not store.exists("gold", "rising_star_businesses"):
        return refresh(store, strict, retention, **rising_rule)
    store = own_session(store)
    written, metrics = _refresh_silver(store, strict)
    counts = {f"silver.{t}": n for t, n in written.items()}
    if written:
        counts["silver.dq_checks"] = audit_silver(store, None, strict)
    made = _refresh_gold(store)
    counts |= {f"gold.{t}": n for t, n in made.items()}
    if {"fact_review", "dim_business"} & made.keys():
        counts["gold.rising_star_businesses"] = build_report(store, **rising_rule)
    if retention:
        store.retain(retention)
    return counts


def take_back(store: TableStore, batch_id: str, strict: bool = False, **rising_rule: object) -> dict[str, int]:
    """Take back what a batch id loaded, and refresh what was made from it.

    A batch table returns to its newest snapshot of another batch, if one is
    left; incremental rows of the batch are ignored from now on and stay in
    their folder. An unknown id is an error. Returns the rows written.
    """
    known = False
    for entity in ENTITIES:
        shown = store.contents("bronze", entity)
        if shown and store.batch_of("bronze", shown.segments[0].table) == batch_id:
            gone = {None, batch_id, *taken_back(store)}
            earlier = [s for s in store.snapshots("bronze", entity) if s < shown.segments[0].table]
            older = [s for s in earlier if store.batch_of("bronze", s) not in gone]
            if not older:
                raise ValueError(f"{entity} has no earlier load to return to")
            store.show_snapshot("bronze", entity, older[-1])
            known = True
        known = known or batch_id in (stream_batches(store, entity) or [])
    if not known and batch_id not in taken_back(store):
        raise ValueError(f"nothing was loaded as {batch_id}")
    row = store.spark.range(1).select(F.lit(batch_id).alias("batch_id"), F.current_timestamp().alias("taken_at"))
    if store.exists("bronze", TAKEN_BACK):
        store.append("bronze", TAKEN_BACK, row)
    else:
        store.write("bronze", TAKEN_BACK, row)
    return refresh_changes(store, strict, **rising_rule)
