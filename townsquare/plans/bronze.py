"""Raw load: landing files to bronze tables, one to one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.sinks.store import TableStore
from townsquare.sources.entities import ENTITIES
from townsquare.sources.landing import BATCH_COLUMN, with_lineage
from townsquare.streaming.ingest import stream_table


#: batches whose rows count no longer: (batch_id, taken_at)
TAKEN_BACK = "taken_back"


def taken_back(store: TableStore) -> list[str]:
    """Ids of the batches taken back; one row for each time someone did so."""
    if not store.exists("bronze", TAKEN_BACK):
        return []
    return sorted({row["batch_id"] for row in store.read("bronze", TAKEN_BACK).select("batch_id").collect()})


def stream_batches(store: TableStore, entity: str) -> list[str] | None:
    """Ids of the incremental batches that count; None where the rows carry no
    ids. One row per batch reaches the driver."""
    if not store.exists("bronze", stream_table(entity)):
        return []
    rows = store.read("bronze", stream_table(entity))
    if BATCH_COLUMN not in rows.columns:
        return None
    return sorted({row[0] for row in rows.select(BATCH_COLUMN).distinct().collect()}.difference(taken_back(store)))


def stream_rows(store: TableStore, entity: str, batches: Sequence[str] | None) -> DataFrame | None:
    """Incremental rows of the batches, or all where None. The batch id is the
    partition column, so other batches are not read."""
    if not store.exists("bronze", stream_table(entity)):
        return None
    rows = store.read("bronze", stream_table(entity))
    return rows if batches is None else rows.where(F.col(BATCH_COLUMN).isin(list(batches)))


def bronze_rows(store: TableStore, entity: str, batches: Sequence[str] | None = None) -> DataFrame:
    """All loaded rows of an entity that count: the batch table and the
    incremental one, as far as they exist. None of both gives no rows.
    ``batches`` names the incremental batches where the caller knows them."""
    batch = store.read("bronze", entity) if store.exists("bronze", entity) else None
    live = stream_batches(store, entity) if batches is None else batches
    found = [df for df in (batch, stream_rows(store, entity, live)) if df is not None]
    if not found:
        return store.spark.createDataFrame([], ENTITIES[entity].schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def ingest_bronze(store: TableStore, entity: str, landed: DataFrame, batch_id: str) -> int:
    """Replace one bronze table with landed rows; returns the row count.

    Map-only: each task parses its file splits and writes them as Parquet, so
    later layers prune columns and push filters instead of parsing JSON again.
    Rows without a key are counted on the way (``null <key>``).
    """
    return ingest_observed(store, entity, landed, batch_id)["rows"]


def ingest_observed(store: TableStore, entity: str, landed: DataFrame, batch_id: str) -> dict[str, int]:
    """As :func:`ingest_bronze`; ``rows`` and ``null <key>`` as the writing tasks saw them."""
    key = ENTITIES[entity].key
    checks = {f"null {key}": F.col(key).isNull()}
    return store.write_observed("bronze", entity, with_lineage(landed, batch_id), checks=checks, batch=batch_id)
