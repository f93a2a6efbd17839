"""Incremental landing -> bronze with the file stream source."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from townsquare.config import SESSION_CONF
from townsquare.sources.entities import ENTITIES
from townsquare.sources.landing import BATCH_COLUMN, with_lineage


def stream_table(entity: str) -> str:
    """Bronze table of an entity's incremental rows."""
    return f"{entity}_stream"


def ingest_incremental(
    spark: SparkSession,
    entity: str,
    source_dir: str,
    table: str,
    checkpoint: str,
    path: str | None = None,
    max_bytes_per_batch: int | None = None,
    batch_id: str | None = None,
) -> StreamingQuery:
    """Append files not seen before to a bronze table, then stop.

    The checkpoint records the files taken, so a rerun adds nothing and every
    row arrives exactly once. A file replaced under its old name counts as
    seen: changed data needs a new file name. ``max_bytes_per_batch`` splits a
    large backlog into several micro-batches. Duplicates are kept; removing
    them is the silver layer's work. The silver layer reads the tables named
    by :func:`stream_table` together with the batch tables, so a landing file
    belongs to one of the two ways of loading.

    With a ``batch_id`` the rows carry it, in a folder of their own, so that a
    refresh reads the new rows only and a batch can be taken back. A table is
    filled either with batch ids or without.
    """
    reader = spark.readStream.schema(ENTITIES[entity].schema)
    if max_bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    arrivals = with_lineage(reader.json(source_dir), batch_id)
    writer = arrivals.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if path is not None:
        writer = writer.option("path", path)
    if batch_id is not None:
        writer = writer.partitionBy(BATCH_COLUMN)
    writer = writer.option("compression", SESSION_CONF["spark.sql.parquet.compression.codec"])
    return writer.outputMode("append").format("parquet").toTable(table)
