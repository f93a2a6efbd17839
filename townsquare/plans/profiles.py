"""Column profiles kept per load and merged, so that no load is read twice.

A load is a bronze batch table's snapshot or an incremental batch. Its rows are
read once and leave, per column, counts, extremes and two sketches (distinct
values, quantiles) of a few kilobytes. The profile of everything that counts now
merges those rows; a load that was taken back or replaced is left out of the
merge, which needs no scan either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.plans.bronze import stream_batches, stream_rows
from townsquare.sinks.store import TableStore
from townsquare.sources.entities import ENTITIES
from townsquare.sources.landing import BATCH_COLUMN

#: quantiles a profile reports
QUANTILES = (0.25, 0.5, 0.75)

#: a profile table of more segments is written anew as one
MOST_SEGMENTS = 24

_LG_K = 12  # distinct values: relative error about 1.6 %
_K = 400  # quantiles: rank error below 1 %
_EXTREME = "struct<number:double,value:string>"


def _sketch(field: T.StructField) -> Column:
    """Counts, extremes and sketches of one column, as a struct.

    Maps have neither order nor hash, so only their NULLs are counted. Numbers
    are compared as numbers, other values by their text.
    """
    column = F.col(f"`{field.name}`")
    numeric = isinstance(field.dataType, T.NumericType)
    number = column.cast("double") if numeric else F.lit(None).cast("double")
    extreme = F.struct(number.alias("number"), column.cast("string").alias("value"))
    known = F.when(column.isNotNull(), extreme)
    if "map<" in field.dataType.simpleString():
        distinct, known = F.lit(None).cast("binary"), F.lit(None).cast(_EXTREME)
    else:
        distinct = F.hll_sketch_agg(F.when(column.isNotNull(), F.xxhash64(column)), _LG_K)
    return F.struct(
        F.lit(field.name).alias("column"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(column.isNull()).alias("nulls"),
        F.min(known).cast(_EXTREME).alias("low"),
        F.max(known).cast(_EXTREME).alias("high"),
        distinct.alias("distinct_sketch"),
        (F.kll_sketch_agg_double(number, _K) if numeric else F.lit(None).cast("binary")).alias("quantile_sketch"),
    )


def sketch_columns(df: DataFrame, *by: str) -> DataFrame:
    """A row per column (and value of ``by``): ``column``, ``rows``, ``nulls``,
    ``low``, ``high``, ``distinct_sketch``, ``quantile_sketch``.

    One pass with map-side partial sketches, so a ``by`` value with most of the
    rows reaches the exchange as one row per task.
    """
    fields = [field for field in df.schema.fields if field.name not in by]
    return df.groupBy(*by).agg(F.array(*map(_sketch, fields)).alias("columns")).select(*by, F.inline("columns"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """A row per column from rows of :func:`sketch_columns`; can be merged again."""
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min(F.when(F.col("low.value").isNotNull(), F.col("low"))).alias("low"),
        F.max(F.when(F.col("high.value").isNotNull(), F.col("high"))).alias("high"),
        F.when(F.count("distinct_sketch") > 0, F.hll_union_agg("distinct_sketch")).alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", _K).alias("quantile_sketch"),
    )


def read_sketches(sketches: DataFrame) -> DataFrame:
    """``column``, ``rows``, ``nulls``, ``approx_distinct``, ``min_value``,
    ``max_value`` and ``quantiles`` (:data:`QUANTILES`; NULL for columns that
    hold no numbers)."""
    held = F.when(F.col("low.number").isNotNull(), F.col("quantile_sketch"))
    points = F.array(*map(F.lit, QUANTILES))
    return sketches.select(
        *("column", "rows", "nulls"),
        F.hll_sketch_estimate("distinct_sketch").alias("approx_distinct"),
        F.col("low.value").alias("min_value"),
        F.col("high.value").alias("max_value"),
        F.when(held.isNotNull(), F.kll_sketch_get_quantile_double(held, points)).alias("quantiles"),
    )


def profile_table(entity: str) -> str:
    """Bronze table with the sketches of an entity's loads."""
    return f"{entity}_profile"


def _loads(store: TableStore, entity: str) -> tuple[list[str], list[str]]:
    """Loads that count now: the batch table's snapshots and the incremental batches."""
    shown = store.contents("bronze", entity)
    batches = stream_batches(store, entity)
    if batches is None:
        raise ValueError(f"incremental rows of {entity} carry no batch ids")
    return (shown.names() if shown else []), batches


def profile_loads(store: TableStore, entity: str) -> list[str]:
    """Sketch the loads that have no sketches yet; returns their names.

    Only rows of these loads are read: a batch id is the partition column of
    the incremental rows. An ingest must have ended before.
    """
    table, fields = profile_table(entity), ENTITIES[entity].schema.names
    snapshots, batches = _loads(store, entity)
    there = store.contents("bronze", table)
    known = {row[0] for row in store.read("bronze", table).select("load").distinct().collect()} if there else set()
    new = [name for name in (*snapshots, *batches) if name not in known]
    if not new:
        return []
    found = [
        sketch_columns(store.read("bronze", s).select(*fields)).select(F.lit(s).alias("load"), "*") for s in snapshots if s in new
    ]
    added = [b for b in batches if b in new]
    if added:
        rows = stream_rows(store, entity, added).select(F.col(BATCH_COLUMN).alias("load"), *fields)
        found.append(sketch_columns(rows, "load"))
    for more in found[1:]:
        found[0] = found[0].union(more)
    if there is None:
        store.write("bronze", table, found[0])
    elif len(there.segments) < MOST_SEGMENTS:
        store.append("bronze", table, found[0])
    else:
        store.write("bronze", table, store.read("bronze", table).union(found[0]))
    return new


def stored_profile(store: TableStore, entity: str) -> DataFrame:
    """The profile of all loads that count now, from their sketches alone; see
    :func:`read_sketches`. Loads not sketched yet are an error."""
    live = [name for loads in _loads(store, entity) for name in loads]
    sketches = store.read("bronze", profile_table(entity)).where(F.col("load").isin(live))
    missing = set(live) - {row[0] for row in sketches.select("load").distinct().collect()}
    if missing:
        raise ValueError(f"no profile yet of: {', '.join(sorted(missing))}")
    return read_sketches(merge_sketches(sketches))
