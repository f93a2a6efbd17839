"""Keyed de-duplication with a reproducible survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_rank_in_key"


def _orderable(field: T.StructField, of: str | None = None) -> Column:
    """A sortable stand-in for a column, or for a field of the struct column
    ``of``. Maps have no order; their sorted entries do."""
    column = F.col(f"`{of}`.`{field.name}`" if of else f"`{field.name}`")
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(column))
    return column


def comes_first(a: str, b: str, fields: Sequence[T.StructField], latest: Sequence[str] = ()) -> Column:
    """Whether :func:`keep_latest` keeps the row in struct column ``a`` rather
    than the one of the same key in ``b``; not so where they are equal.
    ``fields`` are the columns other than the key, in their order."""

    # Structs compare field by field, NULL being the lowest value.
    time_a, time_b = (F.struct(F.lit(0), *(F.col(f"`{side}`.`{name}`") for name in latest)) for side in (a, b))
    rest_a, rest_b = (F.struct(F.lit(0), *(_orderable(f, side) for f in fields if f.name not in latest)) for side in (a, b))
    return (time_a > time_b) | (time_a.eqNullSafe(time_b) & (rest_a < rest_b))


def keep_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by ``latest``, ties settled by all columns.

    The order covers every column, so rows that tie are identical and the
    result does not depend on input order, partitioning or task retries.

    Spark turns ``row_number() = 1`` into a per-task group limit ahead of the
    shuffle: each map task sends at most one row per key, so a key that holds
    a large share of the rows never gathers in one reducer.
    """
    rest = [f for f in df.schema.fields if f.name not in {*keys, *latest}]
    order = [F.col(name).desc_nulls_last() for name in latest]
    order += [_orderable(field).asc_nulls_first() for field in rest]
    if not order:
        return df.dropDuplicates(list(keys))
    in_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(in_key)).where(F.col(_RANK) == 1).drop(_RANK)
