"""Row placement before a write: file sizes and data skipping."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.config import shuffle_width

_ORIGIN = "_origin_task"
_ZKEY = "_zorder_key"


def _row_hash(df: DataFrame) -> Column:
    """Deterministic per-row hash, so that retried tasks place rows alike."""
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*(F.col(f"`{name}`") for name in hashable))


def rebalance_rows(df: DataFrame, *by: str) -> DataFrame:
    """Gather rows by column into evenly sized files.

    AQE merges small partitions and splits large ones to the advisory size, so
    one year (or the NULL year) with most of the rows becomes several files
    written by several tasks.
    """
    return df.hint("rebalance", *by)


def cluster_rows(
    df: DataFrame, by: Sequence[str], partitions: int | None = None, key: Sequence[str] = ()
) -> DataFrame:
    """Range-partition and sort by columns, so each file covers a narrow range.

    Parquet min/max statistics then skip files and row groups. The range key
    ends in a hash (of the unique ``key`` where given, else of the row) and
    the number of the task the row comes from: a value, or a set of identical
    rows, with a large share of the rows is cut into several neighbouring
    files. Both are the same when a task is retried.
    """
    size = () if partitions is None else (partitions,)
    placed = df.withColumn(_ORIGIN, F.spark_partition_id())
    split = F.xxhash64(*key) if key else _row_hash(df)
    ranged = placed.repartitionByRange(*size, *by, split, _ORIGIN)
    return ranged.drop(_ORIGIN).sortWithinPartitions(*by)


def _spread_bits(value: int, columns: int) -> int:
    """Move bit ``i`` of ``value`` to bit ``i * columns``."""
    return sum(((value >> i) & 1) << (i * columns) for i in range(value.bit_length()))


def bits_for(files: int, columns: int) -> int:
    """Bits per column that give every file two cells of the curve at least,
    within the 63 bits of the key."""
    return max(1, min(62 // columns, math.ceil(math.log2(max(2, 2 * files)) / columns)))


def bucket_bounds(df: DataFrame, name: str, buckets: int) -> list[object]:
    """Values that cut the distinct values of a column into even ranges.

    Whole values are compared, as the range partitioner of Spark does; only
    distinct values are exchanged, and one value per range comes back.
    """
    values = df.select(F.col(f"`{name}`").alias("v")).where("v IS NOT NULL").distinct()
    ranges = values.repartitionByRange(buckets, "v").groupBy(F.spark_partition_id()).agg(F.min("v").alias("v"))
    return sorted(row["v"] for row in ranges.collect())[1:]


def bounds_passed(value: Column, bounds: Sequence[object], kind: T.DataType) -> Column:
    """How many of the sorted ``bounds`` are at most ``value``, by binary
    search: as many comparisons per row as the number of bounds has bits. 0 for
    NULL."""
    if not bounds:
        return F.lit(0)
    listed = F.array(*map(F.lit, bounds)).cast(T.ArrayType(kind))
    steps = F.array(*(F.lit(1 << bit) for bit in reversed(range(len(bounds).bit_length()))))

    def take(passed: Column, step: Column) -> Column:
        return F.when(F.get(listed, passed + step - 1) <= value, passed + step).otherwise(passed)

    return F.aggregate(steps, F.lit(0), take)


def with_zorder_key(df: DataFrame, by: Sequence[str], into: str, bits: int = 4) -> DataFrame:
    """Add the interleaved bits of each column's range bucket.

    A column has at most 2**bits buckets. NULLs fall into the lowest one.
    """
    shares = []
    for position, name in enumerate(by):
        bounds = bucket_bounds(df, name, 2**bits)
        spread = F.array(*(F.lit(_spread_bits(bucket, len(by)) << position).cast("bigint") for bucket in range(len(bounds) + 1)))
        passed = bounds_passed(F.col(f"`{name}`"), bounds, df.schema[name].dataType)
        shares.append(F.element_at(spread, passed + 1))
    return df.withColumn(into, reduce(Column.bitwiseOR, shares))


def zorder_rows(
    df: DataFrame,
    by: Sequence[str],
    bits: int | None = None,
    partitions: int | None = None,
    key: Sequence[str] = (),
) -> DataFrame:
    """Cluster rows along a Z-order curve over several columns.

    Unlike a plain sort on the column list, files stay narrow in every one of
    the columns, so filters on any of them skip files. The cells follow the
    number of files unless ``bits`` is given. The bounds are read first, so
    ``df`` should be a projection of stored data.
    """
    files = partitions or shuffle_width(df.sparkSession)  # what the range partitioning below starts from
    keyed = with_zorder_key(df, by, _ZKEY, bits or bits_for(files, len(by)))
    return cluster_rows(keyed, [_ZKEY, *by], partitions, key).drop(_ZKEY)
