"""Data-quality audit. Every check is a lazy frame; only enforcement runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DataQualityError(RuntimeError):
    """At least one check has violations."""


def _rows() -> Column:
    return F.count(F.lit(1))


def row_count_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, row_count) for all tables in one job."""
    counts = [
        df.agg(_rows().alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)


def pk_null_check(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, key, row_count, null_keys): NULL keys reveal a wrong schema."""
    checks = [
        df.agg(_rows().alias("row_count"), F.count_if(F.col(key).isNull()).alias("null_keys")).select(
            F.lit(name).alias("table"), F.lit(key).alias("key"), "row_count", "null_keys"
        )
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.union, checks)


def duplicate_key_check(df: DataFrame, key: str) -> DataFrame:
    """One row: how many values of ``key`` occur more than once."""
    repeated = df.groupBy(key).agg(_rows().alias("n")).where(F.col("n") > 1)
    return repeated.agg(_rows().alias("duplicate_keys"))


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: distinct child keys missing from the parent, and their rows.

    Child rows are counted per key before the anti join, so the join never
    sees a key twice. A NULL key refers to no parent and is not an orphan.
    """
    referenced = child.where(F.col(key).isNotNull()).groupBy(key).agg(_rows().alias("n"))
    missing = referenced.join(parent.select(key), key, "left_anti")
    return missing.agg(
        _rows().alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")
    )


def expansion_check(packed: DataFrame, exploded: DataFrame) -> DataFrame:
    """One row: row counts before and after an explode."""
    counts = {"bronze_rows": packed, "silver_rows": exploded}
    return packed.sparkSession.range(1).select(
        *(df.agg(_rows()).scalar().alias(name) for name, df in counts.items())
    )


def profile(df: DataFrame) -> DataFrame:
    """Per column: rows, NULLs, approximate distinct values, minimum, maximum.

    One pass and one aggregate over the whole table. Maps have neither order
    nor hash, so only their NULLs are counted.
    """

    def measures(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        text = T.StringType()
        if isinstance(field.dataType, T.MapType):
            distinct, low, high = F.lit(None).cast("bigint"), F.lit(None).cast(text), F.lit(None).cast(text)
        else:
            distinct = F.approx_count_distinct(column)
            low, high = F.min(column).cast(text), F.max(column).cast(text)
        return F.struct(
            F.lit(field.name).alias("column"),
            _rows().alias("rows"),
            F.count_if(column.isNull()).alias("nulls"),
            distinct.alias("approx_distinct"),
            low.alias("min_value"),
            high.alias("max_value"),
        )

    return df.agg(F.array(*map(measures, df.schema.fields)).alias("columns")).select(
        F.inline("columns")
    )


def as_checks(audit: DataFrame, label: Column, violations: str) -> DataFrame:
    """An audit in the common (check, violations) form."""
    return audit.select(label.alias("check"), F.col(violations).cast("bigint").alias("violations"))


def observed_checks(spark: SparkSession, metrics: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(check, violations) from what the writing tasks of each table counted:
    a row per table and check, nothing is scanned."""
    found = [(f"{table} {name}", n) for table, own in metrics.items() for name, n in own.items() if name != "rows"]
    return spark.createDataFrame(found, "check string, violations bigint")


def refuse_violations(table: str) -> Callable[[Mapping[str, int]], None]:
    """For :meth:`TableStore.write_observed`: refuse rows that violate a check
    before anyone sees them."""

    def accept(found: Mapping[str, int]) -> None:
        failed = [f"{table} {name}: {n}" for name, n in sorted(found.items()) if name != "rows" and n]
        if failed:
            raise DataQualityError("; ".join(failed))

    return accept


def enforce(checks: DataFrame) -> None:
    """Raise :class:`DataQualityError` naming every check with violations.

    There is one row per check, however many rows violate it.
    """
    failed = checks.where(F.col("violations") > 0).orderBy("check").collect()
    if failed:
        raise DataQualityError("; ".join(f"{row['check']}: {row['violations']}" for row in failed))
