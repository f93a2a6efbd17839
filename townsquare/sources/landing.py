"""Landing files: inventory, declared-schema JSON scan, lineage columns."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townsquare.sources.entities import ENTITIES


BATCH_COLUMN = "_batch_id"


def new_batch_id() -> str:
    """One id per pipeline run, to audit a load or take it back."""
    return str(uuid.uuid4())


def source_paths(landing: str, file_name: str = "{entity}.json") -> dict[str, str]:
    """Entity -> landing path. A path may be a file, a folder or a glob."""
    return {name: f"{landing.rstrip('/')}/{file_name.format(entity=name)}" for name in ENTITIES}


def scan_json(spark: SparkSession, entity: str, path: str) -> DataFrame:
    """Newline-delimited JSON under the entity's declared schema.

    Permissive: a line that does not parse gives a row of NULLs, a value of
    the wrong type gives NULL, unknown fields are ignored.
    """
    return spark.read.schema(ENTITIES[entity].schema).json(path)


def with_lineage(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Add source file, load time and, where given, the batch id."""
    lineage = {
        "_source_file": F.col("_metadata.file_path"),
        "_ingested_at": F.current_timestamp(),
    }
    if batch_id is not None:
        lineage[BATCH_COLUMN] = F.lit(batch_id)
    return df.withColumns(lineage)


def landing_inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """Files under ``paths`` with their size in bytes and change time.

    File contents are not read: the content column is pruned from the scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def landed_frames(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Scans of the ``paths`` whose file, folder or glob exists. Each path is
    listed once."""
    found = {}
    for entity, path in paths.items():
        try:
            found[entity] = scan_json(spark, entity, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found
