import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from townsquare.config import with_session_conf  # noqa: E402
from townsquare.sources import ENTITIES  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("townsquare-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "5000")
        .config("spark.sql.debug.maxToStringFields", "200")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = with_session_conf(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Build a raw entity frame from dicts; absent fields are NULL."""

    def build(entity, *rows):
        schema = ENTITIES[entity].schema
        values = [tuple(row.get(name) for name in schema.names) for row in rows]
        return spark.createDataFrame(values, schema)

    return build


@pytest.fixture
def land(tmp_path):
    """Write raw lines as a landing file and return its path."""

    def write(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
        path.write_text("\n".join(text) + "\n")
        return str(path)

    return write


def rows(df, *columns):
    """Rows as a sorted list of tuples, for comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def executed_plan(df):
    """Text of the plan Spark ran, AQE decisions included."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
