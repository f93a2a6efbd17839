"""Full-snapshot tables in one database per layer, and plain Parquet exports."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from townsquare.config import LAYERS, SESSION_CONF, database_name
from townsquare.operators.layout import cluster_rows, rebalance_rows, zorder_rows


def ensure_layers(spark: SparkSession, prefix: str = "reviews", root: str | None = None) -> dict[str, str]:
    """Create the layer databases that do not exist yet; layer -> full name.

    Their tables lie below ``root``, or in the warehouse without one.
    """
    catalog = spark.catalog.currentCatalog()
    names = {layer: f"{catalog}.{database_name(prefix, layer)}" for layer in LAYERS}
    for layer, name in names.items():
        where = f" LOCATION '{root.rstrip('/')}/{layer}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    return names


def run_writes(spark: SparkSession, writes: Mapping[str, Callable[[], int]]) -> dict[str, int]:
    """Run independent writes at the same time; name -> row count.

    The last tasks of one table then do not leave the cluster idle.
    """
    with ThreadPoolExecutor(max_workers=len(writes) or 1) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(write))
            for name, write in writes.items()
        }
        return {name: future.result() for name, future in running.items()}


def write_files(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write Parquet to ``path`` and return the row count.

    The count is observed by the write's own tasks; nothing is read back.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


_MANIFEST = "manifest"
_MANIFEST_SCHEMA = "export string, name string, path string, rows bigint"


def export_frames(
    frames: Mapping[str, DataFrame], out: str, partition_by: Mapping[str, Sequence[str]] | None = None
) -> dict[str, int]:
    """Export frames as Parquet folders below ``out``; name -> row count.

    Each export has a folder of its own. One file in ``<out>/manifest``, written
    last, makes it the one that :func:`read_export` gives: an export that fails
    leaves the one before as it was, and readers never see a mixture. Folders of
    earlier exports stay until their owner removes them.
    """
    spark, out = SparkSession.active(), out.rstrip("/")
    export = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    writes = {}
    for name, frame in frames.items():
        by = tuple((partition_by or {}).get(name, ()))
        laid_out = rebalance_rows(frame, *by) if by else frame
        writes[name] = partial(write_files, laid_out, f"{out}/{export}/{name}", by)
    counts = run_writes(spark, writes)
    listed = [(export, name, f"{export}/{name}", rows) for name, rows in counts.items()]
    entry = spark.createDataFrame(listed, _MANIFEST_SCHEMA).coalesce(1)  # one file: it is there whole or not at all
    entry.write.mode("append").json(f"{out}/{_MANIFEST}")
    return counts


def read_export(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the newest complete export below ``out``."""
    out = out.rstrip("/")
    listed = spark.read.schema(_MANIFEST_SCHEMA).json(f"{out}/{_MANIFEST}")
    newest = listed.agg(F.max("export")).scalar()
    found = listed.where(F.col("export") == newest).collect()  # a row per table
    return {row["name"]: spark.read.parquet(f"{out}/{row['path']}") for row in found}


_SNAPSHOT = "__snapshot_"
_CONTENTS = "townsquare.contents"
_BATCH = "townsquare.batch"
#: stored tables are read and written again layer by layer, so they are as small as the library's own sessions make them
_CODEC = SESSION_CONF["spark.sql.parquet.compression.codec"]


@dataclass(frozen=True)
class Segment:
    """A snapshot behind a name. With ``values`` it stands for all rows with
    these values of the partition column, in place of any earlier segment's;
    without, its rows are added to theirs."""

    table: str
    values: tuple[object, ...] | None = None


@dataclass(frozen=True)
class Contents:
    """What a name shows: segments in the order they came, the column that
    ``values`` refer to, and what the rows were made from. ``left`` has the
    snapshots shown earlier with the time (ns) they were last shown."""

    segments: tuple[Segment, ...]
    by: str | None = None
    sources: Mapping[str, Sequence[str]] | None = None
    left: Mapping[str, int] = field(default_factory=dict)

    def dump(self) -> str:
        segments = [[s.table, None if s.values is None else list(s.values)] for s in self.segments]
        return json.dumps({"segments": segments, "by": self.by, "sources": self.sources, "left": dict(self.left)})

    @classmethod
    def load(cls, text: str) -> Contents:
        found = json.loads(text)
        segments = tuple(Segment(t, None if v is None else tuple(v)) for t, v in found["segments"])
        return cls(segments, found["by"], found["sources"], found.get("left", {}))

    def names(self) -> list[str]:
        return [s.table for s in self.segments]

    def after(self, old: Contents | None, now: int) -> Contents:
        """These contents with what they and earlier ones took the place of."""
        if old is None:
            return self
        left = {**old.left, **dict.fromkeys(old.names(), now)}
        return replace(self, left={name: at for name, at in left.items() if name not in self.names()})


@dataclass(frozen=True)
class Retention:
    """Which snapshots a refresh leaves: those of the newest ``keep`` versions
    of a name, and those that readers could still get ``least_age`` seconds ago."""

    keep: int = 2
    least_age: float = 24 * 3600.0


def _sql(value: object) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _among(column: str, values: Sequence[object], wanted: bool) -> str:
    """A predicate on a partition column, NULL being a value like others."""
    listed = ", ".join(sorted(_sql(v) for v in values if v is not None))
    has_null = None in values
    if wanted:
        parts = [f"{column} IN ({listed})"] * bool(listed) + [f"{column} IS NULL"] * has_null
        return " OR ".join(parts) or "false"
    if not listed:
        return f"{column} IS NOT NULL" if has_null else "true"
    return f"{column} NOT IN ({listed})" + ("" if has_null else f" OR {column} IS NULL")


@dataclass(frozen=True)
class TableStore:
    """Layer tables below one root folder.

    A write makes a new snapshot table. The name readers use is a view, moved
    to the snapshot by one metastore operation once all files are there: a
    failed write leaves the old rows, and no reader finds the name missing or
    half filled. A running query keeps the files it started on until
    :meth:`drop_old_snapshots`.

    :meth:`replace_partitions` and :meth:`append` write only the rows that
    change: the view then reads several snapshots, each for its own values of
    the partition column, so files of other partitions stay as they are.
    """

    spark: SparkSession
    root: str
    prefix: str = "reviews"

    def ensure_layers(self) -> dict[str, str]:
        return ensure_layers(self.spark, self.prefix, self.root)

    def database(self, layer: str) -> str:
        return f"{self.spark.catalog.currentCatalog()}.{database_name(self.prefix, layer)}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.`{table}`"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database(layer)}.{table}")

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def snapshots(self, layer: str, table: str) -> list[str]:
        """Snapshot tables of a name, oldest first."""
        own = f"{table}{_SNAPSHOT}"
        listed = self.spark.catalog.listTables(self.database(layer), f"{own}*")
        return sorted(t.name for t in listed if t.name.startswith(own.lower()))

    def stored_bytes(self, layer: str, table: str) -> int:
        """Size of the files under a name, from the catalog's statistics,
        which each write records. A table written by others is measured."""
        found = self.contents(layer, table)
        if found:
            return sum(self._recorded_bytes(layer, s.table) for s in found.segments)
        self._record_bytes(layer, table)
        return self._recorded_bytes(layer, table)

    def _record_bytes(self, layer: str, table: str) -> None:
        self.spark.sql(f"ANALYZE TABLE {self.name(layer, table)} COMPUTE STATISTICS NOSCAN")

    def _recorded_bytes(self, layer: str, table: str) -> int:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}")
        size = described.where("col_name = 'Statistics'").first()
        return int(size["data_type"].split(" ")[0]) if size else 0

    def _property(self, layer: str, table: str, key: str) -> str | None:
        listed = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}")
        row = listed.where(F.col("key") == key).first()
        return row["value"] if row else None

    def contents(self, layer: str, table: str) -> Contents | None:
        """The segments behind a name; None where no write made it."""
        if not self.exists(layer, table):
            return None
        text = self._property(layer, table, _CONTENTS)
        return Contents.load(text) if text else None

    def batch_of(self, layer: str, snapshot: str) -> str | None:
        """The batch a snapshot was loaded by."""
        return self._property(layer, snapshot, _BATCH)

    def write(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        key: Sequence[str] = (),
        **more: object,
    ) -> int:
        """Replace a table, schema included, and return its row count; see
        :meth:`write_observed`."""
        return self.write_observed(layer, table, df, partition_by, cluster_by, key, **more)["rows"]

    def write_observed(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        key: Sequence[str] = (),
        *,
        checks: Mapping[str, Column] | None = None,
        accept: Callable[[Mapping[str, int]], None] | None = None,
        batch: str | None = None,
        sources: Mapping[str, Sequence[str]] | None = None,
    ) -> dict[str, int]:
        """Replace a table, schema included; ``rows`` and the violations of
        each check.

        ``cluster_by`` sorts files by one column or Z-orders several;
        ``partition_by`` alone rebalances rows into even files per value.
        ``key`` names unique columns, which then split hot values.

        ``checks`` are conditions that mark a bad row. They are counted by the
        tasks that write, so nothing is read again. ``accept`` sees the counts
        before anyone sees the rows: if it raises, the old rows stay and the
        new files go. ``batch`` and ``sources`` are kept with the table.
        """
        snapshot, found = self._snapshot(layer, table, df, partition_by, cluster_by, key, checks or {}, accept)
        if batch is not None:
            self.spark.sql(f"ALTER TABLE {self.name(layer, snapshot)} SET TBLPROPERTIES ('{_BATCH}' = {_sql(batch)})")
        self._publish(layer, table, Contents((Segment(snapshot),), partition_by[0] if partition_by else None, sources))
        return found

    def replace_partitions(
        self, layer: str, table: str, df: DataFrame, by: str, values: Sequence[object],
        cluster_by: Sequence[str] = (), key: Sequence[str] = (), sources: Mapping[str, Sequence[str]] | None = None,
    ) -> int:
        """Put ``df`` in place of all rows whose ``by`` is one of ``values``
        (NULL may be one), and return its row count. ``df`` must have no other
        values and the table's columns; the table's other files are not
        touched, and readers see old or new rows of all values."""
        old = self.contents(layer, table)
        if old is None or old.by not in (None, by):
            raise ValueError(f"{table} is not stored by {by}")
        snapshot, found = self._snapshot(layer, table, df.select(*self.read(layer, table).columns), [by], cluster_by, key, {}, None)
        kept = [s for s in old.segments if s.values is None or not set(s.values) <= set(values)]
        self._publish(layer, table, Contents((*kept, Segment(snapshot, tuple(values))), by, sources))
        return found["rows"]

    def append(self, layer: str, table: str, df: DataFrame, sources: Mapping[str, Sequence[str]] | None = None) -> int:
        """Add rows to a table in files of their own; returns their number."""
        old = self.contents(layer, table)
        if old is None:
            raise ValueError(f"{table} is not stored")
        snapshot, found = self._snapshot(layer, table, df.select(*self.read(layer, table).columns), [old.by] if old.by else [], (), (), {}, None)
        self._publish(layer, table, Contents((*old.segments, Segment(snapshot)), old.by, sources))
        return found["rows"]

    def _snapshot(
        self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str],
        key: Sequence[str], checks: Mapping[str, Column], accept: Callable[[Mapping[str, int]], None] | None,
    ) -> tuple[str, dict[str, int]]:
        """A new snapshot table with rows and violations; gone again where it is not accepted."""
        if partition_by and cluster_by:
            df = cluster_rows(df, [*partition_by, *cluster_by], key=key)
        elif len(cluster_by) > 1:
            df = zorder_rows(df, cluster_by, key=key)
        elif cluster_by:
            df = cluster_rows(df, cluster_by, key=key)
        elif partition_by:
            df = rebalance_rows(df, *partition_by)
        snapshot = f"{table}{_SNAPSHOT}{time.time_ns():020d}_{uuid.uuid4().hex}"
        seen = Observation()
        counted = [F.count_if(bad).alias(f"check {name}") for name, bad in checks.items()]
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counted).write.format("parquet").option("compression", _CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.name(layer, snapshot))
        found = {name.removeprefix("check "): n for name, n in seen.get.items()}
        try:
            if accept:
                accept(found)
        except Exception:
            self.spark.sql(f"DROP TABLE {self.name(layer, snapshot)}")
            raise
        self._record_bytes(layer, snapshot)
        return snapshot, found

    def _publish(self, layer: str, table: str, contents: Contents) -> None:
        """Point the name at segments, by one metastore operation."""
        contents = contents.after(self.contents(layer, table), time.time_ns())
        there = {name.lower() for name in self.snapshots(layer, table)} if contents.left else set()
        contents = replace(contents, left={name: at for name, at in contents.left.items() if name.lower() in there})
        parts, first = [], self.name(layer, contents.segments[0].table)
        columns = ", ".join(f"`{c}`" for c in self.spark.table(first).columns)
        for i, segment in enumerate(contents.segments):
            lost = {v for later in contents.segments[i + 1 :] for v in later.values or ()}
            kept = [] if segment.values is None else [_among(contents.by, segment.values, True)]
            kept += [_among(contents.by, sorted(lost, key=str), False)] if lost else []
            where = " WHERE " + " AND ".join(f"({x})" for x in kept) if kept else ""
            parts.append(f"SELECT {columns} FROM {self.name(layer, segment.table)}{where}")
        properties = f"TBLPROPERTIES ('{_CONTENTS}' = {_sql(contents.dump())})"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, table)} {properties} AS {' UNION ALL '.join(parts)}")

    def keep_sources(self, layer: str, table: str, sources: Mapping[str, Sequence[str]]) -> None:
        """Record what a table is made from; its rows stay as they are."""
        self._publish(layer, table, replace(self.contents(layer, table), sources=sources))

    def show_snapshot(self, layer: str, table: str, snapshot: str) -> None:
        """Point the name back at an earlier snapshot, whole."""
        self._publish(layer, table, Contents((Segment(snapshot),)))

    def drop_old_snapshots(self, layer: str, table: str, keep: int = 1, least_age: float = 0.0) -> list[str]:
        """Drop the snapshots of all but the newest ``keep`` versions of a
        name, files included, and return their names.

        What the name shows always stays, and so does what it showed
        ``least_age`` seconds ago or later, so that queries that started then
        find their files. A snapshot no version shows (its write failed, or
        has not published it yet) goes by the time it was made.
        """
        now = time.time_ns()
        contents = self.contents(layer, table)
        shown = {name.lower() for name in contents.names()}
        left = {name.lower(): at for name, at in contents.left.items()}
        versions = sorted(set(left.values()), reverse=True)[: max(keep - 1, 0)]
        old = []
        for snapshot in self.snapshots(layer, table):
            since = left.get(snapshot, int(snapshot.rpartition(_SNAPSHOT)[2].split("_")[0]))
            if snapshot not in shown and since not in versions and now - since >= least_age * 1e9:
                old.append(snapshot)
        for snapshot in old:
            self.spark.sql(f"DROP TABLE {self.name(layer, snapshot)}")
        return old

    def retain(self, retention: Retention, layers: Sequence[str] = ("silver", "gold")) -> dict[str, list[str]]:
        """Drop old snapshots of every name in the layers; ``layer.table`` ->
        dropped ones. Bronze is left out because taking a batch back needs its
        earlier loads."""
        dropped = {}
        for layer in layers:
            listed = [t.name.split(_SNAPSHOT)[0] for t in self.spark.catalog.listTables(self.database(layer)) if _SNAPSHOT in t.name]
            for table in sorted({name for name in listed if listed.count(name) > 1}):
                old = self.drop_old_snapshots(layer, table, retention.keep, retention.least_age) if self.contents(layer, table) else []
                if old:
                    dropped[f"{layer}.{table}"] = old
        return dropped
