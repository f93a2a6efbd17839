"""Command line: batch pipeline, incremental load, refresh, taking back a batch, export.

    python -m townsquare run --landing /data/in --root /data/lake
    python -m townsquare ingest --entity tip --landing /data/in/tip --root /data/lake
    python -m townsquare refresh --root /data/lake
    python -m townsquare take-back --batch-id ID --root /data/lake
    python -m townsquare export --out /data/out --root /data/lake

Tables are kept in the configured metastore; without one Spark makes a local
metastore in the working folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from townsquare.config import with_session_conf
from townsquare.plans.bronze import stream_batches
from townsquare.plans.changes import refresh_changes, take_back
from townsquare.plans.pipeline import export_gold, gold_layer, refresh, run_pipeline
from townsquare.sinks import Retention, TableStore
from townsquare.sources import ENTITIES, new_batch_id, source_paths
from townsquare.streaming import ingest_incremental, stream_table


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="townsquare")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="landing files to gold, full snapshot")
    run.add_argument("--file-name", default="{entity}.json", help="landing file, folder or glob name")
    run.add_argument("--skip-missing", action="store_true", help="leave out entities without landing files")
    ingest = commands.add_parser("ingest", help="append new files of one entity to bronze")
    ingest.add_argument("--entity", required=True, choices=sorted(ENTITIES))
    ingest.add_argument("--max-bytes-per-batch", type=int)
    again = commands.add_parser("refresh", help="carry what changed in bronze through silver and gold")
    again.add_argument("--full", action="store_true", help="rebuild every table")
    back = commands.add_parser("take-back", help="take back a batch and what was made from it")
    back.add_argument("--batch-id", required=True)
    export = commands.add_parser("export", help="gold tables and the report as Parquet folders")
    export.add_argument("--out", required=True)
    for command in (run, ingest):
        command.add_argument("--landing", required=True)
    for command in (run, again, back):
        command.add_argument("--strict", action="store_true", help="fail on violated quality checks")
        command.add_argument("--keep", type=int, default=2, help="versions of a table whose files stay")
        command.add_argument("--keep-hours", type=float, default=24.0, help="how long replaced files stay at least")
    for command in (run, ingest, again, back, export):
        command.add_argument("--root", required=True, help="shared folder for tables and checkpoints")
        command.add_argument("--prefix", default="reviews", help="database name prefix")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    builder = with_session_conf(SparkSession.builder.appName("townsquare")).enableHiveSupport()
    spark = builder.getOrCreate()
    root = args.root.rstrip("/")
    store = TableStore(spark, root, args.prefix)
    counts: dict[str, int] = {}
    kept = Retention(args.keep, args.keep_hours * 3600) if "keep" in args else None
    if args.command == "run":
        paths = source_paths(args.landing, args.file_name)
        counts = run_pipeline(store, paths, skip_missing=args.skip_missing, strict=args.strict, retention=kept)
    elif args.command == "refresh":
        counts = (refresh if args.full else refresh_changes)(store, args.strict, kept)
    elif args.command == "take-back":
        counts = take_back(store, args.batch_id, args.strict, retention=kept)
    elif args.command == "export":
        counts = export_gold(gold_layer(store), args.out)
    else:
        store.ensure_layers()
        table = stream_table(args.entity)
        batch_id = None if stream_batches(store, args.entity) is None else new_batch_id()  # an old table has no ids
        ingest_incremental(
            spark,
            args.entity,
            args.landing,
            table=store.name("bronze", table),
            checkpoint=f"{root}/checkpoints/{args.entity}",
            path=f"{root}/bronze/{table}",
            max_bytes_per_batch=args.max_bytes_per_batch,
            batch_id=batch_id,
        ).awaitTermination()
        print(f"batch {batch_id}")
    for name, rows in counts.items():
        print(f"{name}: {rows:,} rows")


if __name__ == "__main__":
    main()
