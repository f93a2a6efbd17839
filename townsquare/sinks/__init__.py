"""Layer tables and file exports."""

from townsquare.sinks.store import (
    Contents,
    Retention,
    Segment,
    TableStore,
    ensure_layers,
    export_frames,
    read_export,
    run_writes,
    write_files,
)

__all__ = [
    "Contents",
    "Retention",
    "Segment",
    "TableStore",
    "ensure_layers",
    "export_frames",
    "read_export",
    "run_writes",
    "write_files",
]
