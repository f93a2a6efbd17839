"""Entity registry, landing files and table scans."""

from townsquare.sources.entities import ENTITIES, Entity
from townsquare.sources.landing import (
    landed_frames,
    landing_inventory,
    new_batch_id,
    scan_json,
    source_paths,
    with_lineage,
)
from townsquare.sources.views import register_views

__all__ = [
    "ENTITIES",
    "Entity",
    "landed_frames",
    "landing_inventory",
    "new_batch_id",
    "register_views",
    "scan_json",
    "source_paths",
    "with_lineage",
]
