"""Frames under SQL names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def register_views(frames: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Make each frame queryable from SQL as ``<prefix><name>``; the names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in frames]
