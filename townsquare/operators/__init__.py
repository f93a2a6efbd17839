"""Frame-level operators the layer plans are composed of."""

from townsquare.operators.dedupe import comes_first, keep_latest
from townsquare.operators.layout import cluster_rows, rebalance_rows, zorder_rows
from townsquare.operators.lists import explode_tokens
from townsquare.operators.periods import (
    in_window,
    in_years,
    period_totals,
    tag_period,
    trailing_cutoff,
)

__all__ = [
    "cluster_rows",
    "comes_first",
    "explode_tokens",
    "in_window",
    "in_years",
    "keep_latest",
    "period_totals",
    "rebalance_rows",
    "tag_period",
    "trailing_cutoff",
    "zorder_rows",
]
