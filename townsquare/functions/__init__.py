"""Column expressions shared by the layer plans (built-in functions only)."""

from townsquare.functions.text import is_filled, split_trimmed, token_count, trimmed
from townsquare.functions.time import calendar_columns, date_key, parse_date, parse_timestamp

__all__ = [
    "calendar_columns",
    "date_key",
    "is_filled",
    "parse_date",
    "parse_timestamp",
    "split_trimmed",
    "token_count",
    "trimmed",
]
