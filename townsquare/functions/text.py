"""Text columns that pack lists, padding and placeholder words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ","


def _no_tokens() -> Column:
    return F.array().cast("array<string>")


def is_filled(text: str | Column) -> Column:
    """True for text with more than spaces in it; NULL for NULL."""
    return F.length(F.trim(text)) > 0


def trimmed(*names: str) -> dict[str, Column]:
    """``withColumns`` argument that strips padding spaces from ``names``."""
    return {name: F.trim(name) for name in names}


def split_trimmed(text: str | Column) -> Column:
    """Comma list to array of trimmed tokens; NULL becomes the empty array.

    Blank tokens are kept, as is the single blank token of the empty string.
    """
    # The lambda matters: F.trim itself would take the element index as its
    # second argument, the set of characters to trim.
    tokens = F.transform(F.split(text, SEPARATOR), lambda token: F.trim(token))
    return F.coalesce(tokens, _no_tokens())


def token_count(text: str | Column, placeholder: str) -> Column:
    """Number of comma-separated tokens; 0 for NULL or the placeholder word."""
    listed = F.nullif(F.col(text) if isinstance(text, str) else text, F.lit(placeholder))
    return F.size(F.coalesce(F.split(listed, SEPARATOR), _no_tokens()))
