"""Row expansion of packed text lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.functions.text import SEPARATOR


def explode_tokens(df: DataFrame, packed: str, into: str, keep: Sequence[str]) -> DataFrame:
    """One row per comma-separated token of ``packed``, with columns ``keep``.

    Tokens are trimmed; a NULL list yields no row. The expansion is map-only.
    """
    token = F.explode(F.split(packed, SEPARATOR)).alias(into)
    return df.select(*keep, token).withColumn(into, F.trim(into))
