"""The five landing entities: key and declared schema.

Schemas are declared, never inferred: inference reads every byte twice and
drifts with the data. Nested objects land as MAP<STRING,STRING>.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Field names and types of the input files.
_BUSINESS = """
    business_id STRING, name STRING, address STRING, city STRING, state STRING,
    postal_code STRING, latitude DOUBLE, longitude DOUBLE, stars DOUBLE,
    review_count LONG, is_open INT, attributes MAP<STRING,STRING>,
    categories STRING, hours MAP<STRING,STRING>
"""
_REVIEW = """
    review_id STRING, user_id STRING, business_id STRING, stars DOUBLE,
    useful LONG, funny LONG, cool LONG, text STRING, date STRING
"""
_USER = """
    user_id STRING, name STRING, review_count LONG, yelping_since STRING,
    friends STRING, useful LONG, funny LONG, cool LONG, fans LONG, elite STRING,
    average_stars DOUBLE, compliment_hot LONG, compliment_more LONG,
    compliment_profile LONG, compliment_cute LONG, compliment_list LONG,
    compliment_note LONG, compliment_plain LONG, compliment_cool LONG,
    compliment_funny LONG, compliment_writer LONG, compliment_photos LONG
"""
_CHECKIN = "business_id STRING, date STRING"
_TIP = "user_id STRING, business_id STRING, text STRING, date STRING, compliment_count LONG"


@dataclass(frozen=True)
class Entity:
    """A landing entity; ``key`` is the column that must not be NULL."""

    name: str
    key: str
    ddl: str

    @property
    def names(self) -> list[str]:
        """Field names; unlike the schema, known without a session."""
        return re.findall(r"(\w+) (?:[A-Z]+)(?:<[^>]*>)?(?:,|\s*$)", self.ddl)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


ENTITIES = {
    entity.name: entity
    for entity in (
        Entity("business", "business_id", _BUSINESS),
        Entity("review", "review_id", _REVIEW),
        Entity("user", "user_id", _USER),
        Entity("checkin", "business_id", _CHECKIN),
        Entity("tip", "business_id", _TIP),
    )
}
