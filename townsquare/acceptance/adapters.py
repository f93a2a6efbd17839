"""Supplied tables reshaped into raw entities, as SQL both engines accept.

The adapters plant the dirt the silver layer has to handle: padding, bad and
missing dates, stars out of range, duplicate and missing keys, blank list
tokens. They read whole tables, and every adapter is row-local or a key join,
so it scales with its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BUSINESS_ROW = """
SELECT concat(CASE WHEN p_partkey % 100 = 99 THEN 'moved-' ELSE '' END, cast(p_partkey AS string)) AS business_id,
       concat('  ', p_name, ' ') AS name,
       concat(cast(p_partkey % 997 AS string), ' Elm St') AS address,
       concat(p_brand, ' ') AS city,
       concat(' ', p_type) AS state,
       cast(10000 + p_partkey % 90000 AS string) AS postal_code,
       cast(p_partkey % 180 AS double) - 90 AS latitude,
       cast(p_partkey % 360 AS double) - 180 AS longitude,
       cast(p_size AS double) / 10 AS stars,
       cast(p_size AS bigint) AS review_count,
       cast(p_partkey % 2 AS int) AS is_open,
       p_brand AS attr_brand,
       CASE p_partkey % 10
            WHEN 0 THEN NULL
            WHEN 1 THEN ''
            ELSE concat(p_type, ', ', replace(p_name, ' ', ','), ', , ', p_type)
       END AS categories
FROM {part}
"""

BRONZE_SQL = {
    # Every business comes twice; the new ids of 1 % leave their reviews orphaned.
    "business": f"{_BUSINESS_ROW} UNION ALL {_BUSINESS_ROW}",
    "review": """
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS review_id,
       cast(o_custkey AS string) AS user_id,
       cast(l_partkey AS string) AS business_id,
       CASE cast(floor(l_extendedprice) AS bigint) % 50
            WHEN 0 THEN cast(0 AS double)
            WHEN 1 THEN cast(6 AS double)
            WHEN 2 THEN NULL
            ELSE cast(ceil(l_quantity / 10.0) AS double)
       END AS stars,
       cast(floor(l_extendedprice) AS bigint) % 7 AS useful,
       cast(floor(l_extendedprice) AS bigint) % 5 AS funny,
       cast(floor(l_extendedprice) AS bigint) % 3 AS cool,
       concat(l_returnflag, ' ', l_linestatus) AS text,
       CASE cast(floor(l_extendedprice) AS bigint) % 53
            WHEN 3 THEN 'garbage'
            WHEN 4 THEN NULL
            ELSE substr(cast(l_shipdate AS string), 1, 19)
       END AS date
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
UNION ALL
-- Businesses that rise: bad reviews once, good ones in the last year.
SELECT concat('r-', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)),
       cast(l_suppkey AS string),
       cast(l_partkey AS string),
       CASE WHEN l_orderkey % 2 = 0 THEN cast(5 AS double) ELSE cast(1 AS double) END,
       cast(1 AS bigint),
       cast(2 AS bigint),
       cast(0 AS bigint),
       'rising',
       concat(CASE WHEN l_orderkey % 2 = 0 THEN '2001-09-1' ELSE '1996-03-1' END, cast(l_linenumber AS string), ' 10:00:00')
FROM {lineitem} WHERE l_partkey % 50 = 7
""",
    # The second half repeats every user with a higher review count.
    "user": """
SELECT CASE WHEN c_custkey % 211 = 5 THEN NULL ELSE cast(c_custkey AS string) END AS user_id,
       c_name AS name,
       c_custkey % 90 + again AS review_count,
       CASE c_custkey % 37
            WHEN 5 THEN 'n/a'
            WHEN 6 THEN NULL
            ELSE concat(cast(2005 + c_custkey % 15 AS string), '-0', cast(1 + c_custkey % 9 AS string),
                        '-1', cast(c_custkey % 10 AS string), ' 01:02:03')
       END AS yelping_since,
       CASE c_custkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN NULL WHEN 2 THEN '' ELSE 'u1, u2, u3' END AS friends,
       c_custkey % 6 AS useful,
       c_custkey % 8 AS funny,
       c_custkey % 9 AS cool,
       c_custkey % 11 AS fans,
       CASE c_custkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE '2015, 2016' END AS elite,
       c_acctbal / 2000 AS average_stars
FROM (SELECT *, 0 AS again FROM {customer}
      UNION ALL
      SELECT *, 1 AS again FROM {customer}) AS listed
""",
    # Lists are packed per event, never per user: a busy user would gather in
    # one group.
    "checkin": """
SELECT CASE WHEN event_id % 89 = 7 THEN NULL ELSE cast(user_id AS string) END AS business_id,
       CASE event_id % 6
            WHEN 0 THEN NULL
            WHEN 1 THEN ''
            WHEN 2 THEN t0
            WHEN 3 THEN concat(t0, ', ', t1)
            WHEN 4 THEN concat(t0, ', ', t1, ', ', t2, ',garbage,')
            ELSE concat(t0, ',', t0)
       END AS date
FROM (SELECT event_id, user_id,
             substr(cast(ts AS string), 1, 19) AS t0,
             substr(cast(ts + INTERVAL 1 HOUR AS string), 1, 19) AS t1,
             substr(cast(ts + INTERVAL 26 HOUR AS string), 1, 19) AS t2
      FROM {events}) AS timed
""",
    "tip": """
SELECT cast(user_id AS string) AS user_id,
       CASE WHEN event_id % 31 = 4 THEN NULL ELSE cast(event_id % 50 AS string) END AS business_id,
       concat(event_type, ' ', props) AS text,
       CASE WHEN event_id % 41 = 7 THEN 'soon' ELSE substr(cast(ts AS string), 1, 19) END AS date,
       cast(floor(value) AS bigint) % 4 AS compliment_count
FROM {events}
""",
}

_SOURCE_TABLES = ("lineitem", "orders", "part", "customer", "events")


def bronze_frame(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """A raw entity derived from the tables under ``sf_dir``."""
    text = BRONZE_SQL[entity]
    inputs = {
        table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for table in _SOURCE_TABLES
        if f"{{{table}}}" in text
    }
    frame = spark.sql(text, **inputs)
    if entity == "business":
        # Map syntax differs between engines, so the map is built here.
        attributes = F.create_map(F.lit("Brand"), F.col("attr_brand"))
        frame = frame.withColumn("attributes", attributes).drop("attr_brand")
    return frame


def bronze_duckdb(entity: str) -> str:
    """The adapter as DuckDB SQL over the tables' own names."""
    return BRONZE_SQL[entity].format(**{table: table for table in _SOURCE_TABLES})
