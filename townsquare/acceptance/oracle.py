"""Reference SQL for the registered queries (DuckDB dialect).

Written separately from the plans: each query is a chain of named relations,
and only those it needs are put in front of it.
"""

from __future__ import annotations

import re

from townsquare.acceptance.adapters import BRONZE_SQL, bronze_duckdb
from townsquare.plans.gold import DIM_BUSINESS, DIM_USER, FACT_CHECKIN, FACT_REVIEW, FACT_TIP
from townsquare.sources import ENTITIES


def _half_up(value: str, places: int) -> str:
    """Rounding of the decimal rendering, half away from zero."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 17)), {places}) AS DOUBLE)"


def _key(date: str) -> str:
    return f"CAST(strftime({date}, '%Y%m%d') AS INTEGER)"


_COMPLIMENTS = [name for name in ENTITIES["user"].names if name.startswith("compliment_")]

_RELATIONS = {f"bronze_{entity}": bronze_duckdb(entity) for entity in BRONZE_SQL}

_RELATIONS |= {
    "silver_business": """
SELECT * EXCLUDE (rn) FROM (
    SELECT business_id, trim(name) AS name, address, trim(city) AS city, trim(state) AS state, postal_code,
           latitude, longitude, stars, review_count, is_open, attr_brand, categories,
           CASE WHEN categories IS NULL THEN CAST([] AS VARCHAR[])
                ELSE list_transform(string_split(categories, ','), lambda x: trim(x)) END AS category_array,
           row_number() OVER (PARTITION BY business_id
               ORDER BY name NULLS FIRST, address NULLS FIRST, city NULLS FIRST, state NULLS FIRST,
                        stars NULLS FIRST, review_count NULLS FIRST, categories NULLS FIRST) AS rn
    FROM bronze_business WHERE business_id IS NOT NULL
) WHERE rn = 1""",
    "silver_business_category": """
SELECT DISTINCT business_id, category
FROM (SELECT business_id, unnest(category_array) AS category FROM silver_business)
WHERE length(trim(category)) > 0""",
    "silver_review": """
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY review_id
               ORDER BY review_ts DESC NULLS LAST, business_id NULLS FIRST, user_id NULLS FIRST, stars NULLS FIRST,
                        useful NULLS FIRST, funny NULLS FIRST, cool NULLS FIRST) AS rn
    FROM (SELECT review_id, business_id, user_id, stars, useful, funny, cool,
                 try_cast(date AS TIMESTAMP) AS review_ts,
                 CAST(try_cast(date AS TIMESTAMP) AS DATE) AS review_date,
                 CAST(year(try_cast(date AS TIMESTAMP)) AS INTEGER) AS review_year
          FROM bronze_review
          WHERE review_id IS NOT NULL AND business_id IS NOT NULL AND stars BETWEEN 1 AND 5)
) WHERE rn = 1""",
    "silver_user": """
SELECT * EXCLUDE (rn) FROM (
    SELECT *, len(elite_years) > 0 AS is_elite,
           row_number() OVER (PARTITION BY user_id
               ORDER BY name NULLS FIRST, review_count NULLS FIRST, useful NULLS FIRST, funny NULLS FIRST) AS rn
    FROM (SELECT user_id, name, review_count, useful, funny, cool, fans, average_stars,
                 try_cast(substr(yelping_since, 1, 10) AS DATE) AS yelping_since_date,
                 CASE WHEN elite IS NOT NULL AND length(trim(elite)) > 0
                      THEN list_transform(string_split(elite, ','), lambda x: trim(x))
                      ELSE CAST([] AS VARCHAR[]) END AS elite_years,
                 CAST(CASE WHEN friends IS NULL OR friends = 'None' THEN 0
                      ELSE len(string_split(friends, ',')) END AS INTEGER) AS friend_count
          FROM bronze_user WHERE user_id IS NOT NULL)
) WHERE rn = 1""",
    "silver_checkin": """
SELECT business_id, checkin_ts, CAST(checkin_ts AS DATE) AS checkin_date
FROM (SELECT business_id, try_cast(trim(token) AS TIMESTAMP) AS checkin_ts
      FROM (SELECT business_id, unnest(string_split(date, ',')) AS token
            FROM bronze_checkin WHERE business_id IS NOT NULL))
WHERE checkin_ts IS NOT NULL""",
    "silver_tip": """
SELECT user_id, business_id, text, compliment_count, try_cast(date AS TIMESTAMP) AS tip_ts,
       CAST(try_cast(date AS TIMESTAMP) AS DATE) AS tip_date
FROM bronze_tip WHERE business_id IS NOT NULL""",
    "dim_date": f"""
SELECT date, {_key("date")} AS date_key, CAST(year(date) AS INTEGER) AS year,
       CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month,
       monthname(date) AS month_name, CAST(day(date) AS INTEGER) AS day, dayname(date) AS day_of_week,
       CAST(weekofyear(date) AS INTEGER) AS week_of_year, dayofweek(date) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT review_date AS d FROM silver_review
            UNION ALL SELECT tip_date FROM silver_tip
            UNION ALL SELECT checkin_date FROM silver_checkin))""",
    "dim_business": """
SELECT business_id, name, address, city, state, postal_code, latitude, longitude,
       stars AS avg_stars_alltime, review_count AS review_count_alltime, is_open, category_array
FROM silver_business""",
    "dim_user": """
SELECT user_id, name, yelping_since_date, review_count AS review_count_alltime,
       average_stars AS avg_stars_given, fans, friend_count, is_elite, elite_years
FROM silver_user""",
    "dim_category": """
SELECT category, sha256(category)[1:12] AS category_key
FROM (SELECT DISTINCT category FROM silver_business_category)""",
    "bridge": "SELECT business_id, category FROM silver_business_category",
    "fact_review": f"""
SELECT review_id, business_id, user_id, {_key("review_date")} AS date_key, review_date, review_year,
       stars, useful, funny, cool
FROM silver_review""",
    "fact_checkin": f"""
SELECT business_id, {_key("checkin_date")} AS date_key, checkin_date, count(*) AS checkin_count
FROM silver_checkin GROUP BY business_id, checkin_date""",
    "month_reviews": """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       (SELECT count(*) FROM fact_review WHERE date_trunc('month', review_date) = d) AS reviews
FROM (SELECT unnest(generate_series(CAST(date_trunc('month', min(date)) AS DATE), max(date), INTERVAL 1 MONTH)) AS d FROM dim_date)""",
    "fact_tip": f"""
SELECT business_id, user_id, {_key("tip_date")} AS date_key, tip_date, compliment_count FROM silver_tip""",
}


def _with_relations(text: str) -> str:
    """Prefix ``text`` with the relations it refers to, directly or not."""
    needed: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        new = (words & _RELATIONS.keys()) - needed
        needed |= new
        pending += [_RELATIONS[name] for name in new]
    chain = ",\n".join(f"{name} AS ({_RELATIONS[name]})" for name in _RELATIONS if name in needed)
    return f"WITH {chain}\n{text}" if chain else text


def _rising(window_days: int, min_reviews: int, undated_is_prior: bool = False) -> str:
    prior = "review_date IS NULL OR review_date < cutoff" if undated_is_prior else "review_date < cutoff"
    return f"""
SELECT m.business_id, b.name, n AS reviews_past_year,
       {_half_up("recent", 2)} AS avg_rating_past_year,
       {_half_up("earlier", 2)} AS avg_rating_prior,
       {_half_up("recent - earlier", 2)} AS rating_improvement
FROM (SELECT business_id,
             sum(CASE WHEN review_date >= cutoff THEN 1 ELSE 0 END)::BIGINT AS n,
             avg(CASE WHEN review_date >= cutoff THEN stars END) AS recent,
             avg(CASE WHEN {prior} THEN stars END) AS earlier
      FROM fact_review, (SELECT max(review_date) - {window_days} AS cutoff FROM fact_review)
      GROUP BY business_id) AS m
JOIN dim_business AS b ON b.business_id = m.business_id
WHERE n >= {min_reviews} AND earlier IS NOT NULL AND recent >= earlier + 1.0"""


_RISING = _rising(365, 5)

_REVIEW_COLUMNS = "review_id, business_id, user_id, stars, useful, funny, cool"

_BRONZE_OUT = {
    "business": "SELECT * FROM bronze_business",
    "review": "SELECT * FROM bronze_review",
    "user": "SELECT *, {} FROM bronze_user".format(
        ", ".join(f"CAST(NULL AS BIGINT) AS {name}" for name in _COMPLIMENTS)
    ),
    "checkin": "SELECT * FROM bronze_checkin",
    "tip": "SELECT * FROM bronze_tip",
}


def _profile_rows(relation: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(*) - count({c}) AS nulls, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM {relation}"
        for c in columns
    )


def _count_rows(relation: str, label: str, key: str) -> str:
    return (
        f"SELECT '{label}' AS \"table\", '{key}' AS \"key\", count(*) AS row_count, "
        f"count(*) - count({key}) AS null_keys FROM {relation}"
    )


_DOUBLES = {
    "latitude", "longitude", "avg_stars_alltime", "avg_stars_given", "stars",
    "avg_rating_past_year", "avg_rating_prior", "rating_improvement",
}
_ARRAYS = {"category_array", "elite_years"}
_REPORT = ("business_id", "name", "reviews_past_year", "avg_rating_past_year", "avg_rating_prior", "rating_improvement")


def _names(columns: tuple[str, ...]) -> list[str]:
    return [column.rpartition(" AS ")[2] for column in columns]


def _content(table: str, relation: str, columns) -> str:
    """Row count and a sum over rows of a hash of all columns."""

    def text(name: str) -> str:
        if name in _DOUBLES:
            name = f"CAST(round({name} * 1000000) AS BIGINT)"
        elif name in _ARRAYS:
            name = f"array_to_string({name}, '|')"
        return f"coalesce(CAST({name} AS VARCHAR), '~')"

    digest = f"md5(concat_ws('#', {', '.join(map(text, columns))}))"
    return (
        f"SELECT '{table}' AS \"table\", count(*) AS row_count, "
        f"CAST(sum(CAST('0x' || substr({digest}, 1, 8) AS BIGINT)) AS BIGINT) AS content FROM {relation}"
    )


_PLAIN = {
    # Sources
    "bronze_json_roundtrip": _BRONZE_OUT["review"],
    **{f"bronze_json_{e}": text for e, text in _BRONZE_OUT.items() if e != "review"},
    "bronze_lineage": """
SELECT review_id, user_id, business_id, stars, true AS has_source_file, true AS has_ingested_at,
       CAST(36 AS INTEGER) AS batch_id_length, CAST(1 AS BIGINT) AS batch_ids
FROM bronze_review""",
    "profile_review": _profile_rows(
        "bronze_review",
        ("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "text", "date"),
    ),
    "profile_review_distinct": " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", true AS within_tolerance" for name in ENTITIES["review"].names
    ),
    "profile_merged_loads": "SELECT *, true AS distinct_close, true AS quantiles_close FROM ("
    + _profile_rows("bronze_review", tuple(ENTITIES["review"].names))
    + ")",
    # Sinks
    "write_read_roundtrip": """
SELECT business_id, date_key, checkin_date, checkin_count,
       (SELECT count(*) FROM fact_checkin) AS rows_written
FROM fact_checkin""",
    "partition_pruned_year": f"""
SELECT {_REVIEW_COLUMNS}, date_key, review_date, review_year FROM fact_review
WHERE review_date BETWEEN DATE '1999-07-01' AND DATE '2000-06-30'""",
    "clustered_read": """
SELECT business_id, review_year, count(*) AS reviews, sum(stars) AS total_stars FROM fact_review
WHERE business_id >= '5' GROUP BY business_id, review_year""",
    "zordered_read": """
SELECT city, state, count(*) AS businesses, min(business_id) AS first_business FROM dim_business
WHERE state = 'SMALL' GROUP BY city, state""",
    "stream_bronze_tip": "SELECT *, true AS has_source_file, true AS has_ingested_at FROM bronze_tip",
    "stream_to_gold_tip": "SELECT * FROM fact_tip",
    "gold_export": " UNION ALL ".join(
        _content(table, relation, columns)
        for table, (relation, columns) in {
            "dim_date": ("dim_date", ("date", *"date_key year quarter month month_name day day_of_week week_of_year is_weekend".split())),
            "dim_business": ("dim_business", _names(DIM_BUSINESS)),
            "dim_user": ("dim_user", _names(DIM_USER)),
            "dim_category": ("dim_category", ("category", "category_key")),
            "bridge_business_category": ("bridge", ("business_id", "category")),
            "fact_review": ("fact_review", FACT_REVIEW),
            "fact_checkin": ("fact_checkin", FACT_CHECKIN),
            "fact_tip": ("fact_tip", FACT_TIP),
            "rising_star_businesses": (f"({_RISING})", _REPORT),
        }.items()
    )
    + """ UNION ALL SELECT 'fact_review folders', count(*), CAST(sum(coalesce(review_year, 0)) AS BIGINT)
          FROM (SELECT DISTINCT review_year FROM fact_review)""",
    # Silver
    "silver_business": """
SELECT business_id, name, address, city, state, postal_code, latitude, longitude, stars, review_count, is_open,
       attr_brand, categories, array_to_string(category_array, '|') AS category_list,
       CAST(len(category_array) AS INTEGER) AS category_count
FROM silver_business""",
    "silver_business_category": "SELECT business_id, category FROM silver_business_category",
    "silver_review": f"""
SELECT {_REVIEW_COLUMNS}, CAST(review_ts AS VARCHAR) AS review_ts, review_date, review_year FROM silver_review""",
    "silver_user": """
SELECT user_id, name, review_count, useful, funny, cool, fans, average_stars, yelping_since_date,
       array_to_string(elite_years, '|') AS elite_list, CAST(len(elite_years) AS INTEGER) AS elite_count,
       is_elite, friend_count
FROM silver_user""",
    "silver_checkin": "SELECT business_id, CAST(checkin_ts AS VARCHAR) AS checkin_ts, checkin_date FROM silver_checkin",
    "silver_tip": """
SELECT user_id, business_id, text, compliment_count, CAST(tip_ts AS VARCHAR) AS tip_ts, tip_date FROM silver_tip""",
    # Gold
    "gold_dim_date": "SELECT * FROM dim_date",
    "gold_dim_business": """
SELECT * EXCLUDE (category_array), array_to_string(category_array, '|') AS category_list FROM dim_business""",
    "gold_dim_user": """
SELECT * EXCLUDE (elite_years), array_to_string(elite_years, '|') AS elite_list FROM dim_user""",
    "gold_dim_category": "SELECT * FROM dim_category",
    "gold_bridge_business_category": "SELECT * FROM bridge",
    "gold_fact_review": "SELECT * FROM fact_review",
    "gold_fact_checkin": "SELECT * FROM fact_checkin",
    "gold_fact_tip": "SELECT * FROM fact_tip",
    "zorder_skipping": """
SELECT 'city' AS "column", count(*) AS matching, true AS skips_half FROM dim_business WHERE city = (SELECT min(city) FROM dim_business)
UNION ALL SELECT 'state', count(*), true FROM dim_business WHERE state = (SELECT min(state) FROM dim_business)""",
    "incremental_refresh_review": "SELECT * FROM fact_review",
    "incremental_refresh_tip": "SELECT * FROM fact_tip",
    "batch_taken_back": "SELECT * FROM fact_review",
    "review_date_span": "SELECT min(review_date) AS min_date, max(review_date) AS max_date FROM silver_review",
    # Reports
    "rising_star": _RISING,
    "rising_star_sql": _RISING,
    "rising_star_sql_tagged": _rising(365, 5, undated_is_prior=True),
    "rising_star_tagged": _rising(365, 5, undated_is_prior=True),
    "review_periods": """
SELECT CASE WHEN review_date >= (SELECT max(review_date) - 365 FROM silver_review) THEN 'past_year' ELSE 'prior'
       END AS period, count(*) AS reviews, sum(stars) AS total_stars
FROM silver_review GROUP BY period""",
    "rising_star_default_rule": _rising(365, 10),
    "rising_star_two_years": _rising(730, 10),
    "rising_star_daily": _RISING,
    "rising_star_pipeline": _RISING,
    "rising_star_top50": f"""
SELECT business_id, name, reviews_past_year AS reviews_py, avg_rating_past_year AS avg_past_year,
       avg_rating_prior AS avg_prior, rating_improvement AS improvement
FROM ({_rising(730, 5)})
ORDER BY improvement DESC, reviews_py DESC, business_id LIMIT 50""",
    "top_categories": """
SELECT category, count(*) AS n_businesses FROM bridge GROUP BY category
ORDER BY n_businesses DESC, category LIMIT 10""",
    "reviews_by_year": f"""
SELECT review_year, count(*) AS reviews, {_half_up("avg(stars)", 3)} AS avg_stars
FROM fact_review GROUP BY review_year""",
    "bi_month_over_month": """
SELECT m.year, m.month, m.reviews, p.reviews AS previous_reviews, m.reviews - p.reviews AS change
FROM month_reviews m LEFT JOIN month_reviews p
  ON make_date(p.year, p.month, 1) = make_date(m.year, m.month, 1) - INTERVAL 1 MONTH""",
    "bi_weekend_split": f"""
SELECT d.is_weekend, count(*) AS reviews, {_half_up("avg(f.stars)", 3)} AS avg_stars
FROM fact_review f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.is_weekend""",
    "bi_reviews_by_category": f"""
SELECT b.category, count(*) AS reviews, {_half_up("avg(f.stars)", 3)} AS avg_stars
FROM fact_review f JOIN bridge b ON f.business_id = b.business_id GROUP BY b.category""",
    "bi_daily_checkins": """
SELECT d.date, d.day_of_week, CAST(sum(f.checkin_count) AS BIGINT) AS checkins
FROM fact_checkin f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.date, d.day_of_week""",
    # Quality
    "dq_row_counts": " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", count(*) AS row_count FROM silver_{table}"
        for table in ("business", "business_category", "review", "user", "checkin", "tip")
    ),
    "dq_pk_nulls": " UNION ALL ".join(
        _count_rows(f"bronze_{entity}", entity, key)
        for entity, key in {
            "business": "business_id",
            "review": "review_id",
            "user": "user_id",
            "checkin": "business_id",
            "tip": "business_id",
        }.items()
    ),
    "dq_observed_keys": " UNION ALL ".join(
        _count_rows(f"bronze_{entity}", entity, key)
        for entity, key in {
            "business": "business_id",
            "review": "review_id",
            "user": "user_id",
            "checkin": "business_id",
            "tip": "business_id",
        }.items()
    ),
    "dq_refused_write": """
SELECT (SELECT count(*) FROM silver_review) AS row_count, (SELECT sum(stars) FROM silver_review) AS total_stars,
       count(*) AS refused_rows, count(*) FILTER (NOT coalesce(stars BETWEEN 1 AND 5, false)) AS violations
FROM bronze_review""",
    "dq_duplicate_keys": """
SELECT count(*) AS duplicate_keys FROM (SELECT review_id FROM bronze_review GROUP BY review_id HAVING count(*) > 1)""",
    "dq_orphans": """
SELECT count(DISTINCT business_id) AS orphan_keys, count(*) AS orphan_rows FROM silver_review
WHERE business_id NOT IN (SELECT business_id FROM silver_business)""",
    "dq_checkin_expansion": """
SELECT (SELECT count(*) FROM bronze_checkin) AS bronze_rows, (SELECT count(*) FROM silver_checkin) AS silver_rows""",
    "dq_checks": """
SELECT 'business null business_id' AS "check", count(*) AS violations FROM silver_business WHERE business_id IS NULL
UNION ALL SELECT 'review null review_id', count(*) FROM silver_review WHERE review_id IS NULL
UNION ALL SELECT 'user null user_id', count(*) FROM silver_user WHERE user_id IS NULL
UNION ALL SELECT 'checkin null business_id', count(*) FROM silver_checkin WHERE business_id IS NULL
UNION ALL SELECT 'tip null business_id', count(*) FROM silver_tip WHERE business_id IS NULL
UNION ALL SELECT 'category key collisions', count(category_key) - count(DISTINCT category_key) FROM dim_category
UNION ALL SELECT 'reviews of unknown businesses', count(*) FROM silver_review
          WHERE business_id NOT IN (SELECT business_id FROM silver_business)""",
}


def oracle_sql() -> dict[str, str]:
    """Query name -> complete SQL text."""
    return {name: _with_relations(text) for name, text in _PLAIN.items()}
