"""The same queries as SQL over the same tables, written from the definitions."""

from __future__ import annotations

_SRC = """
src AS (
  SELECT latitude, longitude, order_date, dispatch_date,
         dispatch_date + to_minutes(CAST(15 + user_id * 7 % 346 AS BIGINT)) AS delivery_date,
         CAST(user_id AS INTEGER) AS customer_id,
         CAST(event_id % 120 AS INTEGER) AS employee_id,
         CAST(event_id % 100 + 1 AS INTEGER) AS quantity_products,
         CAST(event_id AS VARCHAR) AS order_id,
         event_id
  FROM (
    SELECT event_id, user_id,
           CAST(event_id * 91 % 5500 AS DOUBLE) / CAST(1000 AS DOUBLE) AS latitude,
           CAST(event_id * 37 % 6000 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS longitude,
           CAST(date_trunc('second', ts) AS TIMESTAMP) AS order_date,
           CAST(date_trunc('second', ts) AS TIMESTAMP) + to_minutes(CAST(event_id % 59 + 2 AS BIGINT)) AS dispatch_date
    FROM events
  )
)"""

_AREAS = """
areas AS (
  SELECT n_nationkey AS area_id, n_name AS neighborhood, r_name AS comune,
         CAST(n_nationkey % 5 AS DOUBLE) AS x, CAST(n_nationkey // 5 AS DOUBLE) AS y
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_IN_SQUARE = "longitude > x AND longitude < x + 1 AND latitude > y AND latitude < y + 1"

_TIMED = f"""
timed AS (
  SELECT src.*,
         CAST(hour(order_date) AS INTEGER) AS order_hour,
         CAST(minute(order_date) AS INTEGER) AS order_minute,
         CAST(date_diff('second', dispatch_date, delivery_date) AS DOUBLE) / 60 AS time_delivery,
         CASE WHEN hour(order_date) < 12 THEN 'M' ELSE 'T' END AS working_day,
         neighborhood, comune
  FROM src LEFT JOIN areas ON {_IN_SQUARE}
)"""

_WITH_TIMED = f"WITH {_SRC}, {_AREAS}, {_TIMED}"

_ROLLUP = """
SELECT CAST(order_date AS DATE) AS order_date, neighborhood, comune, working_day,
       CAST(sum(quantity_products) AS BIGINT) AS total_quantity,
       count(*) AS order_count,
       round(sum(time_delivery) / count(*), 9) AS average_delivery_time,
       round(sum(latitude) / count(*), 9) AS latitude,
       round(sum(longitude) / count(*), 9) AS longitude
FROM timed {where}
GROUP BY CAST(order_date AS DATE), neighborhood, comune, working_day"""

# Whole minutes add up exactly, so the rounded average comes from integers.
_TIMES_FIVE = """
rolled AS (
  SELECT CAST(order_date AS DATE) AS order_date, neighborhood, comune, working_day,
         CAST(sum(quantity_products) AS BIGINT) AS total_quantity,
         count(*) AS order_count,
         (1000 * CAST(sum(time_delivery) AS BIGINT) + count(*)) // (2 * count(*)) AS hundredths,
         round(sum(latitude) / count(*), 9) AS latitude,
         round(sum(longitude) / count(*), 9) AS longitude
  FROM timed GROUP BY CAST(order_date AS DATE), neighborhood, comune, working_day
)"""


def _area_query(condition: str) -> str:
    return f"""
WITH {_SRC}, {_AREAS},
hits AS (
  SELECT order_id, neighborhood, comune,
         row_number() OVER (PARTITION BY order_id ORDER BY area_id) AS place
  FROM src JOIN areas ON {condition}
)
SELECT src.order_id, latitude, longitude, neighborhood, comune
FROM src LEFT JOIN hits ON src.order_id = hits.order_id AND place = 1"""


# The height of a column of the stairs; a point between two columns is under both.
_STAIR = "(CAST({k} AS BIGINT) * 37 % 512 + 256) / 1024.0::DOUBLE"


ORACLES: dict[str, str] = {
    "ingest_partitions": """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day
FROM events""",
    "parse_orders": f"""
WITH {_SRC}
SELECT latitude, longitude, order_date, dispatch_date, delivery_date, customer_id, employee_id,
       quantity_products, order_id
FROM src""",
    "parse_broken_lines": f"""
WITH {_SRC}
SELECT order_id AS line_id,
       CASE WHEN event_id % 9 IN (0, 1, 2, 5) THEN NULL ELSE latitude END AS latitude,
       CASE WHEN event_id % 9 IN (0, 1, 2) THEN NULL ELSE longitude END AS longitude,
       CASE WHEN event_id % 9 IN (0, 1, 2, 3) THEN NULL ELSE order_date END AS order_date,
       CASE WHEN event_id % 9 IN (0, 1, 2) THEN NULL ELSE dispatch_date END AS dispatch_date,
       CASE WHEN event_id % 9 IN (0, 1, 2) THEN NULL ELSE delivery_date END AS delivery_date,
       CASE WHEN event_id % 9 IN (0, 1, 2, 4) THEN NULL ELSE customer_id END AS customer_id,
       CASE WHEN event_id % 9 IN (0, 1, 2, 6) THEN NULL ELSE employee_id END AS employee_id,
       CASE WHEN event_id % 9 IN (0, 1, 2) THEN NULL ELSE quantity_products END AS quantity_products,
       CASE WHEN event_id % 9 IN (0, 1, 2) THEN NULL ELSE order_id END AS order_id
FROM src""",
    "parse_props": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "drop_incomplete": """
SELECT event_id, event_type, user_id, value FROM events
WHERE event_id % 7 NOT IN (1, 2, 3)
  AND event_type IS NOT NULL AND user_id IS NOT NULL AND value IS NOT NULL""",
    "dedupe_rows": """
SELECT DISTINCT event_type AS value, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp
FROM events WHERE event_id % 11 <> 0 AND event_type IS NOT NULL""",
    "dedupe_by_key": """
SELECT event_id, ts, user_id, event_type, value
FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events
) WHERE place = 1""",
    "derive_times": f"""
WITH {_SRC}
SELECT order_id, CAST(hour(order_date) AS INTEGER) AS order_hour,
       CAST(minute(order_date) AS INTEGER) AS order_minute,
       CAST(date_diff('second', dispatch_date, delivery_date) AS DOUBLE) / 60 AS time_delivery
FROM src""",
    "working_day": f"""
WITH {_SRC}
SELECT order_id, CAST(hour(order_date) AS INTEGER) AS order_hour,
       CASE WHEN hour(order_date) < 12 THEN 'M' ELSE 'T' END AS working_day
FROM src""",
    "enrich_employee": f"""
WITH {_SRC}
SELECT order_id, employee_id, s_name AS employee_name
FROM src LEFT JOIN supplier ON employee_id = s_suppkey""",
    "enrich_customer": f"""
WITH {_SRC}
SELECT order_id, customer_id, c_name AS customer_name
FROM src LEFT JOIN customer ON customer_id = c_custkey""",
    "enrich_both": f"""
WITH {_SRC}
SELECT order_id, employee_id, customer_id, s_name AS employee_name, c_name AS customer_name
FROM src LEFT JOIN supplier ON employee_id = s_suppkey
LEFT JOIN customer ON customer_id = c_custkey""",
    "enrich_repeated_key": f"""
WITH {_SRC},
staff AS (
  SELECT s_suppkey, s_name FROM supplier
  UNION ALL SELECT s_suppkey, s_name || ' bis' FROM supplier WHERE s_suppkey % 10 = 0
)
SELECT order_id, employee_id, s_name AS employee_name
FROM src LEFT JOIN staff ON employee_id = s_suppkey""",
    "area_lookup": _area_query(_IN_SQUARE),
    "area_first_of_overlapping": _area_query(
        "longitude > x AND longitude < x + 2 AND latitude > y AND latitude < y + 2"
    ),
    "area_triangles": _area_query(
        "longitude > x AND latitude > y AND (latitude - y) + (longitude - (x + 1)) < 0"
    ),
    "area_holes": _area_query(
        f"{_IN_SQUARE} AND NOT (longitude BETWEEN x + 0.25 AND x + 0.75"
        " AND latitude BETWEEN y + 0.25 AND y + 0.75)"
    ),
    "area_multipolygons": _area_query(
        f"{_IN_SQUARE} AND (longitude < x + 0.375 OR longitude > x + 0.625)"
    ),
    "area_many_vertices": _area_query(
        f"""{_IN_SQUARE} AND latitude - y <
        CASE WHEN (longitude - x) * 1024 = floor((longitude - x) * 1024)
             THEN least({_STAIR.format(k="floor((longitude - x) * 1024)")}, {_STAIR.format(k="floor((longitude - x) * 1024) - 1")})
             ELSE {_STAIR.format(k="floor((longitude - x) * 1024)")} END"""
    ),
    "delivery_range_check": f"""
{_WITH_TIMED},
expected AS (
  SELECT n_nationkey AS area_id, CAST(n_nationkey % 4 * 15 + 15 AS INTEGER) AS t_min,
         CAST(n_nationkey % 4 * 60 + 120 AS INTEGER) AS t_max
  FROM nation WHERE n_nationkey % 6 <> 5
)
SELECT order_id, areas.area_id, time_delivery, t_min, t_max,
       time_delivery >= t_min AND time_delivery <= t_max AS in_range
FROM timed LEFT JOIN areas ON {_IN_SQUARE} LEFT JOIN expected ON areas.area_id = expected.area_id""",
    "incremental_slice": """
SELECT event_id, ts, value FROM events
WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
    "progress_mark": """
SELECT coalesce(max(ts), TIMESTAMP '2024-01-01 00:00:00') AS processed_date FROM events""",
    "row_count": "SELECT count(*) AS row_count FROM events",
    "silver_orders": f"""
{_WITH_TIMED}
SELECT latitude, longitude, order_date, dispatch_date, delivery_date, customer_id, employee_id,
       quantity_products, order_id, order_hour, order_minute, time_delivery, working_day,
       TIMESTAMP '2024-02-01 00:00:00' AS processed_date,
       s_name AS employee_name, c_name AS customer_name, neighborhood, comune
FROM timed LEFT JOIN supplier ON employee_id = s_suppkey
LEFT JOIN customer ON customer_id = c_custkey""",
    "daily_sales": _WITH_TIMED + _ROLLUP.format(where=""),
    "rollup_affected_days": _WITH_TIMED
    + _ROLLUP.format(
        where="""WHERE CAST(order_date AS DATE) IN (
  SELECT CAST(order_date AS DATE) FROM src WHERE quantity_products > 97 AND hour(order_date) = 3)"""
    ),
    "merge_partials": _WITH_TIMED + _ROLLUP.format(where=""),
    "merge_replaced_slice": _WITH_TIMED + _ROLLUP.format(where=""),
    "gold_contract": f"""
{_WITH_TIMED}, {_TIMES_FIVE}
SELECT order_date, neighborhood, comune, working_day,
       CAST(total_quantity AS INTEGER) AS total_quantity,
       CAST(order_count AS INTEGER) AS order_count,
       CAST(CAST(hundredths AS DECIMAL(18, 2)) / 100 AS DECIMAL(5, 2)) AS average_delivery_time,
       latitude, longitude
FROM rolled WHERE neighborhood IS NOT NULL AND hundredths < 100000""",
    "gold_rejected": f"""
{_WITH_TIMED}, {_TIMES_FIVE}
SELECT order_date, neighborhood, comune, working_day, order_count,
       concat_ws(', ', CASE WHEN neighborhood IS NULL THEN 'neighborhood, comune' END,
                 CASE WHEN hundredths >= 100000 THEN 'average_delivery_time' END) AS reject_reason
FROM rolled WHERE neighborhood IS NULL OR hundredths >= 100000""",
}
ORACLES["enrich_by_shuffle"] = ORACLES["enrich_customer"]
ORACLES["area_many_vertices_by_shuffle"] = ORACLES["area_many_vertices"]
ORACLES["area_lookup_by_shuffle"] = ORACLES["area_lookup"]
