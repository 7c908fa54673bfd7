"""The feed and the load in plain SQL, for the side-by-side check of the queries."""

from __future__ import annotations

from . import feed


def _numbers(values) -> str:
    return ", ".join(str(v) for v in values)


REJECTED = _numbers(feed.REASONS_BY_K)
NO_WEATHER = _numbers((*feed.WEATHER_SKIPPED, *feed.WEATHER_REASONS_BY_K))
BROKEN_WEATHER = _numbers(feed.WEATHER_BROKEN)


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def date_key(local: str) -> str:
    return f"CAST(strftime({local}, '%Y%m%d') AS INTEGER)"


KST = "+ INTERVAL 9 HOUR"

BASE = """
b AS (
  SELECT event_id AS raw_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         CAST(CAST(value AS DECIMAL(12,2)) * 100 AS INTEGER) AS cents, event_type,
         'POI' || lpad(CAST(user_id % 25 AS VARCHAR), 3, '0') AS poi,
         'NATION_' || CAST(user_id % 25 AS VARCHAR) AS place,
         time_bucket(INTERVAL 5 MINUTE, ts) AS population_at,
         time_bucket(INTERVAL 10 MINUTE, ts) AS weather_at, ts
  FROM events),
d AS (
  SELECT *, CASE WHEN k = 97 THEN ts - INTERVAL 1 HOUR ELSE ts + to_seconds(k * 10) END AS requested_at,
         CASE WHEN k = 1 THEN '모름' WHEN event_type = 'click' THEN '여유'
              WHEN event_type = 'view' THEN '보통' WHEN event_type = 'signup' THEN '약간 붐빔'
              WHEN event_type = 'purchase' THEN '붐빔' ELSE '매우 붐빔' END AS lvl,
         CASE WHEN k < 60 THEN '없음' WHEN k < 80 THEN '비' WHEN k < 90 THEN '눈' END AS rain,
         CASE WHEN event_type IN ('click', 'view') THEN '좋음'
              WHEN event_type = 'signup' THEN '보통' ELSE '나쁨' END AS air
  FROM b)"""

ROWS = f"""{BASE},
pop AS (
  SELECT raw_id AS ingestion_id, poi AS area_code, place AS area_name, population_at AS observed_at,
         requested_at AS collected_at, lvl AS congestion_level,
         CASE WHEN k % 2 = 0 THEN 'level ' || k END AS congestion_message,
         cents + 100 AS population_min, cents + 100 + 10 * k AS population_max,
         CASE WHEN k NOT IN (2, 4, 6, 8, 10, 12) THEN (k * 100 + 25) / 100.0 END AS male_ratio,
         (9975 - k * 100) / 100.0 AS female_ratio, (k * 100 + 1) / 100.0 AS resident_ratio,
         CASE WHEN k < 50 THEN (k * 100 + 50) / 100.0 END AS non_resident_ratio, k
  FROM d WHERE k NOT IN ({REJECTED})),
wea_all AS (
  SELECT raw_id AS ingestion_id, poi AS area_code, place AS area_name, weather_at AS observed_at,
         requested_at AS collected_at,
         CASE WHEN k NOT IN (14, 16, 18, 20) THEN cents - 5000 END AS temp_cents,
         CASE WHEN k = 79 THEN 101 ELSE k END AS humidity,
         rain AS precipitation_type,
         CASE WHEN k = 89 THEN -100 WHEN k >= 60 THEN cents END AS rain_cents,
         CASE WHEN k = 91 THEN -10 ELSE k END AS wind_tenths,
         CASE WHEN k = 93 THEN -3 ELSE 2 * k END AS pm10,
         CASE WHEN k = 95 THEN -50 ELSE 100 * k END AS pm25_cents,
         air AS air_quality_index,
         'air ' || event_type || chr(10) || CASE WHEN k >= 60 THEN 'rain' || chr(10) ELSE '' END
           || 'uv ' || k AS weather_description, k
  FROM d WHERE k NOT IN ({REJECTED}, {NO_WEATHER})),
wea AS (SELECT * FROM wea_all WHERE k NOT IN ({BROKEN_WEATHER}))"""


def winner(source: str, keys: str, order: str) -> str:
    return (
        f"(SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"
    )


LATE_FIRST = "collected_at DESC, ingestion_id DESC"


def arrivals(rows: str) -> str:
    """Rows with what their key's first arrival was loaded at, which updates keep."""
    first = "first_value(collected_at) OVER (PARTITION BY area_code, observed_at ORDER BY ingestion_id)"
    return f"(SELECT *, {first} AS first_collected FROM {rows})"


FACTS = f"""{ROWS},
loc AS (SELECT n_nationkey + 1 AS location_id, 'POI' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS area_code,
               n_name AS area_name, n_regionkey FROM nation),
pop_last AS {winner(arrivals('pop'), 'area_code, observed_at', LATE_FIRST)},
city AS (SELECT l.location_id, {date_key('p.observed_at ' + KST)} AS date_key,
                hour(p.observed_at {KST}) AS hour_key, p.*
         FROM pop_last p JOIN loc l ON l.area_code = p.area_code),
wea_last AS {winner(arrivals('wea'), 'area_code, observed_at', LATE_FIRST)},
weather AS (SELECT l.location_id, {date_key('w.observed_at ' + KST)} AS date_key,
                   hour(w.observed_at {KST}) AS hour_key, w.*
            FROM wea_last w JOIN loc l ON l.area_code = w.area_code),
stg AS {winner('pop', 'area_code, observed_at', 'ingestion_id DESC')}"""


def half_up(total: str, count: str, scale: int) -> str:
    """total / count rounded half away from zero, as a double with ``scale`` shifted digits.

    ``total`` is a whole number in units of the wanted last digit.
    """
    exact = f"((2 * abs({total}) + {count}) // (2 * {count}))"
    return f"CASE WHEN {count} > 0 THEN sign({total}) * {exact} / {10 ** scale}.0 END"


def with_ctes(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query.strip()}"
