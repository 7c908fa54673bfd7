"""Queries over the marts, from ready facts and from raw documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock
from ..operators import facts, integrity
from ..operators.documents import classify
from ..plans import hour_states, load, marts
from ..plans.load import rebuild
from ..schemas import TABLES
from ..session import saved, scratch_folder
from ..sources.tables import MedallionTables
from . import feed
from .oracle import FACTS, KST, half_up, stamp, with_ctes
from .shape import plain
from .warehouse_queries import city_facts, weather_facts


def mart_population(spark, sf_dir):
    return plain(marts.population_hourly(city_facts(spark, sf_dir), *feed.dims(spark, sf_dir)))


def mart_weather(spark, sf_dir):
    return plain(marts.weather_hourly(weather_facts(spark, sf_dir), *feed.dims(spark, sf_dir)))


def mart_merged(spark, sf_dir):
    return plain(
        marts.population_weather_hourly(
            city_facts(spark, sf_dir), weather_facts(spark, sf_dir), *feed.dims(spark, sf_dir)
        )
    )


def _incremental(spark, sf_dir, name):
    """Facts merged in three batches by arrival, of which later ones supersede some; the states follow each batch."""
    tables = MedallionTables(spark, scratch_folder(spark, "incremental"))
    events = feed.spread(feed.table(spark, sf_dir, "events"))
    third = events.count() // 3 + 1
    dims = feed.dims(spark, sf_dir)
    for table, rows in zip(("dim_location", "dim_date", "dim_hour"), dims):
        tables.put_table(table, -1, integrity.conform(rows, TABLES[table]))
    makers = [(hour_states.POPULATION, feed.population_rows, facts.city_fact_rows)]
    if name != marts.MARTS[0]:
        makers.append((hour_states.WEATHER, feed.weather_rows, facts.weather_fact_rows))
    for batch in range(3):
        part = events.where((F.col("event_id") / third).cast("int") == batch)
        for spec, rows, fact_rows in makers:
            arrivals = saved(fact_rows(rows(part), dims[0], F.col("collected_at")), scratch_folder(spark, "arrivals"))
            days = tables.merge(spec.fact, arrivals, batch)
            hour_states.update(tables, spec, arrivals, days, batch)
    return plain(load.read_mart(tables, name))


def mart_incremental(spark, sf_dir):
    """The population mart kept up to date by three batches."""
    return _incremental(spark, sf_dir, marts.MARTS[0])


def mart_incremental_merged(spark, sf_dir):
    """The merged mart, from the states of both facts after three batches."""
    return _incremental(spark, sf_dir, marts.MARTS[2])


def avg_by_area_hour(spark, sf_dir):
    return plain(marts.area_hourly(city_facts(spark, sf_dir), *feed.dims(spark, sf_dir)))


def area_class_rollup(spark, sf_dir):
    """Nations as areas, their regions as analysis areas."""
    nation, region = feed.table(spark, sf_dir, "nation"), feed.table(spark, sf_dir, "region")
    config = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("source_area_name"),
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("analysis_area_code"),
        F.col("r_name").alias("analysis_area_name"),
        F.when(F.col("n_nationkey") < 12, "commercial").otherwise("business").alias("area_type"),
        F.lit("all").alias("district_name"),
    )
    return plain(marts.area_class_hourly(city_facts(spark, sf_dir), config, *feed.dims(spark, sf_dir)))


def hourly_from_documents(spark, sf_dir):
    """The population mart straight from raw documents: classify, gate, fold, aggregate."""
    raw = classify(feed.landing(spark, sf_dir), with_payload=False, keep_parts=True)
    built = rebuild(raw, clock.utc_instant(F.lit("2024-02-02")))
    location, date, hour = feed.dims(spark, sf_dir)
    mart = marts.population_hourly(built["fact_city_snapshot"], built["dim_location"], date, hour)
    return plain(mart.drop("location_id"))


QUERIES = {
    f.__name__: f
    for f in (
        mart_population, mart_weather, mart_merged, mart_incremental, mart_incremental_merged, avg_by_area_hour, area_class_rollup, hourly_from_documents,
    )
}

# ---- the same in SQL ------------------------------------------------------------------

_HOUR = "location_id, date_key, hour_key"


def _labels(alias: str) -> str:
    return (
        f"{alias}.location_id, l.area_code, l.area_name, {alias}.date_key, "
        f"strftime(strptime(CAST({alias}.date_key AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS full_date, "
        f"CAST({alias}.hour_key AS INTEGER) AS hour_key, printf('%02d:00', {alias}.hour_key) AS hour_label"
    )


def _level(label: str) -> str:
    return f"count(*) FILTER (WHERE congestion_level = '{label}')"


_POPULATION = f"""
ph AS (
  SELECT {_HOUR}, count(*) AS snapshot_count,
    {half_up('sum(population_min * 100)', 'count(*)', 2)} AS avg_population_min,
    {half_up('sum(population_max * 100)', 'count(*)', 2)} AS avg_population_max,
    {half_up('sum((population_min + population_max) * 50)', 'count(*)', 2)} AS avg_estimated_population,
    min(population_min) AS min_population_min, max(population_max) AS peak_population_max,
    {_level('여유')} AS relaxed_count, {_level('보통')} AS normal_count, {_level('약간 붐빔')} AS slightly_crowded_count,
    {_level('붐빔')} AS crowded_count, {_level('매우 붐빔')} AS very_crowded_count,
    {stamp('max(first_collected)')} AS latest_fact_loaded_at
  FROM city GROUP BY {_HOUR})"""


def _top(column: str) -> str:
    return f"""(SELECT {_HOUR}, {column} FROM (SELECT {_HOUR}, {column}, count(*) AS n FROM weather
    WHERE {column} IS NOT NULL GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY {_HOUR} ORDER BY n DESC, {column}) = 1)"""


_WEATHER = f"""
wh AS (
  SELECT {_HOUR}, count(*) AS weather_snapshot_count,
    {half_up('sum(temp_cents)', 'count(temp_cents)', 2)} AS avg_temperature_c,
    CAST(NULL AS DOUBLE) AS avg_feels_like_c,
    {half_up('sum(humidity * 100)', 'count(*)', 2)} AS avg_humidity_pct,
    {half_up('sum(wind_tenths * 10)', 'count(*)', 2)} AS avg_wind_speed_mps,
    max(wind_tenths) / 10.0::DOUBLE AS max_wind_speed_mps,
    {half_up('sum(pm10 * 100)', 'count(*)', 2)} AS avg_pm10,
    {half_up('sum(pm25_cents)', 'count(*)', 2)} AS avg_pm25,
    max(rain_cents) / 100.0::DOUBLE AS max_precipitation_mm,
    count(*) FILTER (WHERE precipitation_type = '없음') AS no_precipitation_count,
    count(*) FILTER (WHERE precipitation_type <> '없음') AS precipitation_observed_count,
    {stamp('max(first_collected)')} AS latest_weather_fact_loaded_at
  FROM weather GROUP BY {_HOUR}),
wm AS (SELECT wh.*, t.precipitation_type AS dominant_precipitation_type, a.air_quality_index AS dominant_air_quality_index
  FROM wh LEFT JOIN {_top('precipitation_type')} t USING ({_HOUR})
  LEFT JOIN {_top('air_quality_index')} a USING ({_HOUR}))"""


def _classes(group: str) -> str:
    return f"""
SELECT {group}, strftime(observed_at {KST}, '%Y-%m-%d') AS full_date, strftime(observed_at {KST}, '%H:00') AS hour_label,
       {half_up('sum((population_min + population_max) * 5)', 'count(*)', 1)} AS avg_estimated_population,
       max(population_max) AS peak_population_max"""


_DOCUMENT_STAMP = "'2024-02-02 00:00:00' AS latest_fact_loaded_at"

ORACLE = {
    "mart_population": with_ctes(f"{FACTS}, {_POPULATION.strip()}", f"""
SELECT {_labels('p')}, p.* EXCLUDE ({_HOUR}) FROM ph p JOIN loc l USING (location_id)"""),
    "mart_weather": with_ctes(f"{FACTS}, {_WEATHER.strip()}", f"""
SELECT {_labels('w')}, w.* EXCLUDE ({_HOUR}) FROM wm w JOIN loc l USING (location_id)"""),
    "mart_merged": with_ctes(f"{FACTS}, {_POPULATION.strip()}, {_WEATHER.strip()}", f"""
SELECT {_labels('p')}, p.snapshot_count AS population_snapshot_count, p.* EXCLUDE ({_HOUR}, snapshot_count, latest_fact_loaded_at),
       w.* EXCLUDE ({_HOUR}), p.latest_fact_loaded_at AS latest_population_fact_loaded_at
FROM ph p JOIN loc l USING (location_id) LEFT JOIN wm w USING ({_HOUR})"""),
    "avg_by_area_hour": with_ctes(FACTS, f"{_classes('area_name')} FROM city GROUP BY ALL"),
    "area_class_rollup": with_ctes(FACTS, f"""{_classes(
        "'R' || r_regionkey AS analysis_area_code, r_name AS analysis_area_name, "
        "CASE WHEN n_nationkey < 12 THEN 'commercial' ELSE 'business' END AS area_type, 'all' AS district_name")},
       count(*) AS snapshot_count
FROM city c JOIN nation ON n_name = c.area_name JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""),
    "hourly_from_documents": with_ctes(f"{FACTS}, {_POPULATION.strip()}", f"""
SELECT {_labels('p')}, p.* EXCLUDE ({_HOUR}, latest_fact_loaded_at), {_DOCUMENT_STAMP}
FROM ph p JOIN loc l USING (location_id)""").replace("SELECT p.location_id, l.area_code", "SELECT l.area_code"),
}

ORACLE["mart_incremental"] = ORACLE["mart_population"]
ORACLE["mart_incremental_merged"] = ORACLE["mart_merged"]
