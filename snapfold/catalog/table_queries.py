"""Queries over stored tables: moved keys, versions, refused rows, defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock
from ..operators import facts, integrity
from ..plans import load
from ..schemas import DIM_LOCATION, EVENT, FACT_CITY, HEADER, POPULATION, RAW, SUBWAY, WEATHER
from ..session import saved, scratch_folder
from ..sources.tables import MedallionTables
from . import feed, warehouse_queries as warehouse
from .oracle import FACTS, ROWS, stamp, winner, with_ctes
from .shape import plain


def _tables(spark) -> MedallionTables:
    return MedallionTables(spark, scratch_folder(spark, "tables"))


def _k(rows, spark, sf_dir):
    """Rows with the number that decides what is done to them."""
    numbers = feed.base(feed.table(spark, sf_dir, "events")).select(F.col("raw_id").alias("ingestion_id"), "k")
    return rows.join(numbers, "ingestion_id")


def key_moves_partition(spark, sf_dir):
    """Headers that arrive again for another day, or for none: each ingestion stays one row, where it came last."""
    tables = _tables(spark)
    rows = feed.header_rows(feed.table(spark, sf_dir, "events"))
    rows = _k(rows.withColumn("ingest_date", F.col("collected_at").cast("date")), spark, sf_dir)
    again = rows.where("k % 3 = 0").withColumn("area_name", F.concat(F.lit("moved "), "area_name"))
    lost = rows.where("k % 5 = 0").withColumn("area_name", F.concat(F.lit("lost "), "area_name"))
    batches = (rows, again.withColumn("ingest_date", F.date_add("ingest_date", 1)),
               lost.withColumn("ingest_date", F.lit(None).cast("date")))
    for batch, arrivals in enumerate(batches):
        tables.merge(HEADER.name, integrity.conform(arrivals, HEADER), batch)
    return plain(tables.read(HEADER.name).select("ingestion_id", "area_name", "ingest_date"))


def weather_staging_merge(spark, sf_dir):
    """Weather staging after three batches, and one in which every fourth ingestion comes again for the next day."""
    tables = _tables(spark)
    rows = _k(feed.weather_rows(feed.spread(feed.table(spark, sf_dir, "events"))), spark, sf_dir)
    rows = saved(rows, scratch_folder(spark, "arrivals"))
    third = feed.table(spark, sf_dir, "events").count() // 3 + 1
    batches = [rows.where((F.col("ingestion_id") / third).cast("int") == batch) for batch in range(3)]
    batches.append(rows.where("k % 4 = 0").withColumn("ingest_date", F.date_add("ingest_date", 1))
                   .withColumn("pm10", F.col("pm10") + 1))
    for batch, arrivals in enumerate(batches):
        tables.merge(WEATHER.name, integrity.conform(arrivals, WEATHER), batch)
    return plain(tables.read(WEATHER.name).select("ingestion_id", "area_code", "observed_at", "pm10", "ingest_date"))


def time_travel(spark, sf_dir):
    """Population staging as it was after each of three batches, read from the versions kept."""
    tables = _tables(spark)
    rows = feed.population_rows(feed.table(spark, sf_dir, "events"))
    third = feed.table(spark, sf_dir, "events").count() // 3 + 1
    for batch in range(3):
        tables.merge(POPULATION.name, rows.where((F.col("ingestion_id") / third).cast("int") == batch), batch)
    found = [tables.read(POPULATION.name, as_of=batch).withColumn("as_of", F.lit(batch)) for batch in range(3)]
    seen = found[0].unionByName(found[1]).unionByName(found[2])
    return plain(seen.select("as_of", "area_code", "observed_at", "ingestion_id", "population_max"))


def _faulty_facts(spark, sf_dir):
    """City arrivals of which some break one rule each."""
    rows = _k(warehouse._city_arrivals(spark, sf_dir).withColumnRenamed("source_ingestion_id", "ingestion_id"), spark, sf_dir)
    k = F.col("k")
    return rows.withColumns({
        "collected_at": F.when(k != 1, F.col("collected_at")),
        "population_min": F.when(k == 2, F.col("population_max") + 1).when(k != 10, F.col("population_min")),
        "location_id": F.when(k == 4, 9999).otherwise(F.col("location_id")),
        "hour_key": F.when(k == 5, 99).otherwise(F.col("hour_key")).cast("smallint"),
        "date_key": F.when(k == 6, 19000101).otherwise(F.col("date_key")),
        "city_snapshot_id": F.when(k == 8, 1).when(k == 4, -F.col("ingestion_id")).otherwise(F.col("city_snapshot_id")),
    }).withColumnRenamed("ingestion_id", "source_ingestion_id")


def load_refused(spark, sf_dir):
    """Loads of four tables, of which some rows break a NOT NULL, CHECK, UNIQUE or reference rule: refused and kept counts."""
    tables = _tables(spark)
    dims = feed.dims(spark, sf_dir)
    named = integrity.conform(dims[0], DIM_LOCATION)
    faulty = named.withColumns({
        "latitude": F.when(F.col("location_id") % 5 == 0, 91).otherwise(F.when(F.col("location_id") != 7, 45)),
        "area_name": F.when(F.col("location_id") % 8 != 3, F.col("area_name")),
        "location_id": F.when(F.col("location_id").isin(12, 14), 16).otherwise(F.col("location_id")),
    })
    parents = {"dim_location": dims[0], "dim_date": dims[1], "dim_hour": dims[2]}
    lines = feed.table(spark, sf_dir, "lineitem")
    calls = lines.where("l_linenumber < 4").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("raw_id"))
    header = feed.header_rows(warehouse._events(spark, sf_dir))
    header = header.withColumn("ingest_date", F.col("collected_at").cast("date"))
    known = feed.base(feed.table(spark, sf_dir, "events")).where("k < 70").select("raw_id")
    loads = (
        (DIM_LOCATION, faulty, None), (FACT_CITY, _faulty_facts(spark, sf_dir), parents),
        (SUBWAY, warehouse._subway(spark, sf_dir), {RAW.name: calls}), (HEADER, header, {RAW.name: known}),
    )
    found = None
    for batch, (table, rows, above) in enumerate(loads):
        refused = load.load_rows(tables, table.name, rows, batch, above)
        counts = refused.select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count("*").alias("rows"))
        counts = counts.unionByName(tables.read(table.name).agg(F.lit("stored").alias("violation"), F.count("*").alias("rows")))
        counts = counts.select(F.lit(table.name).alias("table_name"), "violation", "rows")
        found = counts if found is None else found.unionByName(counts)
    return found


def defaults(spark, sf_dir):
    """Areas that come without some values get the table's defaults."""
    key = F.col("c_custkey")
    rows = feed.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), key.cast("string")).alias("area_code"), F.col("c_name").alias("area_name"),
        F.when(key % 2 == 0, "UTC").alias("timezone_name"), F.when(key % 3 == 0, False).alias("is_active"))
    filled = integrity.with_defaults(rows, DIM_LOCATION)
    return filled.select("area_code", "timezone_name", "is_active", F.col("created_at").isNotNull().alias("has_created_at"),
                         F.col("updated_at").isNotNull().alias("has_updated_at"))


def weather_view(spark, sf_dir):
    """Weather rows beside their headers; every ninth call was no success."""
    events = feed.table(spark, sf_dir, "events")
    header = feed.header_rows(events).withColumn("is_success", F.col("ingestion_id") % 9 != 0)
    staged = feed.weather_rows(events).drop("collected_at", "area_name")
    return plain(facts.weather_view(staged, header).select("ingestion_id", "area_code", "observed_at", "collected_at", "pm10"))


def event_merge(spark, sf_dir):
    """Events loaded in three batches by id, each upserted onto the rows stored before."""
    tables = _tables(spark)
    at = clock.utc_instant(F.col("ts"))
    rows = feed.table(spark, sf_dir, "events").select(
        (F.col("event_id") % 3).alias("batch"),
        F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("staging_id"),
        F.col("event_type").alias("event_name"),
        clock.utc_instant(F.date_trunc("week", F.col("ts").cast("timestamp_ntz"))).alias("event_start_at"),
        F.col("props").alias("venue_name"), F.col("event_id").cast("string").alias("source_event_id"), at.alias("loaded_at"),
    )
    for batch in range(3):
        load.load_rows(tables, EVENT.name, rows.where(F.col("batch") == batch).drop("batch"), batch)
    return plain(tables.read(EVENT.name).select("staging_id", "event_name", "event_start_at", "venue_name", "source_event_id", "loaded_at"))


QUERIES = {f.__name__: f for f in (
    key_moves_partition, weather_staging_merge, time_travel, load_refused, defaults, weather_view, event_merge)}

_DATE = "strftime({}, '%Y-%m-%d')"
_EVENT_KEYS = "user_id, event_type, date_trunc('week', ts)"


def _counts(table: str, violation: str, condition: str, rows: str) -> str:
    return f"SELECT '{table}' AS table_name, '{violation}' AS violation, count(*) AS rows FROM {rows} WHERE {condition} HAVING count(*) > 0"


_FACT = "fact_city_snapshot"
_REFUSED = f"""{FACTS}, {warehouse._SUBWAY.strip()},
arrived AS (SELECT l.location_id, p.* FROM pop p JOIN loc l ON l.area_code = p.area_code),
own AS (SELECT min(location_id * 4294967296 + CAST(epoch(observed_at) AS BIGINT) // 60) AS first FROM arrived WHERE k = 8),
good AS (SELECT * FROM arrived WHERE k NOT IN (1, 2, 4, 5, 6)
         AND (k <> 8 OR location_id * 4294967296 + CAST(epoch(observed_at) AS BIGINT) // 60 = (SELECT first FROM own))),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY raw_id ORDER BY usage_date, line_name, station_id) > 1 AS shares FROM kept),
called AS (SELECT * FROM ranked WHERE raw_id % 10 < 4 AND NOT shares)"""

ORACLE = {
    "key_moves_partition": with_ctes(ROWS, f"""
SELECT ingestion_id, CASE WHEN k % 5 = 0 THEN 'lost ' WHEN k % 3 = 0 THEN 'moved ' ELSE '' END || area_name AS area_name,
       CASE WHEN k % 5 = 0 THEN NULL WHEN k % 3 = 0 THEN {_DATE.format('collected_at + INTERVAL 1 DAY')}
            ELSE {_DATE.format('collected_at')} END AS ingest_date FROM pop"""),
    "weather_staging_merge": with_ctes(ROWS, f"""
SELECT ingestion_id, area_code, {stamp('observed_at')} AS observed_at,
       CAST(pm10 + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS pm10,
       {_DATE.format('collected_at + CASE WHEN k % 4 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END')} AS ingest_date FROM wea"""),
    "time_travel": with_ctes(ROWS, "\nUNION ALL\n".join(f"""
SELECT {batch} AS as_of, area_code, {stamp('observed_at')} AS observed_at, ingestion_id, population_max
FROM {winner(f"(SELECT * FROM pop WHERE ingestion_id // ((SELECT count(*) FROM events) // 3 + 1) <= {batch})",
             "area_code, observed_at", "ingestion_id DESC")}""" for batch in range(3))),
    "load_refused": with_ctes(_REFUSED, "\nUNION ALL\n".join([
        _counts("dim_location", "latitude_range", "location_id % 5 = 0", "loc"),
        _counts("dim_location", "area_name_required", "location_id % 8 = 3", "loc"),
        # of 12, 14 and 16, which now share an id, the first code stays
        "SELECT 'dim_location' AS table_name, 'location_id_unique' AS violation, 2 AS rows",
        _counts("dim_location", "stored", "location_id % 5 <> 0 AND location_id % 8 <> 3 AND location_id NOT IN (14, 16)", "loc"),
        _counts(_FACT, "collected_at_required", "k = 1", "arrived"), _counts(_FACT, "population_range", "k = 2", "arrived"),
        _counts(_FACT, "location_id_reference", "k = 4", "arrived"), _counts(_FACT, "hour_key_reference", "k = 5", "arrived"),
        _counts(_FACT, "date_key_reference", "k = 6", "arrived"),
        _counts(_FACT, "city_snapshot_id_unique", "k = 8 AND location_id * 4294967296 + CAST(epoch(observed_at) AS BIGINT) // 60 <> (SELECT first FROM own)", "arrived"),
        _counts(_FACT, "stored", "true", "(SELECT DISTINCT location_id, observed_at FROM good)"),
        _counts("subway_station_daily", "line_name_required", "line_name IS NULL", "subway"),
        _counts("subway_station_daily", "boardings_not_negative", "boardings < 0", "subway"),
        _counts("subway_station_daily", "alightings_not_negative", "alightings < 0", "subway"),
        _counts("subway_station_daily", "subway_usage_id_unique", "shares", "ranked"),
        _counts("subway_station_daily", "raw_id_reference", "raw_id % 10 >= 4", "kept"),
        _counts("subway_station_daily", "stored", "true", "(SELECT DISTINCT usage_date, line_name, station_id FROM called)"),
        _counts("realtime_city_header", "ingestion_id_reference", "k >= 70", "pop"),
        _counts("realtime_city_header", "stored", "k < 70", "pop"),
    ])),
    "defaults": """
SELECT 'C' || c_custkey AS area_code, CASE WHEN c_custkey % 2 = 0 THEN 'UTC' ELSE 'Asia/Seoul' END AS timezone_name,
       c_custkey % 3 <> 0 AS is_active, true AS has_created_at, true AS has_updated_at FROM customer""",
    "weather_view": with_ctes(ROWS, f"""
SELECT ingestion_id, area_code, {stamp('observed_at')} AS observed_at, {stamp('collected_at')} AS collected_at,
       CAST(pm10 AS DOUBLE) AS pm10 FROM wea WHERE ingestion_id % 9 <> 0"""),
    # the batch that comes last wins, inside it the latest
    "event_merge": f"""
SELECT user_id AS staging_id, event_type AS event_name, {stamp("date_trunc('week', ts)")} AS event_start_at, props AS venue_name,
       CAST(event_id AS VARCHAR) AS source_event_id, {stamp('ts')} AS loaded_at
FROM events WHERE event_id % 11 <> 0
QUALIFY row_number() OVER (PARTITION BY {_EVENT_KEYS} ORDER BY event_id % 3 DESC, ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""",
}
