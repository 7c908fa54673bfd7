"""Queries that drive the loads as streams and read what the streams wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock
from ..functions.once import dealt, tasks_for
from ..operators import facts
from ..plans import hour_states
from ..schemas import FACT_CITY, RAW
from ..session import scratch_folder
from ..sources.tables import MedallionTables
from ..streaming import jobs
from . import document_queries, feed, warehouse_queries
from .oracle import KST, LATE_FIRST, ROWS, date_key, stamp, winner, with_ctes
from .shape import plain


def _event_stream(spark, sf_dir):
    """The events table as a file stream; the glob takes a file as well as a folder."""
    schema = feed.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def stream_ingest(spark, sf_dir):
    """Documents classified by a stream into a raw folder."""
    folder = scratch_folder(spark, "raw")
    tasks = tasks_for(feed.table(spark, sf_dir, "events"))
    calls = feed.documents(dealt(_event_stream(spark, sf_dir), tasks))
    query = jobs.ingest_raw(calls, f"{folder}/raw", f"{folder}/checkpoint")
    query.awaitTermination()
    raw = spark.read.schema(RAW.schema).parquet(f"{folder}/raw")
    return plain(raw.select(*RAW.columns).drop("payload_xml", "payload", "received_at"))


def stream_upsert(spark, sf_dir):
    """City facts folded by a stream, one guarded merge per micro-batch."""
    folder = scratch_folder(spark, "facts")
    tables = MedallionTables(spark, f"{folder}/tables")
    rows = feed.population_rows(_event_stream(spark, sf_dir))
    arrivals = facts.city_fact_rows(rows, feed.dim_location(spark, sf_dir), F.col("collected_at"))
    query = jobs.merge_arrivals(arrivals, tables, FACT_CITY.name, f"{folder}/checkpoint")
    query.awaitTermination()
    return plain(tables.read(FACT_CITY.name))


def stream_hourly(spark, sf_dir):
    """Hourly counts on event time, as an update log of the stream's groups."""
    folder = scratch_folder(spark, "hours")
    rows = feed.population_rows(_event_stream(spark, sf_dir))
    measures = [
        F.count(F.lit(1)).alias("snapshot_count"),
        F.max("population_max").alias("peak_population_max"),
        F.mode("congestion_level", True).alias("dominant_level"),
    ]
    groups = jobs.event_time_hours(rows, measures, ["area_code"], lateness="400 days")
    query = jobs.emit_updates(groups, f"{folder}/updates", f"{folder}/checkpoint")
    query.awaitTermination()
    newest = jobs.read_updates(groups, f"{folder}/updates", ["area_code", "hour_start_at"])
    local = clock.local_time(F.col("hour_start_at"))
    return plain(
        newest.withColumn("date_key", clock.date_key(local))
        .withColumn("hour_key", clock.hour_key(local)).drop("hour_start_at")
    )


def _file_per_batch(spark, sf_dir, folder, order):
    """The events as a stream of one file per micro-batch, in the given order of the day's thirds."""
    events = feed.table(spark, sf_dir, "events")
    third = F.floor(F.hour("ts") / 8)
    for number, part in enumerate(order):
        events.where(third == part).coalesce(1).write.parquet(f"{folder}/in/{number}")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def stream_stale(spark, sf_dir):
    """City facts over three micro-batches, the latest arrivals first: keyed state stops what comes too late to win."""
    folder = scratch_folder(spark, "stale")
    tables = MedallionTables(spark, f"{folder}/tables")
    rows = feed.population_rows(_file_per_batch(spark, sf_dir, folder, (2, 1, 0)))
    # a key of a whole day has arrivals in each of the three files
    rows = rows.withColumn("observed_at", F.date_trunc("day", "observed_at"))
    arrivals = facts.city_fact_rows(rows, feed.dim_location(spark, sf_dir), F.col("collected_at"))
    newer = jobs.newer_only(arrivals, ["location_id", "observed_at"], ["collected_at", "source_ingestion_id"])
    jobs.merge_arrivals(newer, tables, FACT_CITY.name, f"{folder}/checkpoint").awaitTermination()
    return plain(tables.read(FACT_CITY.name).select(
        "location_id", "observed_at", "collected_at", "population_max", "source_ingestion_id"))


def stream_hourly_late(spark, sf_dir):
    """Hourly groups over three micro-batches, the latest hours first: late ones are merged into the stored hours."""
    folder = scratch_folder(spark, "late")
    tables = MedallionTables(spark, f"{folder}/tables")
    rows = feed.population_rows(_file_per_batch(spark, sf_dir, folder, (2, 0, 1)))
    arrivals = facts.city_fact_rows(rows, feed.dim_location(spark, sf_dir), F.col("collected_at"))
    jobs.merge_hours(arrivals, tables, hour_states.POPULATION, f"{folder}/checkpoint").awaitTermination()
    states = hour_states.stored_states(tables, hour_states.POPULATION)
    named = states.join(feed.dim_location(spark, sf_dir), "location_id")
    return plain(named.select(
        "area_code", "date_key", "hour_key", F.col("snapshots").alias("snapshot_count"), "peak_population_max",
        hour_states.mode(F.col("congestion_level")).alias("dominant_level")))


QUERIES = {f.__name__: f for f in (stream_ingest, stream_upsert, stream_hourly, stream_stale, stream_hourly_late)}

ORACLE = {
    "stream_ingest": document_queries.ORACLE["raw_classify"],
    "stream_upsert": warehouse_queries.ORACLE["guarded_fact"],
    "stream_hourly": with_ctes(ROWS, f"""
SELECT area_code, {date_key('h')} AS date_key, CAST(hour(h) AS INTEGER) AS hour_key, count(*) AS snapshot_count,
       max(population_max) AS peak_population_max, min(level) FILTER (WHERE place = 1) AS dominant_level
FROM (SELECT p.area_code, date_trunc('hour', p.observed_at {KST}) AS h, population_max, n.congestion_level AS level, n.place
      FROM pop p JOIN (
        SELECT area_code, date_trunc('hour', observed_at) AS u, congestion_level,
               row_number() OVER (PARTITION BY area_code, date_trunc('hour', observed_at)
                                  ORDER BY count(*) DESC, congestion_level) AS place
        FROM pop GROUP BY area_code, u, congestion_level) n
      ON n.area_code = p.area_code AND n.u = date_trunc('hour', p.observed_at) AND n.place = 1)
GROUP BY area_code, h"""),
}
ORACLE["stream_hourly_late"] = ORACLE["stream_hourly"]
ORACLE["stream_stale"] = with_ctes(f"""{ROWS},
days AS (SELECT CAST(substr(area_code, 4) AS INTEGER) + 1 AS location_id, date_trunc('day', observed_at) AS day, * FROM pop)""", f"""
SELECT location_id, {stamp('day')} AS observed_at, {stamp('collected_at')} AS collected_at, population_max,
       ingestion_id AS source_ingestion_id FROM {winner('days', 'location_id, day', LATE_FIRST)}""")
