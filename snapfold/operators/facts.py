"""Fact rows: staging rows with surrogate keys, local date and hour keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock
from ..schemas import FACT_CITY, FACT_WEATHER
from .ids import snapshot_id
from .lookup import lookup


def population_view(population: DataFrame, header: DataFrame) -> DataFrame:
    """Population rows of successful calls with their header's name and time."""
    parent = header.where("is_success").select("ingestion_id", "area_code", "area_name", "collected_at")
    return population.join(parent, ["ingestion_id", "area_code"]).select(
        "population_snapshot_id", "ingestion_id", "area_code", "area_name", "observed_at",
        "collected_at", "congestion_level", "congestion_message", "population_min",
        "population_max", "male_ratio", "female_ratio", "resident_ratio",
        "non_resident_ratio", F.col("loaded_at").alias("staging_loaded_at"),
    )


def weather_view(weather: DataFrame, header: DataFrame) -> DataFrame:
    """Weather rows of successful calls with the time they were collected."""
    parent = header.where("is_success").select("ingestion_id", "collected_at")
    return weather.join(parent, "ingestion_id")


def payload_view(header: DataFrame, raw: DataFrame) -> DataFrame:
    """Successful headers with the stored document they came from."""
    return (
        header.where("is_success")
        .join(raw.select(F.col("raw_id").alias("ingestion_id"), "payload_xml"), "ingestion_id")
        .select(
            "ingestion_id", "area_code", "area_name",
            F.col("observed_at").alias("header_observed_at"), "payload_xml",
        )
    )


def _fact_rows(view: DataFrame, dim_location: DataFrame, id_name: str, stamp: Column, columns) -> DataFrame:
    local = clock.local_time(F.col("observed_at"))
    keyed = lookup(view, dim_location.select("area_code", "location_id"), ["area_code"])
    return (
        keyed.withColumn("date_key", clock.date_key(local))
        .withColumn("hour_key", clock.hour_key(local))
        .withColumn(id_name, snapshot_id(F.col("location_id"), F.col("observed_at")))
        .withColumn("source_ingestion_id", F.col("ingestion_id"))
        .withColumn("dw_loaded_at", stamp)
        .withColumn("dw_updated_at", stamp)
        .select(*columns)
    )


def city_fact_rows(view: DataFrame, dim_location: DataFrame, stamp: Column) -> DataFrame:
    """Arrivals for the city fact; areas without a dimension row are left out.

    ``view`` holds one row per ingestion.  Rows from deduplicated staging would
    lose the arrival a guarded fold has to keep.
    """
    return _fact_rows(view, dim_location, "city_snapshot_id", stamp, FACT_CITY.columns)


def weather_fact_rows(view: DataFrame, dim_location: DataFrame, stamp: Column) -> DataFrame:
    """Arrivals for the weather fact, keyed by the weather clock."""
    return _fact_rows(view, dim_location, "weather_snapshot_id", stamp, FACT_WEATHER.columns)


def lookup_misses(view: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Rows the surrogate lookup leaves out."""
    return lookup(view, dim_location.select("area_code"), ["area_code"], "left_anti")
