"""Hourly marts over the star schema.

Each mart groups the facts on their own keys first and joins the dimensions to the
groups: names depend on keys, so the result is the same and the joins see hours
instead of snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import CONGESTION_COUNTS, NO_PRECIPITATION
from ..functions import numbers
from ..operators.lookup import lookup

HOUR_KEYS = ("location_id", "date_key", "hour_key")
LABELS = ("location_id", "area_code", "area_name", "date_key", "full_date", "hour_key", "hour_label")


def with_labels(rows: DataFrame, dim_location, dim_date, dim_hour) -> DataFrame:
    """Star join: area, date and hour labels for rows that carry the three keys."""
    located = lookup(rows, dim_location.select("location_id", "area_code", "area_name"), ["location_id"])
    dated = lookup(located, dim_date.select("date_key", "full_date"), ["date_key"])
    hours = dim_hour.select("hour_key", "hour_label")
    return dated.join(F.broadcast(hours), "hour_key")  # 24 rows by its key


def labelled(grouped: DataFrame, dims: Sequence[DataFrame]) -> DataFrame:
    """A mart: groups on the hour keys with their labels in front."""
    return with_labels(grouped, *dims).select(*LABELS, *[c for c in grouped.columns if c not in HOUR_KEYS])


def population_measures() -> list[Column]:
    low, high, level = F.col("population_min"), F.col("population_max"), F.col("congestion_level")
    return [
        F.count(F.lit(1)).alias("snapshot_count"),
        numbers.mean_int(low).alias("avg_population_min"),
        numbers.mean_int(high).alias("avg_population_max"),
        numbers.mean_midpoint(low, high).alias("avg_estimated_population"),
        F.min(low).alias("min_population_min"),
        F.max(high).alias("peak_population_max"),
        *[F.count_if(level == label).alias(name) for label, name in CONGESTION_COUNTS.items()],
        F.max("dw_loaded_at").alias("latest_fact_loaded_at"),
    ]


def population_groups(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*HOUR_KEYS).agg(*population_measures())


def population_hourly(facts: DataFrame, dim_location, dim_date, dim_hour) -> DataFrame:
    return labelled(population_groups(facts), (dim_location, dim_date, dim_hour))


def weather_measures() -> list[Column]:
    rain = F.col("precipitation_type")
    return [
        F.count(F.lit(1)).alias("weather_snapshot_count"),
        *[
            numbers.mean_decimal(F.col(name)).alias(f"avg_{name}")
            for name in ("temperature_c", "feels_like_c", "humidity_pct", "wind_speed_mps")
        ],
        F.max("wind_speed_mps").alias("max_wind_speed_mps"),
        numbers.mean_decimal(F.col("pm10")).alias("avg_pm10"),
        numbers.mean_decimal(F.col("pm25")).alias("avg_pm25"),
        F.max("precipitation_mm").alias("max_precipitation_mm"),
        F.count_if(rain == NO_PRECIPITATION).alias("no_precipitation_count"),
        F.count_if(rain != NO_PRECIPITATION).alias("precipitation_observed_count"),
        # Lowest of the most frequent values; the buffer holds distinct labels only.
        F.mode(rain, True).alias("dominant_precipitation_type"),
        F.mode(F.col("air_quality_index"), True).alias("dominant_air_quality_index"),
        F.max("dw_loaded_at").alias("latest_weather_fact_loaded_at"),
    ]


def weather_groups(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*HOUR_KEYS).agg(*weather_measures())


def weather_hourly(facts: DataFrame, dim_location, dim_date, dim_hour) -> DataFrame:
    return labelled(weather_groups(facts), (dim_location, dim_date, dim_hour))


def population_weather_groups(city_facts: DataFrame, weather_facts: DataFrame) -> DataFrame:
    """Population hours with the weather of the same hour; weather-only hours drop out.

    Both groupings are already partitioned by the hour keys, so they meet without a shuffle.
    """
    return together(population_groups(city_facts), weather_groups(weather_facts))


def together(population: DataFrame, weather: DataFrame) -> DataFrame:
    """Population hours beside the weather of the same hour."""
    population = population.withColumnsRenamed(
        {
            "snapshot_count": "population_snapshot_count",
            "latest_fact_loaded_at": "latest_population_fact_loaded_at",
        }
    )
    both = population.join(weather, list(HOUR_KEYS), "left")
    stamps = ["latest_population_fact_loaded_at", "latest_weather_fact_loaded_at"]
    return both.select(*[c for c in both.columns if c not in stamps], *stamps)


def population_weather_hourly(city_facts, weather_facts, dim_location, dim_date, dim_hour) -> DataFrame:
    """Both marts in one; labels are looked up once, after the groups have met.

    A weather group counts only if its own star join would keep it, which the population side's
    join decides since both share the keys.
    """
    return labelled(population_weather_groups(city_facts, weather_facts), (dim_location, dim_date, dim_hour))


def _midpoint_sums() -> list[Column]:
    doubled = F.col("population_min").cast("bigint") + F.col("population_max").cast("bigint")
    return [
        F.sum(doubled).alias("doubled_sum"),
        F.count(doubled).alias("doubled_count"),
        F.max("population_max").alias("peak"),
        F.count(F.lit(1)).alias("snapshots"),
    ]


def _midpoint_measures(digits: int) -> list[Column]:
    return [
        numbers.mean_of_units(F.sum(F.col("doubled_sum") * 5), F.sum("doubled_count"), 1, digits).alias(
            "avg_estimated_population"
        ),
        F.max("peak").alias("peak_population_max"),
    ]


def area_hourly(facts: DataFrame, dim_location, dim_date, dim_hour) -> DataFrame:
    """Average estimated population by area name and hour, in time order."""
    grouped = facts.groupBy(*HOUR_KEYS).agg(*_midpoint_sums())
    return (
        with_labels(grouped, dim_location, dim_date, dim_hour)
        .groupBy("area_name", "full_date", "hour_key", "hour_label")
        .agg(*_midpoint_measures(1))
        .orderBy("full_date", "hour_key", "area_name")
        .select("area_name", "full_date", "hour_label", "avg_estimated_population", "peak_population_max")
    )


def area_class_hourly(facts: DataFrame, config: DataFrame, dim_location, dim_date, dim_hour) -> DataFrame:
    """The same measures rolled up to the configured analysis areas.

    ``config`` is unique on ``source_area_name``.
    """
    classes = config.select(
        F.col("source_area_name").alias("area_name"), "analysis_area_code", "analysis_area_name",
        "area_type", "district_name",
    )
    grouped = facts.groupBy(*HOUR_KEYS).agg(*_midpoint_sums())
    labelled = with_labels(grouped, dim_location, dim_date, dim_hour)
    return (
        lookup(labelled, classes, ["area_name"])
        .groupBy(
            "analysis_area_code", "analysis_area_name", "area_type", "district_name",
            "full_date", "hour_label",
        )
        .agg(F.sum("snapshots").alias("snapshot_count"), *_midpoint_measures(1))
    )


MARTS = ("city_population_hourly", "city_weather_hourly", "city_population_weather_hourly")


def create_views(city_facts, weather_facts, dim_location, dim_date, dim_hour) -> None:
    """Register the three marts as temporary views."""
    dims = (dim_location, dim_date, dim_hour)
    population_hourly(city_facts, *dims).createOrReplaceTempView(MARTS[0])
    weather_hourly(weather_facts, *dims).createOrReplaceTempView(MARTS[1])
    population_weather_hourly(city_facts, weather_facts, *dims).createOrReplaceTempView(MARTS[2])
