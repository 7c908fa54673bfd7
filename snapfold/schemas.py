"""Registry of the medallion tables: columns, keys, defaults and integrity rules.

Parquet enforces none of these, so ``operators.integrity`` turns them into
DataFrame checks.  A check holds when it is true *or unknown*, as in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .fixed_values import BUSINESS_ZONE, SOURCE_NAME


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...]
    other_keys: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    partition: str | None = None
    moving: bool = False  # the key does not tell the partition, so it may arrive for another one

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


_DIM_REFERENCES = (
    Reference(("location_id",), "dim_location", ("location_id",)),
    Reference(("date_key",), "dim_date", ("date_key",)),
    Reference(("hour_key",), "dim_hour", ("hour_key",)),
)

_WEATHER_COLUMNS = (
    "temperature_c decimal(5,2), feels_like_c decimal(5,2), humidity_pct decimal(5,2), "
    "precipitation_type string, precipitation_mm decimal(7,2), wind_speed_mps decimal(6,2), "
    "wind_direction_deg decimal(6,2), pm10 decimal(8,2), pm25 decimal(8,2), "
    "air_quality_index string, weather_description string"
)

_RATIO_COLUMNS = (
    "male_ratio decimal(5,2), female_ratio decimal(5,2), "
    "resident_ratio decimal(5,2), non_resident_ratio decimal(5,2)"
)

# Wind speed is checked at both levels, so a bad value never reaches the facts.
_WEATHER_CHECKS = {
    "humidity_range": "humidity_pct BETWEEN 0 AND 100",
    "precipitation_not_negative": "precipitation_mm >= 0",
    "wind_speed_not_negative": "wind_speed_mps >= 0",
    "pm10_not_negative": "pm10 >= 0",
    "pm25_not_negative": "pm25 >= 0",
}

_POPULATION_CHECKS = {"population_range": "population_min <= population_max"}

RAW = Table(
    "raw_api_response",
    "raw_id bigint, source_name string, area_code string, area_name string, "
    "requested_at timestamp, received_at timestamp, http_status int, result_code string, "
    "result_message string, payload_xml string, payload string, payload_hash string, "
    "is_success boolean, error_message string, ingest_date date",
    key=("raw_id",),
    required=("source_name", "area_name", "requested_at", "received_at", "is_success"),
    defaults={"source_name": f"'{SOURCE_NAME}'", "received_at": "current_timestamp()"},
    partition="ingest_date",
)

LOCATION_SOURCE_MAP = Table(
    "location_source_map",
    "source_name string, source_area_code string, source_area_name string, "
    "analysis_area_code string, analysis_area_name string, area_type string, "
    "district_name string, is_active boolean, valid_from date, valid_to date",
    key=("source_name", "source_area_code"),
    required=("source_name", "source_area_code", "is_active", "valid_from"),
    defaults={"is_active": "true", "valid_from": "current_date()"},
)

HEADER = Table(
    "realtime_city_header",
    "ingestion_id bigint, area_code string, area_name string, observed_at timestamp, "
    "collected_at timestamp, result_code string, result_message string, is_success boolean, "
    "loaded_at timestamp, ingest_date date",
    key=("ingestion_id",),
    required=("area_code", "area_name", "collected_at", "is_success"),
    references=(Reference(("ingestion_id",), "raw_api_response", ("raw_id",)),),
    partition="ingest_date",
    moving=True,
)

POPULATION = Table(
    "realtime_population_snapshot",
    "population_snapshot_id bigint, ingestion_id bigint, area_code string, "
    "observed_at timestamp, congestion_level string, congestion_message string, "
    f"population_min int, population_max int, {_RATIO_COLUMNS}, loaded_at timestamp, date_key int",
    key=("area_code", "observed_at"),
    other_keys=(("population_snapshot_id",),),
    required=("ingestion_id", "area_code", "observed_at"),
    checks=_POPULATION_CHECKS,
    references=(Reference(("ingestion_id",), "realtime_city_header", ("ingestion_id",)),),
    partition="date_key",
)

WEATHER = Table(
    "realtime_weather_snapshot",
    f"ingestion_id bigint, area_code string, observed_at timestamp, {_WEATHER_COLUMNS}, "
    "loaded_at timestamp, ingest_date date",
    key=("ingestion_id",),
    required=("area_code", "observed_at"),
    checks=_WEATHER_CHECKS,
    references=(Reference(("ingestion_id",), "realtime_city_header", ("ingestion_id",)),),
    partition="ingest_date",
    moving=True,
)

# Named by the table contract only; the feed has no loader for the next two.
EVENT = Table(
    "realtime_event",
    "staging_id bigint, area_code string, event_name string, event_start_at timestamp, "
    "event_end_at timestamp, venue_name string, event_category string, event_url string, "
    "source_event_id string, loaded_at timestamp",
    key=("staging_id", "event_name", "event_start_at"),
    required=("staging_id", "event_name", "event_start_at"),
)

SUBWAY = Table(
    "subway_station_daily",
    "subway_usage_id bigint, raw_id bigint, usage_date date, line_name string, "
    "station_id string, station_name string, boardings int, alightings int, "
    "source_registered_at date, loaded_at timestamp",
    key=("usage_date", "line_name", "station_id"),
    other_keys=(("subway_usage_id",),),
    required=("usage_date", "line_name", "station_id", "station_name", "boardings", "alightings"),
    checks={
        "boardings_not_negative": "boardings >= 0",
        "alightings_not_negative": "alightings >= 0",
    },
    references=(Reference(("raw_id",), "raw_api_response", ("raw_id",)),),
)

DIM_DATE = Table(
    "dim_date",
    "date_key int, full_date date, year smallint, quarter smallint, month smallint, "
    "day_of_month smallint, iso_day_of_week smallint, is_weekend boolean",
    key=("date_key",),
    other_keys=(("full_date",),),
    required=("full_date", "year", "quarter", "month", "day_of_month", "iso_day_of_week", "is_weekend"),
    checks={
        "quarter_range": "quarter BETWEEN 1 AND 4",
        "month_range": "month BETWEEN 1 AND 12",
        "day_range": "day_of_month BETWEEN 1 AND 31",
        "weekday_range": "iso_day_of_week BETWEEN 1 AND 7",
    },
)

DIM_HOUR = Table(
    "dim_hour",
    "hour_key smallint, hour_start string, hour_label string",
    key=("hour_key",),
    other_keys=(("hour_start",),),
    required=("hour_start", "hour_label"),
    checks={"hour_range": "hour_key BETWEEN 0 AND 23"},
)

DIM_LOCATION = Table(
    "dim_location",
    "location_id bigint, area_code string, area_name string, area_category string, "
    "latitude decimal(9,6), longitude decimal(9,6), timezone_name string, is_active boolean, "
    "created_at timestamp, updated_at timestamp",
    key=("area_code",),
    other_keys=(("location_id",),),
    required=("area_code", "area_name", "timezone_name", "is_active", "created_at", "updated_at"),
    checks={
        "latitude_range": "latitude BETWEEN -90 AND 90",
        "longitude_range": "longitude BETWEEN -180 AND 180",
    },
    defaults={
        "timezone_name": f"'{BUSINESS_ZONE}'",
        "is_active": "true",
        "created_at": "current_timestamp()",
        "updated_at": "current_timestamp()",
    },
)

FACT_CITY = Table(
    "fact_city_snapshot",
    "city_snapshot_id bigint, location_id bigint, date_key int, hour_key smallint, "
    "observed_at timestamp, collected_at timestamp, congestion_level string, "
    f"congestion_message string, population_min int, population_max int, {_RATIO_COLUMNS}, "
    "source_ingestion_id bigint, dw_loaded_at timestamp, dw_updated_at timestamp",
    key=("location_id", "observed_at"),
    other_keys=(("city_snapshot_id",),),
    required=(
        "city_snapshot_id", "location_id", "date_key", "hour_key", "observed_at", "collected_at", "source_ingestion_id",
    ),
    checks=_POPULATION_CHECKS,
    references=_DIM_REFERENCES,
    partition="date_key",
)

FACT_WEATHER = Table(
    "fact_weather_snapshot",
    "weather_snapshot_id bigint, location_id bigint, date_key int, hour_key smallint, "
    f"observed_at timestamp, collected_at timestamp, {_WEATHER_COLUMNS}, "
    "source_ingestion_id bigint, dw_loaded_at timestamp, dw_updated_at timestamp",
    key=("location_id", "observed_at"),
    other_keys=(("weather_snapshot_id",),),
    required=(
        "weather_snapshot_id", "location_id", "date_key", "hour_key", "observed_at", "collected_at", "source_ingestion_id",
    ),
    checks=_WEATHER_CHECKS,
    references=_DIM_REFERENCES,
    partition="date_key",
)

TABLES = {
    t.name: t
    for t in (
        RAW, LOCATION_SOURCE_MAP, HEADER, POPULATION, WEATHER, EVENT, SUBWAY,
        DIM_DATE, DIM_HOUR, DIM_LOCATION, FACT_CITY, FACT_WEATHER,
    )
}
