"""Load audits: counts of what is wrong with the facts of each ingestion.

An audit starts from the batch's ids, so an ingestion without a fact shows up with
``fact_count = 0``.  Dimension checks go through :func:`lookup.lookup`; the staging
check and the final group-by share the ingestion id, which spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock
from .lookup import lookup


def _with_references(facts: DataFrame, dim_location, dim_date, dim_hour) -> DataFrame:
    """Facts with the area code of their location and a found-flag per dimension."""
    location = dim_location.select("location_id", "area_code", F.lit(True).alias("has_location"))
    date = dim_date.select("date_key", F.lit(True).alias("has_date"))
    hour = dim_hour.select("hour_key", F.lit(True).alias("has_hour"))
    with_location = lookup(facts, location, ["location_id"], "left")
    with_date = lookup(with_location, date, ["date_key"], "left")
    return with_date.join(F.broadcast(hour), "hour_key", "left")  # 24 rows by its key


def reference_audit(facts: DataFrame, dim_location, dim_date, dim_hour) -> DataFrame:
    """Over all facts: how many miss a location, a date or an hour."""
    return _with_references(facts, dim_location, dim_date, dim_hour).agg(
        F.count(F.lit(1)).alias("fact_count"), *_reference_metrics()
    )


def _reference_metrics() -> list[Column]:
    return [
        F.count_if(F.col("has_location").isNull()).alias("missing_location_count"),
        F.count_if(F.col("has_date").isNull()).alias("missing_date_count"),
        F.count_if(F.col("has_hour").isNull()).alias("missing_hour_count"),
    ]


def _time_metrics() -> list[Column]:
    local = clock.local_time(F.col("observed_at"))
    wrong = (F.col("date_key") != clock.date_key(local)) | (F.col("hour_key") != clock.hour_key(local))
    return [
        F.count_if(F.col("observed_at") > F.col("collected_at")).alias("future_observation_count"),
        F.count_if(wrong).alias("time_key_mismatch_count"),
    ]


def _beside_staging(facts: DataFrame, staging: DataFrame, compare: list[str]) -> DataFrame:
    """Facts beside the staging row of the same ingestion, area and observation."""
    side = staging.select(
        F.col("ingestion_id").alias("source_ingestion_id"), "area_code", "observed_at",
        F.lit(True).alias("has_staging"), *[F.col(c).alias(f"staging_{c}") for c in compare],
    )
    return facts.join(side, ["source_ingestion_id", "area_code", "observed_at"], "left")


def _differs(compare: list[str]) -> Column:
    differs = F.lit(False)
    for name in compare:
        differs = differs | ~F.col(name).eqNullSafe(F.col(f"staging_{name}"))
    return F.col("has_staging") & differs


def _per_ingestion(ids: DataFrame, counted: DataFrame) -> DataFrame:
    metrics = [c for c in counted.columns if c != "ingestion_id"]
    return ids.select("ingestion_id").join(counted, "ingestion_id", "left").select(
        "ingestion_id", *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in metrics]
    )


def audit_city(ids, facts, staging, dim_location, dim_date, dim_hour) -> DataFrame:
    """Nine metrics per ingestion of the city fact."""
    compare = ["population_min", "population_max"]
    beside = _beside_staging(
        _with_references(facts, dim_location, dim_date, dim_hour), staging, compare
    )
    counted = beside.groupBy(F.col("source_ingestion_id").alias("ingestion_id")).agg(
        F.count(F.lit(1)).alias("fact_count"),
        *_reference_metrics(),
        F.count_if(F.col("population_min") > F.col("population_max")).alias("invalid_population_range_count"),
        *_time_metrics(),
        F.count_if(F.col("has_staging").isNull()).alias("missing_staging_population_count"),
        F.count_if(_differs(compare)).alias("staging_fact_population_mismatch_count"),
    )
    return _per_ingestion(ids, counted)


def audit_weather(ids, facts, staging, dim_location, dim_date, dim_hour) -> DataFrame:
    """Thirteen metrics per ingestion of the weather fact."""
    compare = ["temperature_c", "humidity_pct", "precipitation_mm", "wind_speed_mps", "pm10", "pm25"]
    beside = _beside_staging(
        _with_references(facts, dim_location, dim_date, dim_hour), staging, compare
    )
    counted = beside.groupBy(F.col("source_ingestion_id").alias("ingestion_id")).agg(
        F.count(F.lit(1)).alias("fact_count"),
        *_reference_metrics(),
        F.count_if(~F.col("humidity_pct").between(0, 100)).alias("invalid_humidity_count"),
        F.count_if(F.col("precipitation_mm") < 0).alias("invalid_precipitation_count"),
        F.count_if(F.col("wind_speed_mps") < 0).alias("invalid_wind_speed_count"),
        F.count_if(F.col("pm10") < 0).alias("invalid_pm10_count"),
        F.count_if(F.col("pm25") < 0).alias("invalid_pm25_count"),
        *_time_metrics(),
        F.count_if(F.col("has_staging").isNull()).alias("missing_staging_weather_count"),
        F.count_if(_differs(compare)).alias("staging_fact_weather_mismatch_count"),
    )
    return _per_ingestion(ids, counted)


# Measured, but no reason to fail a load.
CITY_NOT_GATED = ("missing_staging_population_count",)


def violations(audit: DataFrame, not_gated: tuple[str, ...] = ()) -> DataFrame:
    """Add ``violations``: a map of the gated metrics that are not zero."""
    gated = [c for c in audit.columns if c not in ("ingestion_id", "fact_count", *not_gated)]
    pairs = [item for name in gated for item in (F.lit(name), F.col(name))]
    return audit.withColumn("violations", F.map_filter(F.create_map(*pairs), lambda _, n: n != 0))


def load_status(
    audit: DataFrame, arrivals: DataFrame, facts: DataFrame, not_gated: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``status`` to an audit: ok, violated, superseded, missing or duplicated.

    ``arrivals`` are the fact rows the batch offered.  An ingestion whose key is held
    by a newer fact has been superseded, which is not a fault.
    """
    # Keys first, then rows: a key with many arrivals is one row in the first join, and
    # the keys that facts lack are few and spread by the lookup.
    key = ["location_id", "observed_at"]
    lost = arrivals.select(*key).distinct().join(facts.select(*key), key, "left_anti")
    offered = (
        lookup(arrivals.select("source_ingestion_id", *key), lost, key, "left_anti")
        .groupBy(F.col("source_ingestion_id").alias("ingestion_id"))
        .agg(F.lit(True).alias("superseded"))
    )
    status = (
        F.when((F.col("fact_count") == 0) & F.col("superseded"), "superseded")
        .when(F.col("fact_count") == 0, "missing")
        .when(F.col("fact_count") > 1, "duplicated")
        .when(F.size("violations") > 0, "violated")
        .otherwise("ok")
    )
    return (
        violations(audit, not_gated)
        .join(offered, "ingestion_id", "left")
        .withColumn("status", status)
        .drop("superseded")
    )


def reconcile(staging: DataFrame, facts: DataFrame, dim_location: DataFrame, compare: list[str]) -> DataFrame:
    """Lineage compare: facts whose staging row of the same ingestion says otherwise."""
    located = lookup(facts, dim_location.select("location_id", "area_code"), ["location_id"], "left")
    beside = _beside_staging(located, staging, compare)
    return beside.where(_differs(compare)).select(
        "source_ingestion_id", "area_code", "observed_at",
        *[c for name in compare for c in (name, f"staging_{name}")],
    )
