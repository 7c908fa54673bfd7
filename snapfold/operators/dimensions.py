"""Dimensions: static calendars and the change-only location dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed_values import BUSINESS_ZONE
from ..functions import clock
from ..schemas import DIM_DATE, DIM_HOUR, DIM_LOCATION
from .ids import dense_ids
from .upsert import RULES, latest, upsert


def dim_date(span: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day between the two dates of a one-row DataFrame."""
    days = span.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("day"))
    return days.select(*clock.calendar_columns(F.col("day"))).select(*DIM_DATE.columns)


def dim_date_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    span = spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )
    return dim_date(span)


def dim_hour(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(*clock.hour_columns(F.col("id"))).select(*DIM_HOUR.columns)


def location_arrivals(view: DataFrame, stamp: Column) -> DataFrame:
    """The areas a batch brings, one row each: its last arrival."""
    named = view.select("area_code", "area_name", "ingestion_id")
    last = latest(named, ["area_code"], ["ingestion_id"])
    return last.select(
        F.lit(None).cast("bigint").alias("location_id"),
        "area_code",
        "area_name",
        F.lit(None).cast("string").alias("area_category"),
        F.lit(None).cast("decimal(9,6)").alias("latitude"),
        F.lit(None).cast("decimal(9,6)").alias("longitude"),
        F.lit(BUSINESS_ZONE).alias("timezone_name"),
        F.lit(True).alias("is_active"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    ).select(*DIM_LOCATION.columns)


def upsert_locations(stored: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Merge areas into the dimension; an unchanged area keeps its ``updated_at``.

    New areas get the next ids, in the order of :func:`ids.dense_ids`.
    """
    rule = RULES["dim_location"]
    merged = upsert(stored, arrivals, rule["keys"], changed=rule["changed"], keep=rule["keep"])
    after_last = stored.agg(F.coalesce(F.max("location_id"), F.lit(0)) + 1).scalar()
    fresh = merged.where("location_id IS NULL").drop("location_id")
    numbered = dense_ids(fresh, "area_code", "location_id", after_last)
    return merged.where("location_id IS NOT NULL").unionByName(numbered)
