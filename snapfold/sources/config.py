"""Configuration of the collected areas: who is active, and when a row is valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import BUSINESS_ZONE, SOURCE_NAME
from ..operators.lookup import lookup


def business_today() -> Column:
    return F.convert_timezone(
        F.current_timezone(), F.lit(BUSINESS_ZONE), F.current_timestamp().cast("timestamp_ntz")
    ).cast("date")


def _valid_on(day: Column) -> Column:
    open_ended = F.col("valid_to").isNull()
    return (F.col("valid_from") <= day) & (open_ended | (F.col("valid_to") >= day))


def active_locations(
    config: DataFrame, as_of: Column | None = None, source_name: str = SOURCE_NAME
) -> DataFrame:
    """Areas to collect on a day, in the order of their analysis code."""
    day = business_today() if as_of is None else as_of
    return (
        config.where((F.col("source_name") == source_name) & F.col("is_active") & _valid_on(day))
        .select(
            F.col("source_area_name").alias("request_area_name"),
            "analysis_area_code", "analysis_area_name", "area_type", "district_name",
        )
        .orderBy("analysis_area_code", "request_area_name")
    )


def requests_of(feed: DataFrame, active: DataFrame) -> DataFrame:
    """Feed rows whose requested area is active."""
    names = active.select("request_area_name").distinct()
    return lookup(feed, names, ["request_area_name"], "left_semi")


def valid_at_request(feed: DataFrame, config: DataFrame, day: Column) -> DataFrame:
    """Feed rows with the configuration that was valid on the day of the request.

    The area name is an equality, the interval a filter on the matched pairs.
    """
    rows = config.where("is_active").withColumnRenamed("source_area_name", "request_area_name").drop("source_name")
    joined = lookup(feed.withColumn("_day", day), rows, ["request_area_name"])
    return joined.where(_valid_on(F.col("_day"))).drop("_day")
