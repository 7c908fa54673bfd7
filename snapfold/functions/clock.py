"""Business-zone clock: texts to instants, instants to local date and hour keys.

Every function goes through ``timestamp_ntz`` and names both zones, so results do
not depend on the session time zone, but for the hour that a session zone with
clock changes repeats in autumn.  UTC sessions have no such hour.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import BUSINESS_ZONE, MINUTE_PATTERN
from .text import strip


def utc_instant(wall_clock: Column) -> Column:
    """A zone-less UTC time as an instant."""
    ntz = wall_clock.cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ntz).cast("timestamp")


def utc_text(instant: Column) -> Column:
    ntz = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
    return F.date_format(ntz, "yyyy-MM-dd HH:mm:ss")


def local_time(instant: Column, zone: str = BUSINESS_ZONE) -> Column:
    """The wall clock of ``zone`` at an instant."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def from_local(wall_clock: Column, zone: str = BUSINESS_ZONE) -> Column:
    """The instant at which the wall clock of ``zone`` shows this time."""
    ntz = wall_clock.cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.current_timezone(), ntz).cast("timestamp")


def parse_minute(text: Column, zone: str = BUSINESS_ZONE, clean: bool = False) -> Column:
    """``YYYY-MM-DD HH:MM`` local text as an instant, NULL when it is no such text."""
    stripped = text if clean else strip(text)
    return from_local(F.call_function("try_to_timestamp", stripped, F.lit(MINUTE_PATTERN)), zone)


def parse_iso(text: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Zone-less ISO text with seconds as an instant, NULL when it is no such text."""
    return from_local(strip(text).try_cast("timestamp_ntz"), zone)


def date_key(local: Column) -> Column:
    return (F.year(local) * 10000 + F.month(local) * 100 + F.dayofmonth(local)).cast("int")


def hour_key(local: Column) -> Column:
    return F.hour(local).cast("smallint")


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of one calendar day, named as in ``dim_date``."""
    iso_day = F.weekday(day) + 1
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        iso_day.cast("smallint").alias("iso_day_of_week"),
        (iso_day >= 6).alias("is_weekend"),
    ]


def hour_columns(hour: Column) -> list[Column]:
    """The attributes of one hour of the day, named as in ``dim_hour``."""
    two_digits = F.lpad(hour.cast("string"), 2, "0")
    return [
        hour.cast("smallint").alias("hour_key"),
        F.concat(two_digits, F.lit(":00:00")).alias("hour_start"),
        F.concat(two_digits, F.lit(":00")).alias("hour_label"),
    ]
