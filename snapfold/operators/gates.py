"""Quality gates: split a batch into accepted and quarantined rows.

A broken document never stops the batch.  Each rule is one boolean column; a rule
whose subject is missing stays silent, because the rule for the missing subject
already speaks.  ``reasons`` lists every violated rule in the order the checks are
made, ``reason`` is the first of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import SOURCE_NAME, SUCCESS_CODE
from ..functions import clock, numbers
from ..functions.once import apart
from .documents import WEATHER_NUMBERS


class GateError(Exception):
    """Raised by :func:`require_clean` when a batch holds quarantined rows."""


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    codes = F.array(*[F.when(_true(violated), F.lit(code)) for code, violated in rules.items()])
    listed = apart(df, reasons=F.array_compact(codes))
    return listed.withColumn("reason", F.get(F.col("reasons"), F.lit(0)))


def document_rules(source_name: str = SOURCE_NAME) -> dict[str, Column]:
    """Rules over raw rows with the parts of ``documents.read_documents``."""
    parsed, envelope, part = F.col("well_formed"), F.col("is_envelope"), F.col("population")
    city, state = F.col("city"), F.col("population_state")
    no_payload = ~F.col("has_payload")
    needed = ("time_text", "congestion_level", "min_text", "max_text")
    key_missing = F.lit(False)
    for name in needed:
        key_missing = key_missing | part[name].isNull()
    given = part["min_text"].isNotNull() & part["max_text"].isNotNull()
    low, high = part["population_min"], part["population_max"]
    return {
        "wrong_source": ~F.col("source_name").eqNullSafe(source_name),
        "payload_missing": no_payload,
        "xml_parse_failed": ~no_payload & ~parsed,
        "not_success": ~_true(F.col("is_success")),
        "envelope_missing": parsed & ~envelope,
        "bad_result_code": envelope & ~F.col("outcome.code").eqNullSafe(SUCCESS_CODE),
        "citydata_missing": envelope & city.isNull(),
        "citydata_key_missing": city.isNotNull()
        & (city["area_name"].isNull() | city["area_code"].isNull() | (state == "missing")),
        "field_repeated": F.col("field_repeated"),
        "population_container": city.isNotNull() & (state == "not_object"),
        "population_object": city.isNotNull() & (state == "ok") & part.isNull(),
        "population_key_missing": part.isNotNull() & key_missing,
        "population_not_int": given & (low.isNull() | high.isNull()),
        "population_range": low > high,
        "population_time": part["time_text"].isNotNull() & part["observed_at"].isNull(),
        "ratio_not_number": part["ratio_is_junk"],
    }


def document_gate(read: DataFrame, source_name: str = SOURCE_NAME) -> DataFrame:
    return _with_reasons(read, document_rules(source_name))


def json_rules() -> dict[str, Column]:
    """Rules of the JSON feed: keys must be present, the population a non-empty list."""
    city, people, part = F.col("city"), F.col("city.LIVE_PPLTN_STTS"), F.col("population")
    required = ("PPLTN_TIME", "AREA_CONGEST_LVL", "AREA_PPLTN_MIN", "AREA_PPLTN_MAX")
    key_missing = F.lit(False)
    for name in required:
        key_missing = key_missing | part[name].isNull()
    given = F.col("well_formed") & city.isNotNull()
    time = part["PPLTN_TIME"]
    low, high = part["AREA_PPLTN_MIN"], part["AREA_PPLTN_MAX"]
    low_int, high_int = numbers.strict_int(low), numbers.strict_int(high)
    return {
        "payload_missing": F.col("payload").isNull(),
        "json_parse_failed": F.col("payload").isNotNull() & ~F.col("well_formed"),
        "not_success": ~_true(F.col("is_success")),
        "citydata_missing": F.col("well_formed") & city.isNull(),
        "citydata_key_missing": given & (city["AREA_NM"].isNull() | city["AREA_CD"].isNull()),
        "population_container": given & ~_true(F.size(people) > 0),
        "population_key_missing": part.isNotNull() & key_missing,
        "population_not_int": low.isNotNull() & high.isNotNull() & (low_int.isNull() | high_int.isNull()),
        "population_range": low_int > high_int,
        "population_time": time.isNotNull() & clock.parse_iso(time).isNull(),
    }


def json_gate(read: DataFrame) -> DataFrame:
    return _with_reasons(read, json_rules())


def weather_rules() -> dict[str, Column]:
    """Rules of the optional weather record; they never touch the population."""
    part = F.col("weather")
    time = part["WEATHER_TIME"]
    junk = F.lit(False)
    for source, target in WEATHER_NUMBERS.values():
        junk = junk | numbers.weather_number_is_junk(part[source], target, clean=True)
    return {
        "weather_repeated": F.col("weather_repeated"),
        "weather_time": part.isNotNull() & (time.isNull() | clock.parse_minute(time, clean=True).isNull()),
        "weather_number": part.isNotNull() & junk,
    }


def weather_gate(valid: DataFrame) -> DataFrame:
    return _with_reasons(valid, weather_rules())


def accepted(gated: DataFrame) -> DataFrame:
    return gated.where(F.size("reasons") == 0).drop("reasons", "reason")


def rejected(gated: DataFrame) -> DataFrame:
    return gated.where(F.size("reasons") > 0)


def reason_counts(gated: DataFrame) -> DataFrame:
    return (
        gated.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("documents"))
    )


def weather_skipped(valid: DataFrame) -> DataFrame:
    """How many accepted documents have, and lack, a usable weather record."""
    return valid.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("weather").isNull()).alias("weather_skipped"),
    )


def missing_raw(ids: DataFrame, raw: DataFrame) -> DataFrame:
    """Asked-for ids that have no raw row."""
    return ids.join(raw.select("raw_id"), "raw_id", "left_anti").withColumn(
        "reason", F.lit("raw_missing")
    )


def require_clean(gated: DataFrame) -> DataFrame:
    """The accepted rows; raises when any row was quarantined."""
    first = rejected(gated).select("reason").take(1)
    if first:
        raise GateError(f"batch holds quarantined rows, first reason: {first[0].reason}")
    return accepted(gated)


def area_count_gate(active: DataFrame, expected: int) -> DataFrame:
    """One row: how many areas are active, and whether that is the expected number."""
    count = F.count(F.lit(1))
    return active.agg(
        count.alias("active_areas"),
        F.lit(expected).alias("expected_areas"),
        F.when(count == 0, F.lit("no_active_area"))
        .when(count != expected, F.lit("area_count"))
        .otherwise(F.lit("ok"))
        .alias("status"),
    )


def require_area_count(active: DataFrame, expected: int) -> DataFrame:
    row = area_count_gate(active, expected).first()
    if row.status != "ok":
        raise GateError(f"{row.active_areas} active areas, expected {expected}")
    return active
