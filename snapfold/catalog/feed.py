"""A document feed derived from the ``events`` table: one document per event.

Every event becomes one source call with a population and a weather record.  The
number in ``props`` decides what, if anything, is wrong with the document, so each
gate has its share of failing documents at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed_values import BUSINESS_ZONE, SOURCE_NAME, SUCCESS_ROOT
from ..functions import clock
from ..functions.once import once, spread
from ..operators import dimensions
from ..schemas import POPULATION, WEATHER

AREAS = 25

# props number -> what is wrong with the document
REASONS_BY_K = {
    3: ("xml_parse_failed", "not_success"),
    7: ("not_success", "envelope_missing"),
    11: ("not_success",),
    13: ("not_success", "bad_result_code"),
    17: ("not_success", "citydata_missing"),
    19: ("citydata_key_missing",),
    21: ("citydata_key_missing",),
    23: ("population_container",),
    25: ("citydata_key_missing",),
    27: ("population_container",),
    29: ("population_object",),
    31: ("population_key_missing",),
    33: ("population_object",),
    37: ("population_not_int",),
    41: ("population_range",),
    43: ("population_time",),
    47: ("ratio_not_number",),
    51: ("payload_missing", "not_success"),
    53: ("wrong_source",),
    55: ("xml_parse_failed", "not_success"),
    57: ("population_key_missing", "ratio_not_number"),
}
WEATHER_SKIPPED = (59, 61, 67)
WEATHER_REASONS_BY_K = {71: "weather_time", 73: "weather_number", 77: "weather_time"}
WEATHER_BROKEN = {
    79: "humidity_range",
    89: "precipitation_not_negative",
    91: "wind_speed_not_negative",
    93: "pm10_not_negative",
    95: "pm25_not_negative",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _floor_minutes(instant: Column, minutes: int) -> Column:
    step = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_seconds(instant) / step) * step)


def base(events: DataFrame) -> DataFrame:
    """The numbers every part of a document is made of."""
    at = clock.utc_instant(F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("int")
    area = F.pmod(F.col("user_id"), F.lit(AREAS)).cast("int").cast("string")
    cents = (F.col("value").cast("decimal(12,2)") * 100).cast("int")
    return once(events, k=k, cents=cents).select(
        F.col("event_id").alias("raw_id"),
        "k",
        "cents",
        "event_type",
        F.concat(F.lit("POI"), F.lpad(area, 3, "0")).alias("poi"),
        F.concat(F.lit("NATION_"), area).alias("place"),
        _floor_minutes(at, 5).alias("population_at"),
        _floor_minutes(at, 10).alias("weather_at"),
        F.when(_k(97), at - F.expr("INTERVAL 1 HOUR"))
        .otherwise(at + F.make_dt_interval(secs=F.col("k") * 10))
        .alias("requested_at"),
    )


def _element(name: str, value: Column) -> Column:
    """An element; a NULL value leaves it out, an empty one leaves it empty."""
    text = F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    return F.coalesce(text, F.lit(""))


def _k(*numbers: int) -> Column:
    return F.col("k").isin(*numbers)


def _level() -> Column:
    labels = {"click": "여유", "view": "보통", "signup": "약간 붐빔", "purchase": "붐빔"}
    level = F.when(F.col("k") == 1, "모름")
    for kind, label in labels.items():
        level = level.when(F.col("event_type") == kind, label)
    return level.otherwise("매우 붐빔")


def _rain() -> Column:
    k = F.col("k")
    return F.when(k < 60, "없음").when(k < 80, "비").when(k < 90, "눈").otherwise("")


def _air() -> Column:
    kind = F.col("event_type")
    return F.when(kind.isin("click", "view"), "좋음").when(kind == "signup", "보통").otherwise("나쁨")


def _population_xml() -> Column:
    k, kt = F.col("k"), F.col("k").cast("string")
    local = clock.local_time(F.col("population_at"), BUSINESS_ZONE)
    low = F.col("cents") + 100
    low_text = (
        F.when(_k(37), "12.0").when(_k(57), "")
        .when(_k(5), F.concat(F.lit("  "), low.cast("string"), F.lit(" \n")))
        .otherwise(low.cast("string"))
    )
    high = F.when(_k(41), low - 1).otherwise(low + 10 * k)
    male = (
        F.when(_k(2, 4), "*").when(_k(6, 8), "").when(_k(10, 12), "\\N")
        .when(_k(47, 57), "abc").otherwise(F.concat(kt, F.lit(".25")))
    )
    time = (
        F.when(_k(43), "yesterday").when(_k(45), F.date_format(local, "yyyy-M-d H:m"))
        .otherwise(F.date_format(local, "yyyy-MM-dd HH:mm"))
    )
    fields = {
        "AREA_CONGEST_LVL": F.when(_k(31), "").otherwise(_level()),
        "AREA_CONGEST_MSG": F.when(k % 2 == 0, F.concat(F.lit("level "), kt)),
        "AREA_PPLTN_MIN": low_text,
        "AREA_PPLTN_MAX": high.cast("string"),
        "MALE_PPLTN_RATE": male,
        "FEMALE_PPLTN_RATE": F.concat((99 - k).cast("string"), F.lit(".75")),
        "RESNT_PPLTN_RATE": F.concat(kt, F.lit(".005")),
        "NON_RESNT_PPLTN_RATE": F.when(k < 50, F.concat(kt, F.lit(".5"))),
        "PPLTN_TIME": time,
    }
    record = F.concat(*[_element(n, v) for n, v in fields.items()])
    one = _element("LIVE_PPLTN_STTS", record)
    block = _element("LIVE_PPLTN_STTS", one)
    return (
        F.when(_k(23), "<LIVE_PPLTN_STTS>closed</LIVE_PPLTN_STTS>").when(_k(25), "")
        .when(_k(27), F.concat(block, block))
        .when(_k(29), _element("LIVE_PPLTN_STTS", F.concat(one, one)))
        .when(_k(33), "<LIVE_PPLTN_STTS><LIVE_PPLTN_STTS/></LIVE_PPLTN_STTS>")
        .otherwise(block)
    )


def _weather_xml() -> Column:
    k, kt = F.col("k"), F.col("k").cast("string")
    local = clock.local_time(F.col("weather_at"), BUSINESS_ZONE)
    hundredths = F.lit(100).cast("decimal(5,0)")

    def in_units(cents: Column) -> Column:
        return (cents / hundredths).cast("decimal(7,2)").cast("string")

    fields = {
        "WEATHER_TIME": F.when(_k(77), "noon").when(~_k(71), F.date_format(local, "yyyy-MM-dd HH:mm")),
        "TEMP": F.when(_k(73), "abc").when(_k(14, 16), "-").when(_k(18, 20), "없음")
        .otherwise(in_units(F.col("cents") - 5000)),
        "HUMIDITY": F.when(_k(79), "101").otherwise(kt),
        "PRECIPITATION": F.when(_k(89), "-1").when(k < 60, "-").otherwise(in_units(F.col("cents"))),
        "PRECPT_TYPE": _rain(),
        "WIND_SPD": F.when(_k(91), "-1.0").otherwise(
            (k / F.lit(10).cast("decimal(3,0)")).cast("decimal(5,1)").cast("string")
        ),
        "PM10": F.when(_k(93), "-3").otherwise((k * 2).cast("string")),
        "PM25": F.when(_k(95), "-0.5").otherwise(kt),
        "AIR_IDX": _air(),
        "AIR_MSG": F.concat(F.lit("air "), F.col("event_type")),
        "PCP_MSG": F.when(k >= 60, "rain"),
        "UV_MSG": F.concat(F.lit("uv "), kt),
    }
    one = _element("WEATHER_STTS", F.concat(*[_element(n, v) for n, v in fields.items()]))
    return (
        F.when(_k(59), "").when(_k(61), "<WEATHER_STTS><WEATHER_STTS></WEATHER_STTS></WEATHER_STTS>")
        .when(_k(67), _element("WEATHER_STTS", F.concat(one, one)))
        .otherwise(_element("WEATHER_STTS", one))
    )


def documents(events: DataFrame) -> DataFrame:
    """Landing rows for :func:`snapfold.operators.documents.classify`."""
    city = F.concat(
        _element("AREA_CD", F.when(~_k(19), F.col("poi"))),
        _element("AREA_NM", F.when(_k(21), "").otherwise(F.col("place"))),
        F.col("population_xml"),
        F.col("weather_xml"),
    )
    code = F.when(_k(13), "INFO-200").otherwise("INFO-000")
    result = _element(
        "RESULT", F.concat(_element("RESULT.CODE", code), _element("RESULT.MESSAGE", F.lit("answered")))
    )
    body = _element(
        SUCCESS_ROOT, F.concat(result, _element("CITYDATA", F.when(_k(17), "").otherwise(city)))
    )
    error = "<RESULT><CODE>ERROR-500</CODE><MESSAGE>no data</MESSAGE></RESULT>"
    xml = (
        F.when(_k(51), F.lit(None).cast("string"))
        .when(_k(3), F.concat(F.lit(f"<{SUCCESS_ROOT}>"), result))
        .when(_k(7), error)
        .when(_k(55), F.concat(body, F.lit("rest")))
        .otherwise(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n'), body))
    )
    with_parts = once(base(events), population_xml=_population_xml())
    with_parts = once(with_parts, weather_xml=_weather_xml())
    return once(with_parts, payload_xml=xml).select(
        "raw_id",
        F.when(_k(53), "other_source").otherwise(SOURCE_NAME).alias("source_name"),
        F.col("place").alias("request_area_name"),
        "requested_at",
        (F.col("requested_at") + F.expr("INTERVAL 1 SECOND")).alias("received_at"),
        F.when(_k(11), 500).otherwise(200).alias("http_status"),
        "payload_xml",
    )


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spread(table(spark, sf_dir, "events")))


# ---- the same records as typed rows, for queries that start after parsing ------------


def population_rows(events: DataFrame) -> DataFrame:
    """What the population staging gets per ingestion, made straight from the events."""
    k = F.col("k")
    low = F.col("cents") + 100
    rows = base(events).where(~_k(*REASONS_BY_K))

    def rate(value: Column) -> Column:
        return value.cast("decimal(5,2)")

    return rows.select(
        F.col("raw_id").alias("population_snapshot_id"),
        F.col("raw_id").alias("ingestion_id"),
        F.col("poi").alias("area_code"),
        F.col("population_at").alias("observed_at"),
        _level().alias("congestion_level"),
        F.when(k % 2 == 0, F.concat(F.lit("level "), k.cast("string"))).alias("congestion_message"),
        low.alias("population_min"),
        (low + 10 * k).alias("population_max"),
        F.when(~_k(2, 4, 6, 8, 10, 12), rate(k + F.expr("0.25BD"))).alias("male_ratio"),
        rate(F.expr("99.75BD") - k).alias("female_ratio"),
        rate(k + F.expr("0.01BD")).alias("resident_ratio"),
        F.when(k < 50, rate(k + F.expr("0.50BD"))).alias("non_resident_ratio"),
        F.col("requested_at").alias("loaded_at"),
        clock.date_key(clock.local_time(F.col("population_at"))).alias("date_key"),
        F.col("place").alias("area_name"),
        F.col("requested_at").alias("collected_at"),
    ).select(*POPULATION.columns, "area_name", "collected_at")


def weather_rows(events: DataFrame, broken: bool = False) -> DataFrame:
    """What the weather staging gets per ingestion; ``broken`` rows fail its checks."""
    k, cents = F.col("k"), F.col("cents")
    left_out = {*REASONS_BY_K, *WEATHER_SKIPPED, *WEATHER_REASONS_BY_K}
    if not broken:
        left_out |= set(WEATHER_BROKEN)
    rows = base(events).where(~_k(*sorted(left_out)))

    def number(value: Column, target: str) -> Column:
        return value.cast(target)

    hundredths = F.lit(100).cast("decimal(5,0)")
    no_number = F.lit(None).cast("decimal(5,2)")
    return rows.select(
        F.col("raw_id").alias("ingestion_id"),
        F.col("poi").alias("area_code"),
        F.col("weather_at").alias("observed_at"),
        F.when(~_k(14, 16, 18, 20), number((cents - 5000) / hundredths, "decimal(5,2)")).alias("temperature_c"),
        no_number.alias("feels_like_c"),
        number(F.when(_k(79), 101).otherwise(k), "decimal(5,2)").alias("humidity_pct"),
        F.nullif(_rain(), F.lit("")).alias("precipitation_type"),
        F.when(_k(89), number(F.lit(-1), "decimal(7,2)"))
        .when(k >= 60, number(cents / hundredths, "decimal(7,2)")).alias("precipitation_mm"),
        number(F.when(_k(91), -10).otherwise(k) / F.lit(10).cast("decimal(3,0)"), "decimal(6,2)").alias("wind_speed_mps"),
        no_number.cast("decimal(6,2)").alias("wind_direction_deg"),
        number(F.when(_k(93), -3).otherwise(k * 2), "decimal(8,2)").alias("pm10"),
        F.when(_k(95), F.expr("CAST(-0.5 AS decimal(8,2))")).otherwise(number(k, "decimal(8,2)")).alias("pm25"),
        _air().alias("air_quality_index"),
        F.concat_ws(
            "\n", F.concat(F.lit("air "), F.col("event_type")), F.when(k >= 60, "rain"),
            F.concat(F.lit("uv "), k.cast("string")),
        ).alias("weather_description"),
        F.col("requested_at").alias("loaded_at"),
        clock.local_time(F.col("requested_at"), "UTC").cast("date").alias("ingest_date"),
        F.col("place").alias("area_name"),
        F.col("requested_at").alias("collected_at"),
    ).select(*WEATHER.columns, "area_name", "collected_at")


def header_rows(events: DataFrame) -> DataFrame:
    rows = base(events).where(~_k(*REASONS_BY_K))
    return rows.select(
        F.col("raw_id").alias("ingestion_id"),
        F.col("poi").alias("area_code"),
        F.col("place").alias("area_name"),
        F.col("population_at").alias("observed_at"),
        F.col("requested_at").alias("collected_at"),
        F.lit(True).alias("is_success"),
    )


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        (key + 1).cast("bigint").alias("location_id"),
        F.concat(F.lit("POI"), F.lpad(key.cast("string"), 3, "0")).alias("area_code"),
        F.col("n_name").alias("area_name"),
    )


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every local day from the first event's to the last event's."""
    local = clock.local_time(clock.utc_instant(F.col("ts"))).cast("date")
    span = table(spark, sf_dir, "events").agg(
        F.min(local).alias("first_day"), F.max(local).alias("last_day")
    )
    return dimensions.dim_date(span)


def dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return dim_location(spark, sf_dir), dim_date(spark, sf_dir), dimensions.dim_hour(spark)
