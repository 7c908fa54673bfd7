"""Documents: parse XML or JSON texts, classify responses, pick out the records.

Input of :func:`classify` is a landing DataFrame with one row per source call::

    raw_id, source_name, request_area_name, requested_at, received_at,
    http_status, payload_xml

Everything here is narrow: no shuffle happens before the first upsert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import SUCCESS_CODE, SUCCESS_ROOT
from ..functions import clock, numbers, text
from ..functions.once import apart, once
from ..functions.xml_json import xml_to_json

POPULATION_FIELDS = (
    "PPLTN_TIME", "AREA_CONGEST_LVL", "AREA_CONGEST_MSG", "AREA_PPLTN_MIN", "AREA_PPLTN_MAX",
    "MALE_PPLTN_RATE", "FEMALE_PPLTN_RATE", "RESNT_PPLTN_RATE", "NON_RESNT_PPLTN_RATE",
)
WEATHER_FIELDS = (
    "WEATHER_TIME", "TEMP", "HUMIDITY", "PRECIPITATION", "PRECPT_TYPE", "WIND_SPD",
    "PM10", "PM25", "AIR_IDX", "AIR_MSG", "PCP_MSG", "UV_MSG",
)


def _record(fields: tuple[str, ...], kind: str = "string") -> str:
    return "struct<" + ",".join(f"{name}:{kind}" for name in fields) + ">"


def _block(name: str, fields: tuple[str, ...]) -> str:
    # Arrays at every level: of a plain field the reader keeps the last repeat silently.
    # ``_VALUE`` takes text found where an element was expected.
    return f"{name}:array<struct<_VALUE:string,{name}:array<{_record(fields, 'array<string>')}>>>"


DOCUMENT_SCHEMA = (
    "RESULT struct<`RESULT.CODE`:string,`RESULT.MESSAGE`:string>, "
    "CITYDATA array<struct<_VALUE:string,AREA_CD:array<string>,AREA_NM:array<string>,"
    f"{_block('LIVE_PPLTN_STTS', POPULATION_FIELDS)},{_block('WEATHER_STTS', WEATHER_FIELDS)}>>, "
    "CODE string, MESSAGE string, _corrupt_record string"
)


# What :func:`read_documents` adds to each document.
PARTS = (
    "has_payload", "well_formed", "is_envelope", "outcome", "city", "population_state", "field_repeated",
    "weather_repeated", "population", "weather",
)

# What may stand before and after the root: white space, comments, instructions.  Each is taken as a
# whole and never given back, so ``--> garbage -->`` is no comment.
_COMMENT, _INSTRUCTION, _QUOTED = r"<!--(?>(?s:.*?)--)>", r"<\?(?>(?s:.*?)\?>)", r""""[^"]*+"|'[^']*+'"""
_BETWEEN = rf"(?:\s++|{_COMMENT}|{_INSTRUCTION})*+"
_SUBSET = rf"\[(?:{_COMMENT}|{_INSTRUCTION}|{_QUOTED}|[^\]\"'])*+\]\s*+"
_DOCTYPE = rf"(?:<!DOCTYPE(?:{_QUOTED}|[^>\[\"'])*+(?:{_SUBSET})?>)?+"
# What holds no tags, whatever it looks like.
_NO_TAGS = rf"{_COMMENT}|{_INSTRUCTION}|<!\[CDATA\[(?>(?s:.*?)\]\]>)"
_NAME = r"([A-Za-z_:][^\s/>]*+)"
ROOT_START = rf"\A\x{{FEFF}}?{_BETWEEN}{_DOCTYPE}{_BETWEEN}<{_NAME}"
ROOT_END = rf"</([^\s<>]++)\s*+>{_BETWEEN}\z"
PLAIN_NAME = r"\A[\w.:]+\z"
EMPTY_ROOT = rf"{ROOT_START}[^<>]*/>{_BETWEEN}\z"


def _only(items: Column) -> Column:
    """The element of a one-element array, otherwise NULL."""
    return F.when(F.size(items) == 1, F.get(items, F.lit(0)))


def _texts(record: Column, fields: tuple[str, ...]) -> Column:
    """The record's leaves in order, stripped; a repeated leaf has no text."""
    return F.transform(F.array(*[record[name] for name in fields]), lambda items: text.leaf(_only(items)))


def _any(texts: Column) -> Column:
    return F.exists(texts, lambda leaf: leaf.isNotNull())


def _by_name(texts: Column, fields: tuple[str, ...]) -> dict[str, Column]:
    return {name: F.get(texts, F.lit(place)) for place, name in enumerate(fields)}


def _repeated(record: Column, fields: tuple[str, ...]) -> Column:
    """Whether some leaf of the record is there more than once."""
    sizes = F.array(*[F.size(record[name]) for name in fields])
    return F.coalesce(record.isNotNull() & F.exists(sizes, lambda size: size > 1), F.lit(False))


def _closed(body: Column, root: Column) -> Column:
    """Whether the text ends with the end of the root it began with, and nothing but white space or comments.

    A second root of the same name ends the text as well, so where the name opens again its depth must
    not come back to zero before the end.
    """
    # A text that ends with the end tag itself has nothing behind it; the name must not end like a comment.
    at_once = root.rlike(PLAIN_NAME) & F.endswith(body, F.concat(F.lit("</"), root, F.lit(">")))
    ended = at_once | (F.regexp_extract(body, ROOT_END, 1) == root) | body.rlike(EMPTY_ROOT)
    opened = F.concat(F.lit("<"), root)
    several = F.call_function("substring_index", body, opened, F.lit(2)) != body
    tag = F.concat(F.lit(r"<(/?)\Q"), root, F.lit(r"\E(?=[\s>])(?![^<>]*+(?<=/)>)"))
    tags = F.regexp_extract_all(F.regexp_replace(body, _NO_TAGS, ""), tag, F.lit(1))
    depth = F.aggregate(
        tags, F.struct(F.lit(0).alias("now"), F.lit(0).alias("ends")),
        lambda state, tag: F.struct(
            (state["now"] + F.when(tag == "/", -1).otherwise(1)).alias("now"),
            (state["ends"] + F.when((tag == "/") & (state["now"] == 1), 1).otherwise(0)).alias("ends")))
    return ended & F.when(several, depth["ends"] == 1).otherwise(True)


def _population_state(block: Column) -> Column:
    """``missing``, ``not_object``, ``no_record`` or ``ok`` for the population block."""
    first = F.get(block, F.lit(0))
    has_text = F.coalesce(text.leaf(first["_VALUE"]).isNotNull(), F.lit(False))
    has_records = F.coalesce(first["LIVE_PPLTN_STTS"].isNotNull(), F.lit(False))
    return (
        F.when(F.coalesce(F.size(block), F.lit(0)) > 1, "not_object")
        .when(has_records, "ok")
        .when(has_text, "not_object")
        .otherwise("missing")
    )


def _typed_population(part: dict[str, Column]) -> Column:
    """Cleaned texts next to their parsed values, so that gates and loads share them."""
    rates = {
        "male_ratio": part["MALE_PPLTN_RATE"],
        "female_ratio": part["FEMALE_PPLTN_RATE"],
        "resident_ratio": part["RESNT_PPLTN_RATE"],
        "non_resident_ratio": part["NON_RESNT_PPLTN_RATE"],
    }
    junk = F.exists(F.array(*rates.values()), lambda value: numbers.ratio_is_junk(value, clean=True))
    return F.struct(
        part["PPLTN_TIME"].alias("time_text"),
        clock.parse_minute(part["PPLTN_TIME"], clean=True).alias("observed_at"),
        part["AREA_CONGEST_LVL"].alias("congestion_level"),
        part["AREA_CONGEST_MSG"].alias("congestion_message"),
        part["AREA_PPLTN_MIN"].alias("min_text"),
        part["AREA_PPLTN_MAX"].alias("max_text"),
        numbers.strict_int(part["AREA_PPLTN_MIN"], clean=True).alias("population_min"),
        numbers.strict_int(part["AREA_PPLTN_MAX"], clean=True).alias("population_max"),
        *[numbers.ratio(value, clean=True).alias(name) for name, value in rates.items()],
        junk.alias("ratio_is_junk"),
    )


def read_documents(df: DataFrame, xml: str = "payload_xml") -> DataFrame:
    """Parse XML documents and name their parts, see :data:`PARTS`.

    The reader ignores the root's name and anything after its end, so both are read
    off the text.  A part is NULL unless it is there exactly once and holds elements.
    """
    body = F.col(xml)
    root = F.nullif(F.regexp_extract(body, ROOT_START, 1), F.lit(""))
    parsed = apart(df, root=root, doc=F.from_xml(body, DOCUMENT_SCHEMA, {"mode": "PERMISSIVE"}))

    well_formed = F.coalesce(F.col("doc._corrupt_record").isNull() & _closed(body, F.col("root")), F.lit(False))
    closed = apart(parsed, has_payload=body.isNotNull(), well_formed=well_formed)
    envelope = F.col("well_formed") & F.col("root").eqNullSafe(SUCCESS_ROOT)
    opened = once(closed, is_envelope=envelope, _city=F.when(envelope, _only(F.col("doc.CITYDATA"))))
    opened = once(
        opened,
        population=_only(_only(F.col("_city.LIVE_PPLTN_STTS"))["LIVE_PPLTN_STTS"]),
        weather=_only(_only(F.col("_city.WEATHER_STTS"))["WEATHER_STTS"]),
    )

    result = F.col("doc.RESULT")
    code = F.when(F.col("is_envelope"), result["RESULT.CODE"]).otherwise(F.col("doc.CODE"))
    message = F.when(F.col("is_envelope"), result["RESULT.MESSAGE"]).otherwise(F.col("doc.MESSAGE"))
    raw_city = F.col("_city")
    area_code, area_name = text.leaf(_only(raw_city["AREA_CD"])), text.leaf(_only(raw_city["AREA_NM"]))
    # An empty element is no object: something has to be in it.
    filled = (
        F.coalesce(area_code, area_name).isNotNull()
        | raw_city["LIVE_PPLTN_STTS"].isNotNull()
        | raw_city["WEATHER_STTS"].isNotNull()
    )
    block = raw_city["LIVE_PPLTN_STTS"]
    named = apart(
        opened,
        outcome=F.when(
            F.col("well_formed"),
            F.struct(text.leaf(code).alias("code"), text.leaf(message).alias("message")),
        ),
        city=F.when(F.coalesce(filled, F.lit(False)), F.struct(area_code.alias("area_code"), area_name.alias("area_name"))),
        population_state=_population_state(block),
        field_repeated=_repeated(raw_city, ("AREA_CD", "AREA_NM")) | _repeated(F.col("population"), POPULATION_FIELDS),
        weather_repeated=_repeated(F.col("weather"), WEATHER_FIELDS),
    ).drop("root", "doc", "_city")

    # Steps apart on purpose: a generated method past 8000 bytes is never compiled by the JVM.
    cleaned = apart(
        named, population=_texts(F.col("population"), POPULATION_FIELDS), weather=_texts(F.col("weather"), WEATHER_FIELDS))
    population, weather = F.col("population"), F.col("weather")
    sky = _by_name(weather, WEATHER_FIELDS)
    return apart(
        cleaned,
        population=F.when(_any(population), _typed_population(_by_name(population, POPULATION_FIELDS))),
        weather=F.when(_any(weather), F.struct(*[value.alias(name) for name, value in sky.items()])),
    )


def classify(landing: DataFrame, with_payload: bool = True, keep_parts: bool = False) -> DataFrame:
    """Landing rows to raw rows: every call is kept, with its outcome.

    ``with_payload`` also stores the canonical JSON form and its fingerprint;
    ``keep_parts`` keeps the parsed parts, for gates in the same pass.
    """
    code, city = F.col("outcome.code"), F.col("city")
    success = (
        F.col("is_envelope") & (F.col("http_status") == 200) & (code == SUCCESS_CODE) & city.isNotNull()
    )
    read = once(read_documents(landing), is_success=F.coalesce(success, F.lit(False)))
    payload = xml_to_json(F.col("payload_xml")) if with_payload else F.lit(None).cast("string")
    return read.withColumn("payload", payload).select(
        F.col("raw_id").cast("bigint").alias("raw_id"),
        "source_name",
        city["area_code"].alias("area_code"),
        F.coalesce(city["area_name"], F.col("request_area_name")).alias("area_name"),
        "requested_at",
        "received_at",
        F.col("http_status").cast("int").alias("http_status"),
        code.alias("result_code"),
        F.col("outcome.message").alias("result_message"),
        "payload_xml",
        "payload",
        text.fingerprint(F.col("payload")).alias("payload_hash"),
        "is_success",
        F.when(~F.col("well_formed"), F.lit("xml_parse_failed")).alias("error_message"),
        clock.local_time(F.col("requested_at"), "UTC").cast("date").alias("ingest_date"),
        *(PARTS if keep_parts else ()),
    )


def call_history(raw: DataFrame) -> DataFrame:
    """How the calls ended, per status."""
    return raw.groupBy("http_status", "result_code", "is_success", "error_message").agg(
        F.count(F.lit(1)).alias("calls")
    )


def headers(valid: DataFrame, stamp: Column) -> DataFrame:
    """One header per accepted document, timed by the population clock."""
    return valid.select(
        F.col("raw_id").alias("ingestion_id"),
        F.col("city.area_code").alias("area_code"),
        F.col("city.area_name").alias("area_name"),
        F.col("population.observed_at").alias("observed_at"),
        F.col("requested_at").alias("collected_at"),
        F.col("outcome.code").alias("result_code"),
        F.col("outcome.message").alias("result_message"),
        "is_success",
        stamp.alias("loaded_at"),
        "ingest_date",
    )


def _call_context() -> list[Column]:
    return [F.col("city.area_name").alias("area_name"), F.col("requested_at").alias("collected_at")]


def populations(valid: DataFrame, stamp: Column, with_call: bool = False) -> DataFrame:
    """One population snapshot per accepted document.

    ``with_call`` adds the area name and collection time, which the header would
    otherwise have to be joined for.

    The snapshot id is the first ingestion that brought the key; an ingestion brings
    at most one snapshot, so it is unique without a sequence.
    """
    part = F.col("population")
    same_name = (
        "congestion_level", "congestion_message", "population_min", "population_max",
        "male_ratio", "female_ratio", "resident_ratio", "non_resident_ratio",
    )
    return valid.select(
        F.col("raw_id").alias("population_snapshot_id"),
        F.col("raw_id").alias("ingestion_id"),
        F.col("city.area_code").alias("area_code"),
        part["observed_at"].alias("observed_at"),
        *[part[name].alias(name) for name in same_name],
        stamp.alias("loaded_at"),
        clock.date_key(clock.local_time(part["observed_at"])).alias("date_key"),
        *(_call_context() if with_call else []),
    )


WEATHER_NUMBERS = {
    "temperature_c": ("TEMP", "decimal(5,2)"),
    "humidity_pct": ("HUMIDITY", "decimal(5,2)"),
    "precipitation_mm": ("PRECIPITATION", "decimal(7,2)"),
    "wind_speed_mps": ("WIND_SPD", "decimal(6,2)"),
    "pm10": ("PM10", "decimal(8,2)"),
    "pm25": ("PM25", "decimal(8,2)"),
}


def weathers(valid: DataFrame, stamp: Column, with_call: bool = False) -> DataFrame:
    """One weather snapshot per accepted document that has one, on its own clock.

    The feed has no apparent temperature and no wind direction; both stay NULL.
    """
    part = F.col("weather")
    number = {
        name: numbers.weather_number(part[source], target, clean=True).alias(name)
        for name, (source, target) in WEATHER_NUMBERS.items()
    }
    return valid.where(part.isNotNull()).select(
        F.col("raw_id").alias("ingestion_id"),
        F.col("city.area_code").alias("area_code"),
        clock.parse_minute(part["WEATHER_TIME"], clean=True).alias("observed_at"),
        number["temperature_c"],
        F.lit(None).cast("decimal(5,2)").alias("feels_like_c"),
        number["humidity_pct"],
        part["PRECPT_TYPE"].alias("precipitation_type"),
        number["precipitation_mm"],
        number["wind_speed_mps"],
        F.lit(None).cast("decimal(6,2)").alias("wind_direction_deg"),
        number["pm10"],
        number["pm25"],
        part["AIR_IDX"].alias("air_quality_index"),
        text.join_lines(part["AIR_MSG"], part["PCP_MSG"], part["UV_MSG"]).alias("weather_description"),
        stamp.alias("loaded_at"),
        "ingest_date",
        *(_call_context() if with_call else []),
    )


# ---- the array-shaped JSON document -------------------------------------------------

JSON_SCHEMA = (
    "CITYDATA struct<AREA_NM:string,AREA_CD:string,"
    f"LIVE_PPLTN_STTS:array<{_record(POPULATION_FIELDS)}>>"
)


def read_json_documents(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Parse JSON documents whose population is a list; its first element counts."""
    body = F.col(payload)
    parsed = once(
        df, well_formed=F.try_parse_json(body).isNotNull(), doc=F.from_json(body, JSON_SCHEMA)
    )
    city = F.col("doc.CITYDATA")
    return once(parsed, city=city, population=F.get(city["LIVE_PPLTN_STTS"], F.lit(0)))


def json_populations(valid: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Snapshots of the JSON feed; the payload's area wins over the call's."""
    part = F.col("population")
    return valid.select(
        F.col("raw_id").alias("ingestion_id"),
        F.coalesce(F.col("city.AREA_CD"), F.col("area_code")).alias("area_code"),
        F.coalesce(F.col("city.AREA_NM"), F.col("area_name")).alias("area_name"),
        clock.parse_iso(part["PPLTN_TIME"]).alias("observed_at"),
        F.col("received_at").alias("collected_at"),
        part["AREA_CONGEST_LVL"].alias("congestion_level"),
        numbers.strict_int(part["AREA_PPLTN_MIN"]).alias("population_min"),
        numbers.strict_int(part["AREA_PPLTN_MAX"]).alias("population_max"),
        *[
            part[source].try_cast("decimal(5,2)").alias(name)
            for name, source in (
                ("male_ratio", "MALE_PPLTN_RATE"),
                ("female_ratio", "FEMALE_PPLTN_RATE"),
                ("resident_ratio", "RESNT_PPLTN_RATE"),
                ("non_resident_ratio", "NON_RESNT_PPLTN_RATE"),
            )
        ],
        *keep,
    )


def json_headers(valid: DataFrame, stamp: Column) -> DataFrame:
    """One header per accepted JSON document; this feed tells no result."""
    return json_populations(valid).select(
        "ingestion_id", "area_code", "area_name", "observed_at", "collected_at",
        F.lit(None).cast("string").alias("result_code"),
        F.lit(None).cast("string").alias("result_message"),
        F.lit(True).alias("is_success"),
        stamp.alias("loaded_at"),
        clock.local_time(F.col("collected_at"), "UTC").cast("date").alias("ingest_date"),
    )


def json_snapshots(valid: DataFrame, stamp: Column) -> DataFrame:
    """The population staging rows of accepted JSON documents."""
    local = clock.local_time(F.col("observed_at"))
    rows = json_populations(valid.withColumn("message", F.col("population")["AREA_CONGEST_MSG"]), keep=("message",))
    return rows.withColumnRenamed("message", "congestion_message").withColumns({
        "population_snapshot_id": F.col("ingestion_id"), "loaded_at": stamp, "date_key": clock.date_key(local),
    })
