"""Queries over the derived documents: classify, gate, extract, parse values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock, numbers, text
from ..operators import documents, gates
from ..plans import load
from ..session import scratch_folder
from ..sources.tables import MedallionTables
from . import feed
from .oracle import BASE, KST, REJECTED, ROWS, date_key, stamp, with_ctes
from .shape import plain


def _no_stamp():
    return F.lit(None).cast("timestamp")


def _raw(spark, sf_dir, with_payload=False):
    return documents.classify(feed.landing(spark, sf_dir), with_payload)


def _gated(spark, sf_dir):
    calls = feed.landing(spark, sf_dir)
    return gates.document_gate(documents.classify(calls, with_payload=False, keep_parts=True))


def raw_classify(spark, sf_dir):
    raw = _raw(spark, sf_dir, with_payload=True)
    return plain(raw.drop("payload_xml", "payload", "received_at"))


#: What is put around or into each document, by its number's last digit; and whether it is still one document.
EDGES = (
    ("as it is", True), ("long tail of white space", True), ("comment and instruction around", True),
    ("spaced end tag", True), ("second root", False), ("second root of the same name", False), ("text behind", False),
    ("text that ends like a comment", False), ("other root behind a comment", False), ("repeated field", True),
    ("comment that names the root", True), ("CDATA that names the root", True), ("quoted > in the DOCTYPE", True),
)
ACCEPTED_EDGES = (0, 1, 2, 3, 10, 11, 12)


def document_edges(spark, sf_dir):
    """Every document with something around its root, or with a field twice: is it one, and is it accepted."""
    xml = F.col("payload_xml")
    calls = feed.landing(spark, sf_dir).withColumn("edge", F.col("raw_id") % len(EDGES))
    end = F.lit("</SeoulRtd.citydata>")
    area = F.regexp_extract(xml, "<AREA_CD>[^<]*</AREA_CD>", 0)
    changed = (
        F.when(F.col("edge") == 1, F.concat(xml, F.lit("\n" * 600)))
        .when(F.col("edge") == 2, F.concat(
            F.regexp_replace(xml, r"\A(<\?xml[^>]*>\n)?", "$1<!-- <foo> -->\n<?style a='<b>'?>"), F.lit("<!-- end --><?x y?>\n")))
        .when(F.col("edge") == 3, F.replace(xml, end, F.lit("</SeoulRtd.citydata \n>")))
        .when(F.col("edge") == 4, F.concat(xml, F.lit("<x/>")))
        .when(F.col("edge") == 5, F.concat(xml, F.lit("<SeoulRtd.citydata></SeoulRtd.citydata>")))
        .when(F.col("edge") == 6, F.concat(xml, F.lit("garbage")))
        .when(F.col("edge") == 7, F.concat(xml, F.lit("<!-- a --> garbage -->")))
        .when(F.col("edge") == 8, F.concat(xml, F.lit("<!-- b --><y></y>")))
        .when((F.col("edge") == 9) & (area != ""), F.replace(xml, area, F.concat(area, area)))
        .when(F.col("edge") == 10, F.replace(xml, end, F.concat(F.lit("<!-- <SeoulRtd.citydata> -->"), end)))
        .when(F.col("edge") == 11, F.replace(xml, end, F.concat(F.lit("<X><![CDATA[</SeoulRtd.citydata>]]></X>"), end)))
        .when(F.col("edge") == 12, F.regexp_replace(
            xml, r"\A(<\?xml[^>]*>\n)?", "$1<!DOCTYPE SeoulRtd.citydata SYSTEM \"a>b\">\n"))
        .otherwise(xml)
    )
    gated = gates.document_gate(documents.classify(
        calls.withColumn("payload_xml", changed).drop("edge"), with_payload=False, keep_parts=True))
    return gated.select("raw_id", "well_formed", (F.size("reasons") == 0).alias("accepted"),
                        F.array_contains("reasons", "field_repeated").alias("field_repeated"))


def raw_history(spark, sf_dir):
    return documents.call_history(_raw(spark, sf_dir))


def gate_reasons(spark, sf_dir):
    gated = gates.rejected(_gated(spark, sf_dir))
    return gated.select("raw_id", "reason", F.explode("reasons").alias("violated"))


def gate_reason_counts(spark, sf_dir):
    return gates.reason_counts(_gated(spark, sf_dir))


def gate_valid(spark, sf_dir):
    valid = gates.accepted(_gated(spark, sf_dir))
    return plain(documents.headers(valid, _no_stamp()).drop("loaded_at", "ingest_date"))


def xml_extract_population(spark, sf_dir):
    rows = documents.populations(gates.accepted(_gated(spark, sf_dir)), _no_stamp())
    return plain(rows.drop("population_snapshot_id", "loaded_at"))


def xml_extract_weather(spark, sf_dir):
    valid = gates.accepted(gates.weather_gate(gates.accepted(_gated(spark, sf_dir))))
    return plain(documents.weathers(valid, _no_stamp()).drop("loaded_at", "ingest_date"))


def weather_gate(spark, sf_dir):
    gated = gates.weather_gate(gates.accepted(_gated(spark, sf_dir)))
    return gates.rejected(gated).select("raw_id", "reason")


def weather_skipped(spark, sf_dir):
    return gates.weather_skipped(gates.accepted(_gated(spark, sf_dir)))


def missing_raw(spark, sf_dir):
    """Ids asked for: the buyers' ids and all event ids; raw holds the events."""
    ids = feed.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("raw_id"))
    return gates.missing_raw(ids, _raw(spark, sf_dir))


def json_documents(spark, sf_dir):
    """The array-shaped JSON feed, with its own gate."""
    k = F.col("k")
    record = F.struct(
        F.when(k != 31, F.date_format(clock.local_time(F.col("requested_at")), "yyyy-MM-dd HH:mm:ss")).alias("PPLTN_TIME"),
        F.col("event_type").alias("AREA_CONGEST_LVL"),
        F.when(k == 37, "12.0").otherwise(F.col("cents").cast("string")).alias("AREA_PPLTN_MIN"),
        F.when(k == 41, "-1").otherwise((F.col("cents") + k).cast("string")).alias("AREA_PPLTN_MAX"),
        F.concat(k.cast("string"), F.lit(".25")).alias("MALE_PPLTN_RATE"),
    )
    people = F.when(k == 23, F.array().cast(f"array<{_kind(record, spark, sf_dir)}>")).otherwise(
        F.array(record, record)
    )
    city = F.struct(
        F.col("place").alias("AREA_NM"), F.when(k != 19, F.col("poi")).alias("AREA_CD"),
        F.when(k != 25, people).alias("LIVE_PPLTN_STTS"),
    )
    body = F.to_json(F.struct(F.when(k != 17, city).alias("CITYDATA")))
    return feed.base(feed.spread(feed.table(spark, sf_dir, "events"))).select(
        "raw_id",
        F.when(k == 3, "{broken").when(k != 51, body).alias("payload"),
        F.lit("FEED").alias("area_code"),
        F.lit("elsewhere").alias("area_name"),
        F.col("requested_at").alias("received_at"),
        (k != 11).alias("is_success"),
    )


def _kind(record, spark, sf_dir) -> str:
    rows = feed.base(feed.table(spark, sf_dir, "events"))
    return rows.select(record.alias("r")).schema["r"].dataType.simpleString()


def _json_gated(spark, sf_dir):
    return gates.json_gate(documents.read_json_documents(json_documents(spark, sf_dir)))


def json_extract(spark, sf_dir):
    return plain(documents.json_populations(gates.accepted(_json_gated(spark, sf_dir))))


def json_load(spark, sf_dir):
    """The JSON feed staged in two batches, the later half first: population rows beside their headers."""
    tables = MedallionTables(spark, scratch_folder(spark, "json"))
    raw = json_documents(spark, sf_dir).drop("area_code").withColumn("area_code", F.lit("FEED"))
    half = feed.table(spark, sf_dir, "events").count() // 2
    for batch, part in enumerate(("raw_id >= {}", "raw_id < {}")):
        load.run_json_batch(tables, raw.where(part.format(half)), batch, F.col("collected_at"))
    header = tables.read("realtime_city_header").select("ingestion_id", "area_name", "collected_at")
    rows = tables.read("realtime_population_snapshot").join(header, "ingestion_id")
    return plain(rows.select("ingestion_id", "area_code", "area_name", "observed_at", "collected_at", "congestion_level",
                             "population_min", "population_max", "male_ratio", "date_key"))


def json_reasons(spark, sf_dir):
    gated = gates.rejected(_json_gated(spark, sf_dir))
    return gated.select("raw_id", F.explode("reasons").alias("violated"))


def payload_hash(spark, sf_dir):
    canonical = text.canonical_json(F.col("props"))
    return feed.table(spark, sf_dir, "events").select(
        "event_id", canonical.alias("canonical"), text.fingerprint(canonical).alias("payload_hash")
    )


def _number_text(null_texts):
    """Number texts of lineitem, some of them sentinels or junk."""
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    quantity = F.col("l_quantity").cast("int")
    out = F.when(quantity == 50, "junk").when(quantity == 49, F.concat(F.lit("  "), price, F.lit("\t")))
    for place, null_text in enumerate(null_texts):
        out = out.when(quantity == place + 1, null_text)
    return out.when(quantity < 25, price).otherwise(
        F.concat(F.col("l_discount").cast("decimal(4,2)").cast("string"), F.lit("5"))
    )


def _line_key():
    return ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def decimal_parse(spark, sf_dir):
    value = _number_text(("", "-", "없음", "null", "None"))
    return plain(
        feed.table(spark, sf_dir, "lineitem").select(
            *_line_key(),
            numbers.weather_number(value, "decimal(8,2)").alias("parsed"),
            numbers.weather_number_is_junk(value, "decimal(8,2)").alias("is_junk"),
        )
    )


def float_parse(spark, sf_dir):
    value = _number_text(("", "*", "\\N", "-"))
    return plain(
        feed.table(spark, sf_dir, "lineitem").select(
            *_line_key(),
            numbers.ratio(value, "decimal(8,2)").alias("parsed"),
            numbers.ratio_is_junk(value, "decimal(8,2)").alias("is_junk"),
        )
    )


def int_parse(spark, sf_dir):
    quantity = F.col("l_quantity").cast("int")
    plain_text = quantity.cast("string")
    value = (
        F.when(quantity < 5, F.concat(plain_text, F.lit(".0")))
        .when(quantity < 10, F.concat(F.lit(" +"), plain_text, F.lit("\n")))
        .when(quantity < 15, F.concat(F.lit("x"), plain_text))
        .when(quantity < 20, F.concat(F.lit("9999999999"), plain_text))
        .otherwise(F.concat(F.lit("0"), plain_text))
    )
    return feed.table(spark, sf_dir, "lineitem").select(*_line_key(), numbers.strict_int(value).alias("parsed"))


def time_keys(spark, sf_dir):
    """Instant to local keys, and local text back to the instant."""
    at = clock.utc_instant(F.col("ts"))
    local = clock.local_time(at)
    minute = F.date_format(local, "yyyy-MM-dd HH:mm")
    return plain(
        feed.table(spark, sf_dir, "events").select(
            "event_id",
            clock.date_key(local).alias("date_key"),
            clock.hour_key(local).alias("hour_key"),
            clock.parse_minute(minute).alias("observed_at"),
            clock.parse_iso(F.date_format(local, "yyyy-MM-dd HH:mm:ss")).alias("iso_at"),
        )
    )


def desc_join(spark, sf_dir):
    lines = text.join_lines(
        F.col("p_name"), F.when(F.col("p_size") >= 10, F.col("p_brand")), F.col("p_type")
    )
    return feed.table(spark, sf_dir, "part").select("p_partkey", lines.alias("description"))


QUERIES = {
    f.__name__: f
    for f in (
        raw_classify, document_edges, raw_history, gate_reasons, gate_reason_counts, gate_valid, xml_extract_population,
        xml_extract_weather, weather_gate, weather_skipped, missing_raw, json_extract, json_load, json_reasons,
        payload_hash, decimal_parse, float_parse, int_parse, time_keys, desc_join,
    )
}

# ---- the same in SQL ------------------------------------------------------------------


def _fields(pairs) -> str:
    """JSON members in order; a NULL member is absent, an empty text is null."""
    items = ", ".join(
        f"""CASE WHEN ({v}) IS NULL THEN NULL WHEN ({v}) = '' THEN '"{n}":null' """
        f"""ELSE '"{n}":"' || replace({v}, '\\', '\\\\') || '"' END"""
        for n, v in pairs
    )
    return f"'{{' || concat_ws(',', {items}) || '}}'"


_KT = "CAST(k AS VARCHAR)"
_POPULATION_JSON = _fields([
    ("AREA_CONGEST_LVL", "CASE WHEN k = 31 THEN '' ELSE lvl END"),
    ("AREA_CONGEST_MSG", f"CASE WHEN k % 2 = 0 THEN 'level ' || {_KT} END"),
    ("AREA_PPLTN_MAX", "CAST(CASE WHEN k = 41 THEN cents + 99 ELSE cents + 100 + 10 * k END AS VARCHAR)"),
    ("AREA_PPLTN_MIN", "CASE WHEN k = 37 THEN '12.0' WHEN k = 57 THEN '' ELSE CAST(cents + 100 AS VARCHAR) END"),
    ("FEMALE_PPLTN_RATE", "CAST(99 - k AS VARCHAR) || '.75'"),
    ("MALE_PPLTN_RATE", f"CASE WHEN k IN (2, 4) THEN '*' WHEN k IN (6, 8) THEN '' WHEN k IN (10, 12) THEN '\\N' "
                        f"WHEN k IN (47, 57) THEN 'abc' ELSE {_KT} || '.25' END"),
    ("NON_RESNT_PPLTN_RATE", f"CASE WHEN k < 50 THEN {_KT} || '.5' END"),
    ("PPLTN_TIME", f"CASE WHEN k = 43 THEN 'yesterday' WHEN k = 45 THEN strftime(population_at {KST}, '%Y-%-m-%-d %-H:%-M') "
                   f"ELSE strftime(population_at {KST}, '%Y-%m-%d %H:%M') END"),
    ("RESNT_PPLTN_RATE", f"{_KT} || '.005'"),
])
_WEATHER_JSON = _fields([
    ("AIR_IDX", "air"),
    ("AIR_MSG", "'air ' || event_type"),
    ("HUMIDITY", f"CASE WHEN k = 79 THEN '101' ELSE {_KT} END"),
    ("PCP_MSG", "CASE WHEN k >= 60 THEN 'rain' END"),
    ("PM10", "CASE WHEN k = 93 THEN '-3' ELSE CAST(2 * k AS VARCHAR) END"),
    ("PM25", f"CASE WHEN k = 95 THEN '-0.5' ELSE {_KT} END"),
    ("PRECIPITATION", "CASE WHEN k = 89 THEN '-1' WHEN k < 60 THEN '-' ELSE CAST(CAST(cents / 100.0 AS DECIMAL(9,2)) AS VARCHAR) END"),
    ("PRECPT_TYPE", "coalesce(rain, '')"),
    ("TEMP", "CASE WHEN k = 73 THEN 'abc' WHEN k IN (14, 16) THEN '-' WHEN k IN (18, 20) THEN '없음' "
             "ELSE CAST(CAST((cents - 5000) / 100.0 AS DECIMAL(9,2)) AS VARCHAR) END"),
    ("UV_MSG", f"'uv ' || {_KT}"),
    ("WEATHER_TIME", f"CASE WHEN k = 77 THEN 'noon' WHEN k <> 71 THEN strftime(weather_at {KST}, '%Y-%m-%d %H:%M') END"),
    ("WIND_SPD", "CASE WHEN k = 91 THEN '-1.0' ELSE CAST(CAST(k / 10.0 AS DECIMAL(5,1)) AS VARCHAR) END"),
])

_RAW = f"""{BASE},
parts AS (SELECT *, {_POPULATION_JSON} AS pj, {_WEATHER_JSON} AS wj FROM d),
blocks AS (
  SELECT *, CASE WHEN k = 23 THEN '"LIVE_PPLTN_STTS":"closed"' WHEN k = 25 THEN NULL
      WHEN k = 27 THEN '"LIVE_PPLTN_STTS":[{{"LIVE_PPLTN_STTS":' || pj || '}},{{"LIVE_PPLTN_STTS":' || pj || '}}]'
      WHEN k = 29 THEN '"LIVE_PPLTN_STTS":{{"LIVE_PPLTN_STTS":[' || pj || ',' || pj || ']}}'
      WHEN k = 33 THEN '"LIVE_PPLTN_STTS":{{"LIVE_PPLTN_STTS":null}}'
      ELSE '"LIVE_PPLTN_STTS":{{"LIVE_PPLTN_STTS":' || pj || '}}' END AS pb,
    CASE WHEN k = 59 THEN NULL WHEN k = 61 THEN '"WEATHER_STTS":{{"WEATHER_STTS":null}}'
      WHEN k = 67 THEN '"WEATHER_STTS":{{"WEATHER_STTS":[' || wj || ',' || wj || ']}}'
      ELSE '"WEATHER_STTS":{{"WEATHER_STTS":' || wj || '}}' END AS wb
  FROM parts),
docs AS (
  SELECT *, CASE WHEN k IN (3, 51, 55) THEN NULL
    WHEN k = 7 THEN '{{"RESULT":{{"CODE":"ERROR-500","MESSAGE":"no data"}}}}'
    ELSE '{{"SeoulRtd.citydata":{{"CITYDATA":' || CASE WHEN k = 17 THEN 'null' ELSE
        '{{' || concat_ws(',', CASE WHEN k <> 19 THEN '"AREA_CD":"' || poi || '"' END,
          CASE WHEN k = 21 THEN '"AREA_NM":null' ELSE '"AREA_NM":"' || place || '"' END, pb, wb) || '}}' END
      || ',"RESULT":{{"RESULT.CODE":"' || CASE WHEN k = 13 THEN 'INFO-200' ELSE 'INFO-000' END
      || '","RESULT.MESSAGE":"answered"}}}}}}' END AS canonical FROM blocks),
raw AS (
  SELECT raw_id, CASE WHEN k = 53 THEN 'other_source' ELSE 'seoul_realtime_city' END AS source_name,
    CASE WHEN k NOT IN (3, 7, 17, 19, 51, 55) THEN poi END AS area_code, place AS area_name,
    {stamp('requested_at')} AS requested_at, CASE WHEN k = 11 THEN 500 ELSE 200 END AS http_status,
    CASE WHEN k IN (3, 51, 55) THEN NULL WHEN k = 7 THEN 'ERROR-500' WHEN k = 13 THEN 'INFO-200' ELSE 'INFO-000' END AS result_code,
    CASE WHEN k IN (3, 51, 55) THEN NULL WHEN k = 7 THEN 'no data' ELSE 'answered' END AS result_message,
    sha256(canonical) AS payload_hash, k NOT IN (3, 7, 11, 13, 17, 51, 55) AS is_success,
    CASE WHEN k IN (3, 51, 55) THEN 'xml_parse_failed' END AS error_message,
    strftime(requested_at, '%Y-%m-%d') AS ingest_date
  FROM docs)"""

_REASONS = "reasons(k, reason, violated) AS (VALUES " + ", ".join(
    f"({k}, '{codes[0]}', '{code}')" for k, codes in feed.REASONS_BY_K.items() for code in codes
) + ")"
_WEATHER_REASONS = ", ".join(f"({k}, '{code}')" for k, code in feed.WEATHER_REASONS_BY_K.items())


def _parse_case(null_count: int, junk: str) -> str:
    price = "CAST(l_extendedprice AS DECIMAL(12,2))"
    return (
        f"CASE WHEN l_quantity = 50 OR {junk} THEN NULL WHEN l_quantity = 49 THEN CAST({price} AS DOUBLE) "
        f"WHEN l_quantity <= {null_count} THEN NULL WHEN l_quantity < 25 THEN CAST({price} AS DOUBLE) "
        "ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) + 1 AS DOUBLE) / 100 END"
    )


ORACLE = {
    "document_edges": with_ctes(BASE, f"""
SELECT raw_id, k NOT IN (3, 51, 55) AND raw_id % {len(EDGES)} NOT IN (4, 5, 6, 7, 8) AS well_formed,
       k NOT IN ({REJECTED}) AND raw_id % {len(EDGES)} IN {ACCEPTED_EDGES} AS accepted,
       k NOT IN (3, 7, 17, 19, 51, 55) AND raw_id % {len(EDGES)} = 9 AS field_repeated FROM d"""),
    "raw_classify": with_ctes(_RAW, "SELECT * FROM raw"),
    "raw_history": with_ctes(_RAW, """
SELECT http_status, result_code, is_success, error_message, count(*) AS calls FROM raw GROUP BY ALL"""),
    "gate_reasons": with_ctes(f"{BASE}, {_REASONS}", "SELECT raw_id, reason, violated FROM d JOIN reasons USING (k)"),
    "gate_reason_counts": with_ctes(f"{BASE}, {_REASONS}", """
SELECT violated AS reason, count(*) AS documents FROM d JOIN reasons USING (k) GROUP BY violated"""),
    "gate_valid": with_ctes(ROWS, f"""
SELECT ingestion_id, area_code, area_name, {stamp('observed_at')} AS observed_at,
       {stamp('collected_at')} AS collected_at, 'INFO-000' AS result_code, 'answered' AS result_message,
       true AS is_success FROM pop"""),
    "xml_extract_population": with_ctes(ROWS, f"""
SELECT ingestion_id, area_code, {stamp('observed_at')} AS observed_at, congestion_level, congestion_message,
       population_min, population_max, CAST(male_ratio AS DOUBLE) AS male_ratio, CAST(female_ratio AS DOUBLE) AS female_ratio,
       CAST(resident_ratio AS DOUBLE) AS resident_ratio, CAST(non_resident_ratio AS DOUBLE) AS non_resident_ratio,
       {date_key('observed_at ' + KST)} AS date_key FROM pop"""),
    "xml_extract_weather": with_ctes(ROWS, f"""
SELECT ingestion_id, area_code, {stamp('observed_at')} AS observed_at,
       temp_cents / 100.0::DOUBLE AS temperature_c, CAST(NULL AS DOUBLE) AS feels_like_c,
       CAST(humidity AS DOUBLE) AS humidity_pct, precipitation_type, rain_cents / 100.0::DOUBLE AS precipitation_mm,
       wind_tenths / 10.0::DOUBLE AS wind_speed_mps, CAST(NULL AS DOUBLE) AS wind_direction_deg,
       CAST(pm10 AS DOUBLE) AS pm10, pm25_cents / 100.0::DOUBLE AS pm25, air_quality_index, weather_description
FROM wea_all"""),
    "weather_gate": with_ctes(
        BASE, f"SELECT raw_id, reason FROM d JOIN (VALUES {_WEATHER_REASONS}) AS r(k, reason) USING (k)"
    ),
    "weather_skipped": with_ctes(ROWS, """
SELECT count(*) AS documents, count(*) FILTER (WHERE k IN (59, 61, 67)) AS weather_skipped FROM pop"""),
    "missing_raw": """
SELECT o_orderkey AS raw_id, 'raw_missing' AS reason FROM orders
WHERE o_orderkey NOT IN (SELECT event_id FROM events)""",
    "json_extract": with_ctes(BASE, f"""
SELECT raw_id AS ingestion_id, poi AS area_code, place AS area_name, {stamp("date_trunc('second', requested_at)")} AS observed_at,
       {stamp('requested_at')} AS collected_at, event_type AS congestion_level, cents AS population_min,
       cents + k AS population_max, k + 0.25::DOUBLE AS male_ratio, CAST(NULL AS DOUBLE) AS female_ratio,
       CAST(NULL AS DOUBLE) AS resident_ratio, CAST(NULL AS DOUBLE) AS non_resident_ratio
FROM d WHERE k NOT IN (3, 11, 17, 19, 23, 25, 31, 37, 41, 51)"""),
    "json_load": with_ctes(f"""{BASE},
ok AS (SELECT *, date_trunc('second', requested_at) AS observed_at, raw_id < (SELECT count(*) // 2 FROM events) AS second
       FROM d WHERE k NOT IN (3, 11, 17, 19, 23, 25, 31, 37, 41, 51))""", f"""
SELECT raw_id AS ingestion_id, poi AS area_code, place AS area_name, {stamp('observed_at')} AS observed_at,
       {stamp('requested_at')} AS collected_at, event_type AS congestion_level, cents AS population_min,
       cents + k AS population_max, k + 0.25::DOUBLE AS male_ratio, {date_key('observed_at ' + KST)} AS date_key
FROM ok QUALIFY row_number() OVER (PARTITION BY poi, observed_at ORDER BY second DESC, raw_id DESC) = 1"""),
    "json_reasons": with_ctes(BASE, """
SELECT raw_id, violated FROM d JOIN (VALUES (3, 'json_parse_failed'), (11, 'not_success'), (17, 'citydata_missing'),
  (19, 'citydata_key_missing'), (23, 'population_container'), (25, 'population_container'),
  (31, 'population_key_missing'), (37, 'population_not_int'), (41, 'population_range'),
  (51, 'payload_missing')) AS r(k, violated) USING (k)"""),
    "payload_hash": """
SELECT event_id, canonical, sha256(canonical) AS payload_hash
FROM (SELECT event_id, '{"k":' || regexp_extract(props, '[0-9]+') || '}' AS canonical FROM events)""",
    "decimal_parse": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_parse_case(5, 'false')} AS parsed,
       l_quantity = 50 AS is_junk FROM lineitem""",
    "float_parse": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_parse_case(3, 'l_quantity = 4')} AS parsed,
       l_quantity IN (4, 50) AS is_junk FROM lineitem""",
    "int_parse": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity BETWEEN 5 AND 9 OR l_quantity >= 20 THEN CAST(l_quantity AS INTEGER) END AS parsed
FROM lineitem""",
    "time_keys": f"""
SELECT event_id, {date_key('ts ' + KST)} AS date_key, CAST(hour(ts {KST}) AS INTEGER) AS hour_key,
       {stamp("date_trunc('minute', ts)")} AS observed_at, {stamp("date_trunc('second', ts)")} AS iso_at
FROM events""",
    "desc_join": """
SELECT p_partkey, concat_ws(chr(10), p_name, CASE WHEN p_size >= 10 THEN p_brand END, p_type) AS description
FROM part""",
}
