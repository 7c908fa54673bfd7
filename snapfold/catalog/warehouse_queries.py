"""Queries over configuration, dimensions, upserts, facts, integrity and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import BUSINESS_ZONE, EXPECTED_AREAS, SOURCE_NAME
from ..functions import clock
from ..operators import audit, dimensions, facts, integrity
from ..operators.documents import classify, headers
from ..operators.gates import accepted, area_count_gate as count_gate, document_gate
from ..operators.upsert import RULES, fold, folded, latest
from ..plans import load
from ..plans.load import rebuild
from ..plans.marts import with_labels
from ..schemas import DIM_LOCATION, EVENT, FACT_CITY, HEADER, SUBWAY, TABLES, Reference
from ..session import scratch_folder
from ..sources import config as areas
from ..sources.tables import MedallionTables
from . import feed
from .oracle import FACTS, KST, ROWS, date_key, stamp, winner, with_ctes
from .shape import plain

AS_OF = "1998-06-01"


def _table(spark, sf_dir, name):
    return feed.table(spark, sf_dir, name)


# ---- configuration --------------------------------------------------------------------


def _config(spark, sf_dir):
    """One configured area per customer who ordered, valid from a year after the first order."""
    orders = _table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    span = orders.groupBy("o_custkey").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    nation = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = _table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return customer.join(span, F.col("c_custkey") == F.col("o_custkey")).select(
        F.lit(SOURCE_NAME).alias("source_name"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("source_area_code"),
        F.col("c_name").alias("source_area_name"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("analysis_area_code"),
        F.col("n_name").alias("analysis_area_name"),
        F.col("c_mktsegment").alias("area_type"),
        F.col("r_name").alias("district_name"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.date_add("first_day", 365).alias("valid_from"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("last_day")).alias("valid_to"),
    )


def _requests(spark, sf_dir):
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", name.alias("request_area_name"), F.col("o_orderdate").cast("date").alias("day")
    )


def _active(spark, sf_dir):
    return areas.active_locations(_config(spark, sf_dir), F.lit(AS_OF).cast("date"))


def active_locations(spark, sf_dir):
    return _active(spark, sf_dir)


def area_count_gate(spark, sf_dir):
    return count_gate(_active(spark, sf_dir), EXPECTED_AREAS)


def active_requests(spark, sf_dir):
    return areas.requests_of(_requests(spark, sf_dir), _active(spark, sf_dir)).select("o_orderkey")


def feed_valid_at_request(spark, sf_dir):
    joined = areas.valid_at_request(_requests(spark, sf_dir), _config(spark, sf_dir), F.col("day"))
    return plain(joined.select("o_orderkey", "analysis_area_code", "area_type", "valid_from", "valid_to"))


# ---- dimensions -----------------------------------------------------------------------


def dim_date(spark, sf_dir):
    """The order calendar, with the orders of each day."""
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
    span = orders.agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))
    per_day = orders.groupBy("full_date").agg(F.count(F.lit(1)).alias("orders"))
    return plain(
        dimensions.dim_date(span).join(per_day, "full_date", "left").withColumn(
            "orders", F.coalesce(F.col("orders"), F.lit(0))
        )
    )


def dim_hour(spark, sf_dir):
    """The hours of the day, with the events of each local hour."""
    local = clock.local_time(clock.utc_instant(F.col("ts")))
    per_hour = _table(spark, sf_dir, "events").groupBy(clock.hour_key(local).alias("hour_key")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return plain(
        dimensions.dim_hour(spark).join(per_hour, "hour_key", "left").withColumn(
            "events", F.coalesce(F.col("events"), F.lit(0))
        )
    )


def dim_location_upsert(spark, sf_dir):
    """Customers as areas: three segments stored, buyers arrive, some renamed or reactivated."""
    first, second = (clock.utc_instant(F.lit(day)) for day in ("2024-01-01", "2024-02-02"))
    customer = _table(spark, sf_dir, "customer")
    code = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    old = customer.where(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE")).select(
        code.alias("area_code"), F.col("c_name").alias("area_name"),
        F.lit("segment").alias("area_category"), F.lit(BUSINESS_ZONE).alias("timezone_name"),
        (F.col("c_acctbal") > -500).alias("is_active"), first.alias("created_at"), first.alias("updated_at"),
    )
    stored = integrity.conform(
        dimensions.dense_ids(old, "area_code", "location_id"), DIM_LOCATION
    )
    renamed = F.when(F.col("c_acctbal") > 9000, F.concat(F.col("c_name"), F.lit(" new"))).otherwise(F.col("c_name"))
    view = _table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        code.alias("area_code"), renamed.alias("area_name"), F.col("o_orderkey").alias("ingestion_id")
    )
    return plain(dimensions.upsert_locations(stored, dimensions.location_arrivals(view, second)))


# ---- upserts --------------------------------------------------------------------------

LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_ORDER = (
    "collected_at", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
)


def _lines(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, F.col("l_shipdate").alias("collected_at"), *LINE_ORDER[1:],
        "l_linestatus", F.col("l_linestatus").alias("first_loaded"),
    )


def _stored_and_incoming(lines):
    stored = latest(lines.where("l_linestatus = 'F'"), LINE_KEYS, LINE_ORDER)
    return stored, lines.where("l_linestatus <> 'F'")


def upsert_unguarded(spark, sf_dir):
    stored, incoming = _stored_and_incoming(_lines(spark, sf_dir))
    return plain(fold(stored, incoming, LINE_KEYS, LINE_ORDER, keep=("first_loaded",)))


def upsert_guarded(spark, sf_dir):
    stored, incoming = _stored_and_incoming(_lines(spark, sf_dir))
    return plain(fold(stored, incoming, LINE_KEYS, LINE_ORDER, guard="collected_at", keep=("first_loaded",)))


def upsert_idempotent(spark, sf_dir):
    """The same batch twice: the second time must change nothing."""
    stored, incoming = _stored_and_incoming(_lines(spark, sf_dir))
    for _ in range(2):
        stored = fold(stored, incoming, LINE_KEYS, LINE_ORDER, guard="collected_at", keep=("first_loaded",))
    return plain(stored)


def _subway(spark, sf_dir):
    return integrity.conform(
        _table(spark, sf_dir, "lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("subway_usage_id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("raw_id"),
            F.col("l_shipdate").alias("usage_date"),
            F.when(F.col("l_tax") != 0.08, F.concat(F.lit("line "), F.col("l_returnflag"))).alias("line_name"),
            F.col("l_suppkey").cast("string").alias("station_id"),
            F.concat(F.lit("station "), F.col("l_suppkey").cast("string")).alias("station_name"),
            (F.col("l_quantity").cast("int") - 3).alias("boardings"),
            (F.col("l_partkey").cast("int") - 20).alias("alightings"),
        ),
        SUBWAY,
    )


def check_rules(spark, sf_dir):
    """Rows that break a NOT NULL or CHECK rule, one row per broken rule."""
    _, broken = integrity.split(_subway(spark, sf_dir), SUBWAY)
    return broken.select("raw_id", "boardings", "alightings", F.explode("violations").alias("violation"))


def subway_upsert(spark, sf_dir):
    kept, _ = integrity.split(_subway(spark, sf_dir), SUBWAY)
    keys = RULES[SUBWAY.name]["keys"]
    order = ("raw_id", "boardings", "alightings")
    stored = latest(kept.where("boardings < 20"), keys, order)
    merged = fold(stored, kept.where("boardings >= 20"), keys, order, keep=RULES[SUBWAY.name]["keep"])
    return plain(merged.drop("source_registered_at", "loaded_at"))


def event_upsert(spark, sf_dir):
    at = clock.utc_instant(F.col("ts"))
    rows = _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("staging_id"),
        F.concat(F.lit("area "), F.col("user_id").cast("string")).alias("area_code"),
        F.col("event_type").alias("event_name"),
        clock.utc_instant(F.date_trunc("day", F.col("ts").cast("timestamp_ntz"))).alias("event_start_at"),
        at.alias("event_end_at"),
        F.col("props").alias("venue_name"),
        F.col("event_id").cast("string").alias("source_event_id"),
        at.alias("loaded_at"),
    )
    rule = RULES[EVENT.name]
    merged = latest(integrity.conform(rows, EVENT), rule["keys"], rule["order"])
    return plain(merged.drop("event_category", "event_url"))


def dup_check(spark, sf_dir):
    return integrity.duplicates(_table(spark, sf_dir, "lineitem"), LINE_KEYS)


def orphan_check(spark, sf_dir):
    """Orders whose buyer is no longer a customer with a positive balance."""
    parent = _table(spark, sf_dir, "customer").where("c_acctbal > 0")
    reference = Reference(("o_custkey",), "customer", ("c_custkey",))
    return integrity.orphans(_table(spark, sf_dir, "orders"), reference, parent).select("o_orderkey", "o_custkey")


# ---- staging views and facts ----------------------------------------------------------


def _events(spark, sf_dir):
    return feed.spread(_table(spark, sf_dir, "events"))


def _city_arrivals(spark, sf_dir):
    rows = feed.population_rows(_events(spark, sf_dir))
    return facts.city_fact_rows(rows, feed.dim_location(spark, sf_dir), F.col("collected_at"))


def city_facts(spark, sf_dir):
    return folded(_city_arrivals(spark, sf_dir), FACT_CITY.name)


def _weather_arrivals(spark, sf_dir, broken=False):
    rows = feed.weather_rows(_events(spark, sf_dir), broken)
    return facts.weather_fact_rows(rows, feed.dim_location(spark, sf_dir), F.col("collected_at"))


def weather_facts(spark, sf_dir, broken=False):
    return folded(_weather_arrivals(spark, sf_dir, broken), "fact_weather_snapshot")


def _population_staging(spark, sf_dir):
    rows = feed.population_rows(_events(spark, sf_dir)).drop("area_name", "collected_at")
    rule = RULES["realtime_population_snapshot"]
    return latest(rows, rule["keys"], rule["order"])


def _batches(spark, sf_dir, rows, name):
    """Rows merged in three batches, by arrival, onto a stored table; some fall into no partition."""
    stored = MedallionTables(spark, scratch_folder(spark, "merge"))
    partition = TABLES[name].partition
    day = F.when(F.col("ingestion_id") % 7 != 0, F.col(partition)) if partition == "ingest_date" else F.col(partition)
    third = _table(spark, sf_dir, "events").count() // 3 + 1
    rows = rows.withColumn(partition, day)
    for batch in range(3):
        stored.merge(name, rows.where((F.col("ingestion_id") / third).cast("int") == batch), batch)
    return stored.read(name)


def population_merge(spark, sf_dir):
    """Population staging after three batches: the last arrival of each key under its first arrival's id."""
    rows = feed.population_rows(_events(spark, sf_dir))
    return plain(_batches(spark, sf_dir, rows, "realtime_population_snapshot"))


def header_merge(spark, sf_dir):
    """Headers after three batches; every seventh has no day, and lies in the NULL partition."""
    rows = feed.header_rows(_events(spark, sf_dir)).withColumn("ingest_date", F.col("collected_at").cast("date"))
    return plain(_batches(spark, sf_dir, integrity.conform(rows, HEADER), HEADER.name).drop("result_code", "result_message", "loaded_at"))


def mart_after_rename(spark, sf_dir):
    """A stored hourly mart read after all areas were renamed, with no fact of theirs touched."""
    stored = MedallionTables(spark, scratch_folder(spark, "rename"))
    stored.merge(FACT_CITY.name, _city_arrivals(spark, sf_dir), 0)
    days = [r[0] for r in stored.read(FACT_CITY.name).select("date_key").distinct().collect()]
    dims = feed.dims(spark, sf_dir)
    for name, rows in zip(("dim_date", "dim_hour"), dims[1:]):
        stored.put_table(name, -1, integrity.conform(rows, TABLES[name]))
    for batch, title in enumerate(("old ", "new ")):
        named = dims[0].withColumn("area_name", F.concat(F.lit(title), "area_name"))
        stored.replace_table(DIM_LOCATION.name, batch, lambda: integrity.conform(named, DIM_LOCATION))
        if batch == 0:
            load.refresh_marts(stored, days, 0)
    mart = load.read_mart(stored, "city_population_hourly")
    return plain(mart.select("location_id", "area_code", "area_name", "date_key", "hour_key", "snapshot_count", "peak_population_max"))


def staging_view(spark, sf_dir):
    view = facts.population_view(_population_staging(spark, sf_dir), feed.header_rows(_events(spark, sf_dir)))
    return plain(view)


def header_payload_scan(spark, sf_dir):
    """Successful headers with their stored documents, from the documents themselves."""
    raw = classify(feed.landing(spark, sf_dir), with_payload=False, keep_parts=True)
    header = headers(accepted(document_gate(raw)), F.col("requested_at"))
    view = facts.payload_view(header, feed.landing(spark, sf_dir))
    return plain(
        view.select(
            "ingestion_id", "area_code", "area_name", "header_observed_at",
            F.contains("payload_xml", F.lit("<WEATHER_TIME>")).alias("has_weather_time"),
        )
    )


def _known_areas(spark, sf_dir):
    return feed.dim_location(spark, sf_dir).where("location_id <= 20")


def surrogate_lookup(spark, sf_dir):
    rows = feed.population_rows(_events(spark, sf_dir))
    arrivals = facts.city_fact_rows(rows, _known_areas(spark, sf_dir), F.col("collected_at"))
    return plain(arrivals)


def lookup_misses(spark, sf_dir):
    rows = feed.population_rows(_events(spark, sf_dir))
    return facts.lookup_misses(rows, _known_areas(spark, sf_dir)).select("ingestion_id", "area_code")


def guarded_fact(spark, sf_dir):
    return plain(city_facts(spark, sf_dir))


def guarded_weather_fact(spark, sf_dir):
    return plain(weather_facts(spark, sf_dir))


def star_join(spark, sf_dir):
    joined = with_labels(city_facts(spark, sf_dir), *feed.dims(spark, sf_dir))
    return plain(
        joined.select(
            "city_snapshot_id", "area_code", "area_name", "full_date", "hour_label", "population_max"
        )
    )


def rebuild_fact(spark, sf_dir):
    """City facts from the raw documents alone."""
    stamped = clock.utc_instant(F.lit("2024-02-02"))
    raw = classify(feed.landing(spark, sf_dir), with_payload=False, keep_parts=True)
    built = rebuild(raw, stamped)
    named = built[FACT_CITY.name].join(
        built[DIM_LOCATION.name].select("location_id", "area_code", "area_name"), "location_id"
    )
    return plain(named.drop("dw_loaded_at", "dw_updated_at"))


# ---- audits ---------------------------------------------------------------------------


def _gappy_dims(spark, sf_dir):
    location, date, hour = feed.dims(spark, sf_dir)
    return (
        location.where("location_id <> 25"),
        date.where("day_of_month <> 15"),
        hour.where("hour_key <> 3"),
    )


def _faulty_city_facts(spark, sf_dir):
    """Facts with wrong hour keys and ranges, told by their population spread."""
    gap = F.col("population_max") - F.col("population_min")
    return city_facts(spark, sf_dir).select(
        *[c for c in FACT_CITY.columns if c not in ("hour_key", "population_min")],
        F.when(gap == 440, (F.col("hour_key") + 1) % 24).otherwise(F.col("hour_key")).cast("smallint").alias("hour_key"),
        F.when(gap == 460, F.col("population_max") + 1).otherwise(F.col("population_min")).alias("population_min"),
    )


def reference_audit(spark, sf_dir):
    return audit.reference_audit(city_facts(spark, sf_dir), *_gappy_dims(spark, sf_dir))


def _city_audit(spark, sf_dir):
    ids = feed.population_rows(_events(spark, sf_dir)).select("ingestion_id")
    staging = _population_staging(spark, sf_dir).drop("date_key")
    return audit.audit_city(ids, _faulty_city_facts(spark, sf_dir), staging, *_gappy_dims(spark, sf_dir))


def audit_city(spark, sf_dir):
    return _city_audit(spark, sf_dir)


def audit_weather(spark, sf_dir):
    staging = feed.weather_rows(_events(spark, sf_dir), broken=True)
    wrong = F.when(F.col("pm25") == 44, F.col("temperature_c") + 1).otherwise(F.col("temperature_c"))
    stored = weather_facts(spark, sf_dir, broken=True).withColumn("temperature_c", wrong.cast("decimal(5,2)"))
    ids = staging.select("ingestion_id")
    return audit.audit_weather(
        ids, stored, staging.select("ingestion_id", "area_code", "observed_at", "temperature_c",
        "humidity_pct", "precipitation_mm", "wind_speed_mps", "pm10", "pm25"), *_gappy_dims(spark, sf_dir),
    )


def audit_violations(spark, sf_dir):
    listed = audit.violations(_city_audit(spark, sf_dir), audit.CITY_NOT_GATED)
    return listed.select("ingestion_id", F.explode("violations").alias("metric", "found"))


def audit_status(spark, sf_dir):
    """What became of each ingestion: ok, violated, superseded or missing."""
    checked = audit.load_status(
        _city_audit(spark, sf_dir), _city_arrivals(spark, sf_dir), city_facts(spark, sf_dir), audit.CITY_NOT_GATED
    )
    return checked.select("ingestion_id", "status")


def reconcile(spark, sf_dir):
    found = audit.reconcile(
        _population_staging(spark, sf_dir).drop("date_key"), _faulty_city_facts(spark, sf_dir),
        feed.dim_location(spark, sf_dir), ["population_min", "population_max", "congestion_level"],
    )
    return plain(found)


QUERIES = {
    f.__name__: f
    for f in (
        active_locations, area_count_gate, active_requests, feed_valid_at_request, dim_date, dim_hour,
        dim_location_upsert, upsert_unguarded, upsert_guarded, upsert_idempotent, population_merge,
        header_merge, mart_after_rename, check_rules, subway_upsert,
        event_upsert, dup_check, orphan_check, staging_view, header_payload_scan, surrogate_lookup,
        lookup_misses, guarded_fact, guarded_weather_fact, star_join, rebuild_fact, reference_audit,
        audit_city, audit_weather, audit_violations, audit_status, reconcile,
    )
}

# ---- the same in SQL ------------------------------------------------------------------

_CONFIG = """
config AS (
  SELECT c_name AS source_area_name, 'N' || c_nationkey AS analysis_area_code, n_name AS analysis_area_name,
         c_mktsegment AS area_type, r_name AS district_name, c_acctbal >= 0 AS is_active,
         CAST(first_day + 365 AS DATE) AS valid_from,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE last_day END AS valid_to
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
        FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey)"""
_ACTIVE = f"""{_CONFIG},
active AS (SELECT source_area_name AS request_area_name, analysis_area_code, analysis_area_name, area_type, district_name
  FROM config WHERE is_active AND DATE '{AS_OF}' BETWEEN valid_from AND coalesce(valid_to, DATE '9999-12-31'))"""

_LINES = """
lines AS (SELECT l_orderkey, l_linenumber, l_shipdate AS collected_at, l_partkey, l_suppkey, l_quantity,
                 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem)"""
_LINE_DESC = ", ".join(f"{c} DESC" for c in LINE_ORDER)


def _line_upsert(take_new: str) -> str:
    old = winner("(SELECT * FROM lines WHERE l_linestatus = 'F')", "l_orderkey, l_linenumber", _LINE_DESC)
    new = winner("(SELECT * FROM lines WHERE l_linestatus <> 'F')", "l_orderkey, l_linenumber", _LINE_DESC)
    names = ("collected_at", *LINE_ORDER[1:], "l_linestatus")
    chosen = ", ".join(f"CASE WHEN t THEN n_{c} ELSE o_{c} END AS {c}" for c in names)
    chosen = chosen.replace(
        "CASE WHEN t THEN n_collected_at ELSE o_collected_at END AS collected_at",
        stamp("CASE WHEN t THEN n_collected_at ELSE o_collected_at END") + " AS collected_at",
    )
    columns = ", ".join(f"o.{c} AS o_{c}, n.{c} AS n_{c}" for c in names)
    return with_ctes(_LINES, f"""
SELECT l_orderkey, l_linenumber, {chosen}, coalesce(o_l_linestatus, n_l_linestatus) AS first_loaded
FROM (SELECT coalesce(o.l_orderkey, n.l_orderkey) AS l_orderkey, coalesce(o.l_linenumber, n.l_linenumber) AS l_linenumber,
             {columns}, n.l_orderkey IS NOT NULL AND ({take_new}) AS t
      FROM {old} o FULL JOIN {new} n ON o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber)""")


_GUARDED = "o.l_orderkey IS NULL OR n.collected_at >= o.collected_at"

_SUBWAY = """
subway AS (
  SELECT l_orderkey * 10 + l_linenumber AS raw_id, strftime(l_shipdate, '%Y-%m-%d') AS usage_date,
         CASE WHEN l_tax <> 0.08 THEN 'line ' || l_returnflag END AS line_name, CAST(l_suppkey AS VARCHAR) AS station_id,
         'station ' || l_suppkey AS station_name, CAST(l_quantity AS INTEGER) - 3 AS boardings,
         CAST(l_partkey AS INTEGER) - 20 AS alightings
  FROM lineitem),
kept AS (SELECT * FROM subway WHERE line_name IS NOT NULL AND boardings >= 0 AND alightings >= 0)"""
_SUBWAY_KEYS = "usage_date, line_name, station_id"
_SUBWAY_DESC = "raw_id DESC, boardings DESC, alightings DESC"


def _city_columns(alias: str, location: str = "location_id") -> str:
    a = alias
    return f"""{location} * 4294967296 + CAST(epoch({a}.observed_at) AS BIGINT) // 60 AS city_snapshot_id, {location} AS location_id,
       {a}.date_key, CAST({a}.hour_key AS INTEGER) AS hour_key, {stamp(a + '.observed_at')} AS observed_at,
       {stamp(a + '.collected_at')} AS collected_at, {a}.congestion_level, {a}.congestion_message,
       {a}.population_min, {a}.population_max, CAST({a}.male_ratio AS DOUBLE) AS male_ratio,
       CAST({a}.female_ratio AS DOUBLE) AS female_ratio, CAST({a}.resident_ratio AS DOUBLE) AS resident_ratio,
       CAST({a}.non_resident_ratio AS DOUBLE) AS non_resident_ratio, {a}.ingestion_id AS source_ingestion_id"""


_STAMPS = f", {stamp('c.collected_at')} AS dw_loaded_at, {stamp('c.collected_at')} AS dw_updated_at"
_KEPT_STAMPS = f", {stamp('c.first_collected')} AS dw_loaded_at, {stamp('c.collected_at')} AS dw_updated_at"

_FAULTY = """
faulty AS (SELECT * EXCLUDE (hour_key, population_min),
                  CASE WHEN population_max - population_min = 440 THEN (hour_key + 1) % 24 ELSE hour_key END AS hour_key,
                  CASE WHEN population_max - population_min = 460 THEN population_max + 1 ELSE population_min END AS population_min
           FROM city)"""


def _missing(column: str = "location_id") -> str:
    return f"""CAST({column} = 25 AS INTEGER) AS missing_location_count,
       CAST(date_key % 100 = 15 AS INTEGER) AS missing_date_count, CAST(f.hour_key = 3 AS INTEGER) AS missing_hour_count"""


def _time_checks() -> str:
    return f"""CAST(f.observed_at > f.collected_at AS INTEGER) AS future_observation_count,
       CAST(f.hour_key <> hour(f.observed_at {KST}) OR date_key <> {date_key('f.observed_at ' + KST)} AS INTEGER) AS time_key_mismatch_count"""


_CITY_METRICS = (
    "missing_location_count", "missing_date_count", "missing_hour_count", "invalid_population_range_count",
    "future_observation_count", "time_key_mismatch_count", "missing_staging_population_count",
    "staging_fact_population_mismatch_count",
)
# A fact without a known location cannot reach its staging row, which goes by area code.
_CITY_AUDIT = f"""{FACTS}, {_FAULTY.strip()},
found AS (SELECT f.ingestion_id, 1 AS fact_count, {_missing()},
       CAST(f.population_min > f.population_max AS INTEGER) AS invalid_population_range_count, {_time_checks()},
       CAST(s.ingestion_id IS NULL AS INTEGER) AS missing_staging_population_count,
       CAST(s.ingestion_id IS NOT NULL AND (f.population_min <> s.population_min OR f.population_max <> s.population_max) AS INTEGER)
         AS staging_fact_population_mismatch_count
  FROM faulty f LEFT JOIN stg s ON s.ingestion_id = f.ingestion_id AND f.location_id <> 25),
audited AS (SELECT p.ingestion_id, coalesce(fact_count, 0) AS fact_count,
       {", ".join(f"coalesce({m}, 0) AS {m}" for m in _CITY_METRICS)}
  FROM pop p LEFT JOIN found USING (ingestion_id))"""
_GATED = [m for m in _CITY_METRICS if m != "missing_staging_population_count"]

_WEATHER_METRICS = (
    "missing_location_count", "missing_date_count", "missing_hour_count", "invalid_humidity_count",
    "invalid_precipitation_count", "invalid_wind_speed_count", "invalid_pm10_count", "invalid_pm25_count",
    "future_observation_count", "time_key_mismatch_count", "missing_staging_weather_count",
    "staging_fact_weather_mismatch_count",
)
_WEATHER_AUDIT = f"""{FACTS},
last_all AS {winner('wea_all', 'area_code, observed_at', 'collected_at DESC, ingestion_id DESC')},
facts AS (SELECT l.location_id, {date_key('w.observed_at ' + KST)} AS date_key, hour(w.observed_at {KST}) AS hour_key, w.*
          FROM last_all w JOIN loc l ON l.area_code = w.area_code),
found AS (SELECT f.ingestion_id, 1 AS fact_count, {_missing()},
       CAST(humidity NOT BETWEEN 0 AND 100 AS INTEGER) AS invalid_humidity_count,
       CAST(coalesce(rain_cents < 0, false) AS INTEGER) AS invalid_precipitation_count,
       CAST(wind_tenths < 0 AS INTEGER) AS invalid_wind_speed_count, CAST(pm10 < 0 AS INTEGER) AS invalid_pm10_count,
       CAST(pm25_cents < 0 AS INTEGER) AS invalid_pm25_count, {_time_checks()},
       CAST(location_id = 25 AS INTEGER) AS missing_staging_weather_count,
       CAST(location_id <> 25 AND k = 44 AS INTEGER) AS staging_fact_weather_mismatch_count FROM facts f)"""

ORACLE = {
    "active_locations": with_ctes(_ACTIVE, "SELECT * FROM active"),
    "area_count_gate": with_ctes(_ACTIVE, """
SELECT count(*) AS active_areas, 8 AS expected_areas,
       CASE count(*) WHEN 0 THEN 'no_active_area' WHEN 8 THEN 'ok' ELSE 'area_count' END AS status FROM active"""),
    "active_requests": with_ctes(_ACTIVE, """
SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_name IN (SELECT request_area_name FROM active)"""),
    "feed_valid_at_request": with_ctes(_CONFIG, """
SELECT o_orderkey, analysis_area_code, area_type, strftime(valid_from, '%Y-%m-%d') AS valid_from,
       strftime(valid_to, '%Y-%m-%d') AS valid_to
FROM orders JOIN customer ON o_custkey = c_custkey JOIN config ON source_area_name = c_name
WHERE is_active AND CAST(o_orderdate AS DATE) >= valid_from AND (valid_to IS NULL OR CAST(o_orderdate AS DATE) <= valid_to)"""),
    "dim_date": """
WITH per_day AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1),
days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM per_day)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_day_of_week,
       isodow(d) IN (6, 7) AS is_weekend, coalesce(orders, 0) AS orders
FROM days LEFT JOIN per_day USING (d)""",
    "dim_hour": """
WITH per_hour AS (SELECT hour(ts + INTERVAL 9 HOUR) AS h, count(*) AS events FROM events GROUP BY 1)
SELECT CAST(r.h AS INTEGER) AS hour_key, printf('%02d:00:00', r.h) AS hour_start, printf('%02d:00', r.h) AS hour_label,
       coalesce(events, 0) AS events
FROM (SELECT unnest(range(24)) AS h) r LEFT JOIN per_hour p ON p.h = r.h""",
    "dim_location_upsert": f"""
WITH old AS (
  SELECT row_number() OVER (ORDER BY substr(md5('C' || c_custkey), 1, 3), 'C' || c_custkey) AS location_id,
         'C' || c_custkey AS area_code, c_name AS area_name, c_acctbal > -500 AS is_active
  FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')),
new AS (SELECT DISTINCT 'C' || c_custkey AS area_code, CASE WHEN c_acctbal > 9000 THEN c_name || ' new' ELSE c_name END AS area_name
        FROM orders JOIN customer ON o_custkey = c_custkey),
added AS (SELECT *, row_number() OVER (ORDER BY substr(md5(area_code), 1, 3), area_code) + (SELECT coalesce(max(location_id), 0) FROM old) AS location_id
          FROM new WHERE area_code NOT IN (SELECT area_code FROM old))
SELECT o.location_id, o.area_code, coalesce(n.area_name, o.area_name) AS area_name, 'segment' AS area_category,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, 'Asia/Seoul' AS timezone_name,
       n.area_code IS NOT NULL OR o.is_active AS is_active, '2024-01-01 00:00:00' AS created_at,
       CASE WHEN n.area_code IS NOT NULL AND (n.area_name <> o.area_name OR NOT o.is_active)
            THEN '2024-02-02 00:00:00' ELSE '2024-01-01 00:00:00' END AS updated_at
FROM old o LEFT JOIN new n ON n.area_code = o.area_code
UNION ALL
SELECT location_id, area_code, area_name, NULL, NULL, NULL, 'Asia/Seoul', true, '2024-02-02 00:00:00', '2024-02-02 00:00:00' FROM added""",
    "upsert_unguarded": _line_upsert("true"),
    "upsert_guarded": _line_upsert(_GUARDED),
    "upsert_idempotent": _line_upsert(_GUARDED),
    "population_merge": with_ctes(FACTS, f"""
SELECT min(ingestion_id) OVER (PARTITION BY area_code, observed_at) AS population_snapshot_id, ingestion_id, area_code,
       {stamp('observed_at')} AS observed_at, congestion_level, congestion_message, population_min, population_max,
       CAST(male_ratio AS DOUBLE) AS male_ratio, CAST(female_ratio AS DOUBLE) AS female_ratio,
       CAST(resident_ratio AS DOUBLE) AS resident_ratio, CAST(non_resident_ratio AS DOUBLE) AS non_resident_ratio,
       {stamp('collected_at')} AS loaded_at, {date_key('observed_at ' + KST)} AS date_key
FROM pop QUALIFY row_number() OVER (PARTITION BY area_code, observed_at ORDER BY ingestion_id DESC) = 1"""),
    "header_merge": with_ctes(ROWS, f"""
SELECT ingestion_id, area_code, area_name, {stamp('observed_at')} AS observed_at, {stamp('collected_at')} AS collected_at,
       true AS is_success, CASE WHEN ingestion_id % 7 <> 0 THEN strftime(collected_at, '%Y-%m-%d') END AS ingest_date FROM pop"""),
    "mart_after_rename": with_ctes(FACTS, """
SELECT c.location_id, c.area_code, 'new ' || l.area_name AS area_name, date_key, CAST(hour_key AS INTEGER) AS hour_key,
       count(*) AS snapshot_count, max(population_max) AS peak_population_max
FROM city c JOIN loc l ON l.location_id = c.location_id GROUP BY ALL"""),
    "check_rules": with_ctes(_SUBWAY, """
SELECT raw_id, boardings, alightings, 'line_name_required' AS violation FROM subway WHERE line_name IS NULL
UNION ALL SELECT raw_id, boardings, alightings, 'boardings_not_negative' FROM subway WHERE boardings < 0
UNION ALL SELECT raw_id, boardings, alightings, 'alightings_not_negative' FROM subway WHERE alightings < 0"""),
    "subway_upsert": with_ctes(_SUBWAY, f"""
SELECT coalesce(o.raw_id, n.raw_id) AS subway_usage_id, coalesce(n.raw_id, o.raw_id) AS raw_id,
       coalesce(n.usage_date, o.usage_date) AS usage_date, coalesce(n.line_name, o.line_name) AS line_name,
       coalesce(n.station_id, o.station_id) AS station_id, coalesce(n.station_name, o.station_name) AS station_name,
       coalesce(n.boardings, o.boardings) AS boardings, coalesce(n.alightings, o.alightings) AS alightings
FROM {winner('(SELECT * FROM kept WHERE boardings < 20)', _SUBWAY_KEYS, _SUBWAY_DESC)} o
FULL JOIN {winner('(SELECT * FROM kept WHERE boardings >= 20)', _SUBWAY_KEYS, _SUBWAY_DESC)} n
  ON o.usage_date = n.usage_date AND o.line_name = n.line_name AND o.station_id = n.station_id"""),
    "event_upsert": f"""
SELECT user_id AS staging_id, 'area ' || user_id AS area_code, event_type AS event_name,
       {stamp("date_trunc('day', ts)")} AS event_start_at, {stamp('ts')} AS event_end_at, props AS venue_name,
       CAST(event_id AS VARCHAR) AS source_event_id, {stamp('ts')} AS loaded_at
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('day', ts)
                                       ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""",
    "dup_check": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "orphan_check": """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "staging_view": with_ctes(FACTS, f"""
SELECT ingestion_id AS population_snapshot_id, ingestion_id, area_code, area_name, {stamp('observed_at')} AS observed_at,
       {stamp('collected_at')} AS collected_at, congestion_level, congestion_message, population_min, population_max,
       CAST(male_ratio AS DOUBLE) AS male_ratio, CAST(female_ratio AS DOUBLE) AS female_ratio,
       CAST(resident_ratio AS DOUBLE) AS resident_ratio, CAST(non_resident_ratio AS DOUBLE) AS non_resident_ratio,
       {stamp('collected_at')} AS staging_loaded_at FROM stg"""),
    "header_payload_scan": with_ctes(ROWS, f"""
SELECT ingestion_id, area_code, area_name, {stamp('observed_at')} AS header_observed_at,
       k NOT IN (59, 61, 71) AS has_weather_time FROM pop"""),
    "surrogate_lookup": with_ctes(f"""{FACTS},
c AS (SELECT l.location_id, {date_key('p.observed_at ' + KST)} AS date_key, hour(p.observed_at {KST}) AS hour_key, p.*
      FROM pop p JOIN loc l ON l.area_code = p.area_code AND l.location_id <= 20)""",
        f"SELECT {_city_columns('c')}{_STAMPS} FROM c"),
    "lookup_misses": with_ctes(FACTS, """
SELECT ingestion_id, p.area_code FROM pop p JOIN loc l ON l.area_code = p.area_code WHERE l.location_id > 20"""),
    "guarded_fact": with_ctes(FACTS, f"SELECT {_city_columns('c')}{_KEPT_STAMPS} FROM city c"),
    "guarded_weather_fact": with_ctes(FACTS, f"""
SELECT location_id * 4294967296 + CAST(epoch(c.observed_at) AS BIGINT) // 60 AS weather_snapshot_id, location_id, date_key,
       CAST(hour_key AS INTEGER) AS hour_key, {stamp('c.observed_at')} AS observed_at, {stamp('c.collected_at')} AS collected_at,
       temp_cents / 100.0::DOUBLE AS temperature_c, CAST(NULL AS DOUBLE) AS feels_like_c, CAST(humidity AS DOUBLE) AS humidity_pct,
       precipitation_type, rain_cents / 100.0::DOUBLE AS precipitation_mm, wind_tenths / 10.0::DOUBLE AS wind_speed_mps,
       CAST(NULL AS DOUBLE) AS wind_direction_deg, CAST(pm10 AS DOUBLE) AS pm10, pm25_cents / 100.0::DOUBLE AS pm25,
       air_quality_index, weather_description, ingestion_id AS source_ingestion_id{_KEPT_STAMPS} FROM weather c"""),
    "star_join": with_ctes(FACTS, f"""
SELECT location_id * 4294967296 + CAST(epoch(observed_at) AS BIGINT) // 60 AS city_snapshot_id, area_code, area_name,
       strftime(observed_at {KST}, '%Y-%m-%d') AS full_date, strftime(observed_at {KST}, '%H:00') AS hour_label, population_max
FROM city"""),
    "rebuild_fact": with_ctes(f"""{FACTS},
numbered AS (SELECT area_code, row_number() OVER (ORDER BY substr(md5(area_code), 1, 3), area_code) AS id
             FROM (SELECT DISTINCT area_code FROM pop))""", f"""
SELECT {_city_columns('c', 'n.id')}, c.area_code, c.area_name
FROM city c JOIN numbered n ON n.area_code = c.area_code"""),
    "reference_audit": with_ctes(FACTS, """
SELECT count(*) AS fact_count, count(*) FILTER (WHERE location_id = 25) AS missing_location_count,
       count(*) FILTER (WHERE date_key % 100 = 15) AS missing_date_count,
       count(*) FILTER (WHERE hour_key = 3) AS missing_hour_count FROM city"""),
    "audit_city": with_ctes(_CITY_AUDIT, "SELECT * FROM audited"),
    "audit_weather": with_ctes(_WEATHER_AUDIT, f"""
SELECT w.ingestion_id, coalesce(fact_count, 0) AS fact_count,
       {", ".join(f"coalesce({m}, 0) AS {m}" for m in _WEATHER_METRICS)}
FROM wea_all w LEFT JOIN found USING (ingestion_id)"""),
    "audit_violations": with_ctes(_CITY_AUDIT, "\nUNION ALL\n".join(
        f"SELECT ingestion_id, '{m}' AS metric, {m} AS found FROM audited WHERE {m} <> 0" for m in _GATED
    )),
    "audit_status": with_ctes(_CITY_AUDIT, f"""
SELECT ingestion_id, CASE WHEN fact_count = 0 THEN 'superseded' WHEN {" + ".join(_GATED)} > 0 THEN 'violated' ELSE 'ok' END AS status
FROM audited"""),
    "reconcile": with_ctes(f"{FACTS}, {_FAULTY.strip()}", f"""
SELECT f.ingestion_id AS source_ingestion_id, f.area_code, {stamp('f.observed_at')} AS observed_at,
       f.population_min, s.population_min AS staging_population_min, f.population_max, s.population_max AS staging_population_max,
       f.congestion_level, s.congestion_level AS staging_congestion_level
FROM faulty f JOIN stg s ON s.ingestion_id = f.ingestion_id
WHERE f.population_min <> s.population_min OR f.population_max <> s.population_max OR f.congestion_level <> s.congestion_level"""),
}
