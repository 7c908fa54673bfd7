"""Whole loads: from raw documents to facts, at once or batch by batch."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import SOURCE_NAME
from ..operators import audit, dimensions, documents, facts, gates, integrity
from ..operators.upsert import RULES, fold, folded
from ..schemas import (
    DIM_DATE, DIM_HOUR, DIM_LOCATION, FACT_CITY, FACT_WEATHER, HEADER, POPULATION, RAW, TABLES, WEATHER, Table,
)
from ..session import saved, scratch_folder
from ..sources.landing import number_calls
from ..sources.tables import MedallionTables
from . import hour_states, marts


@dataclass
class Parsed:
    """A batch of raw rows, parsed, gated and split, one row per ingestion each."""

    gated: DataFrame
    weather_gated: DataFrame
    headers: DataFrame
    populations: DataFrame
    weathers: DataFrame
    broken_rows: DataFrame  # (ingestion_id, table_name, violations): accepted by the gates, refused by a table rule


def parse(
    raw: DataFrame, stamp: Column, source_name: str = SOURCE_NAME, folder: str | None = None, checked: str | None = None
) -> Parsed:
    """Parse and gate raw rows; rows that still carry their parts are not parsed again.

    With ``checked``, a folder, the rows of each table are checked once and written there.

    With a ``folder`` the parts are written there once, and everything after reads
    those columns instead of parsing the documents again.
    """
    if not set(documents.PARTS) <= set(raw.columns):
        raw = documents.read_documents(raw)
    parts = raw.drop("payload_xml", "payload")
    if folder:
        parts = saved(parts, folder)

    def at(name: str) -> str | None:
        return f"{checked}/{name}" if checked else None

    gated = gates.document_gate(parts, source_name)
    valid = gates.accepted(gated)
    weather_gated = gates.weather_gate(valid)
    headers, no_header = _kept(documents.headers(valid, stamp), HEADER, parents={RAW.name: parts.select("raw_id")}, folder=at("headers"))
    staged = {HEADER.name: headers.select("ingestion_id")}
    populations, no_population = _kept(documents.populations(valid, stamp, with_call=True), POPULATION, parents=staged, folder=at("populations"))
    weathers, no_weather = _kept(
        documents.weathers(gates.accepted(weather_gated), stamp, with_call=True), WEATHER, parents=staged, folder=at("weathers"))
    refused = no_header.unionByName(no_population).unionByName(no_weather)
    return Parsed(gated, weather_gated, headers, populations, weathers, refused)


def _kept(
    rows: DataFrame, table: Table, ingestion: str = "ingestion_id",
    parents: Mapping[str, DataFrame] | None = None, stored: DataFrame | None = None, folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep a table's rules, and what the others break; with a ``folder`` they are checked once."""
    found = integrity.checked(rows, table, parents, stored)
    if folder:
        found = saved(found, folder)
    kept, broken = found.where(F.size("violations") == 0).drop("violations"), found.where(F.size("violations") > 0)
    return kept, broken.select(F.col(ingestion).alias("ingestion_id"), F.lit(table.name).alias("table_name"), "violations")


def _empty(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], TABLES[name].schema)


def rebuild(
    raw: DataFrame, stamp: Column, source_name: str = SOURCE_NAME, cut: bool = True
) -> dict[str, DataFrame]:
    """Every table from all stored documents, without calling the source again.

    Facts come from the per-ingestion rows, never from deduplicated staging: staging
    keeps the last arrival, the facts the last collection.  ``cut`` writes the parsed
    rows and the dimension to the shared scratch folder, so each is computed once.
    """
    folder = scratch_folder(raw.sparkSession, "rebuild") if cut else None
    parsed = parse(raw, stamp, source_name, f"{folder}/parts" if cut else None)
    if cut:  # checked once: the areas, the staging and the facts all read it
        parsed.populations = saved(parsed.populations, f"{folder}/populations")
    arrivals = dimensions.location_arrivals(parsed.populations, stamp)
    if cut:
        arrivals = saved(arrivals, f"{folder}/areas")
    dim_location = dimensions.upsert_locations(_empty(raw, DIM_LOCATION.name), arrivals)
    if cut:
        dim_location = saved(dim_location, f"{folder}/dim_location")
    city, _ = _kept(
        facts.city_fact_rows(parsed.populations, dim_location, stamp), FACT_CITY, "source_ingestion_id",
        folder=f"{folder}/city" if cut else None)
    weather, _ = _kept(facts.weather_fact_rows(parsed.weathers, dim_location, stamp), FACT_WEATHER, "source_ingestion_id")
    return {
        HEADER.name: folded(parsed.headers, HEADER.name),
        POPULATION.name: folded(parsed.populations.select(*POPULATION.columns), POPULATION.name),
        WEATHER.name: folded(parsed.weathers.select(*WEATHER.columns), WEATHER.name),
        DIM_LOCATION.name: dim_location,
        FACT_CITY.name: folded(city, FACT_CITY.name),
        FACT_WEATHER.name: folded(weather, FACT_WEATHER.name),
    }


def run_batch(
    tables: MedallionTables,
    landing: DataFrame,
    batch_id: int,
    stamp: Column,
    source_name: str = SOURCE_NAME,
) -> dict[str, DataFrame]:
    """One collection run for all its areas: raw, staging, dimensions, facts, audits, marts.

    Safe to repeat with the same ``batch_id``.  Dimensions load before both facts.
    Writes and returns the quarantine, the refused rows and the two audits of this batch.
    A run is refused while another owner's holds the tables' lease.
    """
    with tables.lease():
        return _run_batch(tables, landing, batch_id, stamp, source_name)


def _run_batch(
    tables: MedallionTables, landing: DataFrame, batch_id: int, stamp: Column, source_name: str
) -> dict[str, DataFrame]:
    if "raw_id" not in landing.columns:
        landing = number_calls(landing, after=tables.highest(RAW.name, batch_id))
    calls = integrity.with_defaults(landing, RAW)
    parsed_folder = f"{tables.root}/_parsed/{batch_id}"
    classified = saved(documents.classify(calls, keep_parts=True), f"{parsed_folder}/calls")
    stored, broken_calls = _kept(classified, RAW, "raw_id")
    tables.append(RAW.name, stored.select(*RAW.columns), batch_id, mark="raw_id")

    parsed = parse(stored, stamp, source_name, checked=parsed_folder)
    tables.merge(HEADER.name, parsed.headers, batch_id)
    populations, twice = _kept(
        parsed.populations, POPULATION, stored=tables.read(POPULATION.name), folder=f"{parsed_folder}/new")
    tables.merge(POPULATION.name, populations, batch_id)
    weather_staged = tables.merge(WEATHER.name, parsed.weathers, batch_id)

    arrivals, broken_areas = integrity.split(
        saved(dimensions.location_arrivals(parsed.populations, stamp), f"{parsed_folder}/areas"), DIM_LOCATION)
    tables.replace_table(
        DIM_LOCATION.name, batch_id, lambda: dimensions.upsert_locations(tables.read(DIM_LOCATION.name), arrivals)
    )
    dims = dict(zip((DIM_LOCATION.name, DIM_DATE.name, DIM_HOUR.name), _dims(tables)))
    city, broken_city = _kept(
        facts.city_fact_rows(parsed.populations, dims[DIM_LOCATION.name], stamp), FACT_CITY, "source_ingestion_id", dims,
        folder=f"{parsed_folder}/city")
    weather, broken_weather = _kept(
        facts.weather_fact_rows(parsed.weathers, dims[DIM_LOCATION.name], stamp), FACT_WEATHER, "source_ingestion_id",
        dims, folder=f"{parsed_folder}/weather")
    city_days = tables.merge(FACT_CITY.name, city, batch_id)
    weather_days = tables.merge(FACT_WEATHER.name, weather, batch_id)
    hour_states.update(tables, hour_states.POPULATION, city, city_days, batch_id)
    hour_states.update(tables, hour_states.WEATHER, weather, weather_days, batch_id)
    broken_areas = broken_areas.select(
        F.lit(None).cast("bigint").alias("ingestion_id"), F.lit(DIM_LOCATION.name).alias("table_name"), "violations")
    refused = parsed.broken_rows
    for broken in (broken_calls, twice, broken_areas, broken_city, broken_weather):
        refused = refused.unionByName(broken)
    reports = {
        "quarantine": gates.rejected(parsed.gated).select("raw_id", "reason", "reasons"),
        "weather_quarantine": gates.rejected(parsed.weather_gated).select("raw_id", "reason", "reasons"),
        "broken_rows": refused,
        "audit_city": _audit(tables, FACT_CITY, POPULATION, city, city_days, city_days),
        "audit_weather": _audit(tables, FACT_WEATHER, WEATHER, weather, weather_days, weather_staged),
    }
    written = {name: tables.write_report(name, rows, batch_id) for name, rows in reports.items()}
    tables.delete(parsed_folder)
    return written


def load_rows(
    tables: MedallionTables, name: str, rows: DataFrame, batch_id: int, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Load arrivals of any table: defaults, all its rules, then its upsert.  Safe to repeat with the same ``batch_id``.

    Gives the refused rows' keys with the names of the rules they break, which are kept as a report.
    """
    table, rule = TABLES[name], RULES[name]
    rows = integrity.conform(integrity.with_defaults(rows, table), table)
    folder = f"{tables.root}/_parsed/{name}-{batch_id}"
    found = saved(integrity.checked(rows, table, parents, tables.read(name)), folder)
    kept, broken = found.where(F.size("violations") == 0).drop("violations"), found.where(F.size("violations") > 0)
    refused = tables.write_report(f"refused_{name}", broken.select(*table.key, "violations"), batch_id)
    if table.partition:
        tables.merge(name, kept, batch_id)
    else:
        tables.replace_table(name, batch_id, lambda: fold(
            tables.read(name), kept, rule["keys"], rule.get("order") or table.columns, rule.get("guard"),
            rule.get("keep", ()), rule.get("changed", ()), rule.get("arrival")))
    tables.delete(folder)
    return refused


def run_json_batch(tables: MedallionTables, raw: DataFrame, batch_id: int, stamp: Column) -> dict[str, DataFrame]:
    """Stage one run of the array-shaped JSON feed: headers first, then their population snapshots.

    ``raw`` holds raw_id, area_code, area_name, received_at, is_success and payload.  Safe to repeat
    with the same ``batch_id``.  Writes and returns the quarantine and the refused rows.
    A run is refused while another owner's holds the tables' lease.
    """
    with tables.lease():
        return _run_json_batch(tables, raw, batch_id, stamp)


def _run_json_batch(tables: MedallionTables, raw: DataFrame, batch_id: int, stamp: Column) -> dict[str, DataFrame]:
    folder = f"{tables.root}/_parsed/json-{batch_id}"
    gated = saved(gates.json_gate(documents.read_json_documents(raw)).drop("payload", "doc"), folder)
    valid = gates.accepted(gated)
    headers, no_header = _kept(documents.json_headers(valid, stamp), HEADER)
    snapshots, no_snapshot = _kept(integrity.conform(documents.json_snapshots(valid, stamp), POPULATION), POPULATION)
    tables.merge(HEADER.name, headers, batch_id)
    tables.merge(POPULATION.name, snapshots, batch_id)
    reports = {
        "json_quarantine": gates.rejected(gated).select("raw_id", "reason", "reasons"),
        "json_broken_rows": no_header.unionByName(no_snapshot),
    }
    written = {name: tables.write_report(name, rows, batch_id) for name, rows in reports.items()}
    tables.delete(folder)
    return written


def _dims(tables: MedallionTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        tables.read(DIM_LOCATION.name), tables.read(DIM_DATE.name), tables.read(DIM_HOUR.name),
    )


def _audit(
    tables: MedallionTables, fact: Table, staging: Table, offered: DataFrame, days: list, staged: list
) -> DataFrame:
    """Audit the ingestions of a batch, with the partitions it touched in the fact and in staging."""
    ids = offered.select(F.col("source_ingestion_id").alias("ingestion_id")).distinct()
    stored = tables.within(tables.read(fact.name), fact.partition, days)
    batch_facts = stored.join(ids, stored["source_ingestion_id"] == ids["ingestion_id"], "left_semi")
    beside = tables.within(tables.read(staging.name), staging.partition, staged).drop(staging.partition)
    check = audit.audit_city if fact is FACT_CITY else audit.audit_weather
    not_gated = audit.CITY_NOT_GATED if fact is FACT_CITY else ()
    measured = check(ids, batch_facts, beside, *_dims(tables))
    return audit.load_status(measured, offered, stored, not_gated)


def refresh_marts(tables: MedallionTables, days: list, batch_id: int) -> None:
    """Compute the states behind the marts again, for the given days only."""
    if days:
        for spec in (hour_states.POPULATION, hour_states.WEATHER):
            hour_states.rebuild(tables, spec, days, batch_id)


def read_mart(tables: MedallionTables, name: str) -> DataFrame:
    """A stored mart with today's labels: states are stored on keys, so a renamed area is renamed in all hours."""
    population = hour_states.population_measures(hour_states.stored_states(tables, hour_states.POPULATION))
    weather = hour_states.weather_measures(hour_states.stored_states(tables, hour_states.WEATHER))
    groups = dict(zip(marts.MARTS, (population, weather, marts.together(population, weather))))
    return marts.labelled(groups[name], _dims(tables))


def seed_calendar(tables: MedallionTables, first: str, last: str) -> None:
    """Write the two static dimensions, once, before the first batch."""
    spark = tables.spark
    tables.put_table(DIM_DATE.name, -1, dimensions.dim_date_between(spark, first, last))
    tables.put_table(DIM_HOUR.name, -1, dimensions.dim_hour(spark))
