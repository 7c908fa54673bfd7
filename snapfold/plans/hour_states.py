"""Hourly marts kept up to date by what each batch changed.

A state holds, for one location and hour, numbers that add up (counts and sums in units of the last decimal place),
histograms of labels, and extremes.  A changed fact adds its new row and takes its old one back; hours from which
anything was taken get their extremes again from the facts of just those hours.  Reading turns states into the
measures of :mod:`marts`, so that means are rounded once and modes come from exact counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import CONGESTION_COUNTS, NO_PRECIPITATION
from ..functions import numbers
from ..schemas import FACT_CITY, FACT_WEATHER, TABLES
from ..sources.tables import MedallionTables
from .marts import HOUR_KEYS


@dataclass(frozen=True)
class Spec:
    """What the states of one fact table hold: names with the SQL of their value in a row."""

    fact: str
    states: str
    sums: Mapping[str, str]
    labels: Sequence[str]
    extremes: Mapping[str, tuple[str, str]]  # name -> ("min" or "max", column)


_DECIMALS = ("temperature_c", "feels_like_c", "humidity_pct", "wind_speed_mps", "pm10", "pm25")

POPULATION = Spec(
    FACT_CITY.name, "city_population_states",
    {
        "snapshots": "1",
        "low_sum": "population_min", "low_count": "int(population_min is not null)",
        "high_sum": "population_max", "high_count": "int(population_max is not null)",
        "doubled_sum": "bigint(population_min) + population_max",
        "doubled_count": "int(population_min + population_max is not null)",
    },
    ("congestion_level",),
    {
        "min_population_min": ("min", "population_min"), "peak_population_max": ("max", "population_max"),
        "latest_fact_loaded_at": ("max", "dw_loaded_at"),
    },
)
WEATHER = Spec(
    FACT_WEATHER.name, "city_weather_states",
    {"snapshots": "1"}
    | {f"{c}_sum": f"bigint({c} * 100)" for c in _DECIMALS} | {f"{c}_count": f"int({c} is not null)" for c in _DECIMALS},
    ("precipitation_type", "air_quality_index"),
    {
        "max_wind_speed_mps": ("max", "wind_speed_mps"), "max_precipitation_mm": ("max", "precipitation_mm"),
        "latest_weather_fact_loaded_at": ("max", "dw_loaded_at"),
    },
)


def _histogram(entries: Column) -> Column:
    """One count per label from (label, count) entries in which labels repeat; without the zeros."""
    labels = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    summed = F.transform(labels, lambda label: F.struct(label.alias("key"), F.aggregate(
        F.filter(entries, lambda e: e["key"] == label), F.lit(0).cast("bigint"), lambda a, e: a + e["value"]).alias("value")))
    return F.map_from_entries(F.filter(summed, lambda e: e["value"] != 0))


def states_of(rows: DataFrame, spec: Spec, sign: str = "1") -> DataFrame:
    """States of facts; rows with a negative ``sign`` are taken back, and ``taken`` counts them."""
    # the labels' counts come with the first grouping, so that none is gathered row by row
    first = rows.groupBy(*HOUR_KEYS, *spec.labels).agg(
        *[F.sum(F.expr(f"bigint({value}) * ({sign})")).alias(f"_{n}") for n, value in spec.sums.items()],
        F.sum(F.expr(f"bigint(({sign}) < 0)")).alias("_taken"),
        *[getattr(F, kind)(F.expr(f"case when ({sign}) > 0 then {column} end")).alias(f"_{n}")
          for n, (kind, column) in spec.extremes.items()])
    entries = {c: F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("key"), F.col("_snapshots").alias("value"))))
               for c in spec.labels}
    return first.groupBy(*HOUR_KEYS).agg(
        *[F.sum(F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in (*spec.sums, "taken")],
        *[_histogram(found).alias(f"labels_{c}") for c, found in entries.items()],
        *[getattr(F, kind)(f"_{n}").alias(n) for n, (kind, _) in spec.extremes.items()],
    ).withColumnsRenamed({f"labels_{c}": c for c in spec.labels})


def merged(stored: DataFrame, delta: DataFrame, spec: Spec, facts: DataFrame) -> DataFrame:
    """Stored states after a batch; ``facts`` are the facts of the touched days as they are now."""
    keys = list(HOUR_KEYS)
    again = facts.join(delta.where("taken > 0").select(*keys), keys, "left_semi").groupBy(*keys).agg(
        *[getattr(F, kind)(column).alias(f"now_{n}") for n, (kind, column) in spec.extremes.items()])
    old, new = stored.alias("old"), delta.alias("new")
    both = old.join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "full_outer")
    empty = F.expr("cast(array() as array<struct<key:string,value:bigint>>)")

    def entries(side: str, label: str) -> Column:
        return F.coalesce(F.map_entries(F.col(f"{side}.{label}")), empty)

    found = both.select(
        *[F.coalesce(f"old.{k}", f"new.{k}").alias(k) for k in keys],
        *[(F.coalesce(f"old.{n}", F.lit(0)) + F.coalesce(f"new.{n}", F.lit(0))).alias(n) for n in spec.sums],
        *[_histogram(F.concat(entries("old", c), entries("new", c))).alias(c) for c in spec.labels],
        *[(F.least if kind == "min" else F.greatest)(f"old.{n}", f"new.{n}").alias(n) for n, (kind, _) in spec.extremes.items()],
        (F.coalesce("new.taken", F.lit(0)) > 0).alias("rebuilt"))
    found = found.where("snapshots > 0").join(again, keys, "left")
    return found.select(*keys, *spec.sums, *spec.labels, *[
        F.when(F.col("rebuilt"), F.col(f"now_{n}")).otherwise(F.col(n)).alias(n) for n in spec.extremes])


def stored_states(tables: MedallionTables, spec: Spec) -> DataFrame:
    """The states as they are; none yet, or none left, is an empty table."""
    found = tables.manifest(spec.states)
    if found is None or not found.parts:
        return states_of(tables.read(spec.fact).where("false"), spec).drop("taken")
    return tables.read_derived(spec.states)


def changes(tables: MedallionTables, fact: str, arrivals: DataFrame, days: list, batch_id: int) -> DataFrame | None:
    """Rows that this batch put into a fact, with sign 1, and those it put them in place of, with -1.

    None if the version before the batch is no longer kept.
    """
    table = TABLES[fact]
    history = tables.history(fact)
    if history.as_of(batch_id - 1) is None and min(history.versions()) > 1:
        return None
    keys = arrivals.select(*table.key).distinct()
    before, now = (
        tables.within(tables.read(fact, as_of=as_of), table.partition, days).join(keys, list(table.key), "left_semi").select(
            *table.key, F.struct(*table.columns).alias(side)) for as_of, side in ((batch_id - 1, "before"), (None, "now")))
    pairs = before.join(now, list(table.key), "full_outer").where(~F.col("before").eqNullSafe(F.col("now")))
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("now").alias("row")))
    return pairs.select(F.explode(both).alias("c")).where("c.row is not null").select("c.sign", "c.row.*")


def update(tables: MedallionTables, spec: Spec, arrivals: DataFrame, days: list, batch_id: int) -> None:
    """Bring the states of some days up to the fact that this batch was just merged into; a replay adds nothing twice."""
    newest = tables.history(spec.states).newest()
    if not days or (newest and newest.batch == batch_id):
        return
    facts = tables.within(tables.read(spec.fact), "date_key", days)
    changed = changes(tables, spec.fact, arrivals, days, batch_id) if newest else None
    if changed is None:
        rows = states_of(facts, spec).drop("taken")
    else:
        stored = tables.within(stored_states(tables, spec), "date_key", days)
        rows = merged(stored, states_of(changed, spec, "sign"), spec, facts)
    tables.replace_partitions(spec.states, batch_id, "date_key", days, rows)


def rebuild(tables: MedallionTables, spec: Spec, days: list, batch_id: int) -> None:
    """The states of some days from the facts."""
    facts = tables.within(tables.read(spec.fact), "date_key", days)
    tables.replace_partitions(spec.states, batch_id, "date_key", days, states_of(facts, spec).drop("taken"))


def add(tables: MedallionTables, spec: Spec, rows: DataFrame, batch_id: int) -> None:
    """Add rows that are never taken back, however late they come; a replay adds nothing twice."""
    newest = tables.history(spec.states).newest()
    if newest and newest.batch >= batch_id:
        return
    days = tables.touched(rows, "date_key")
    if days:
        stored = tables.within(stored_states(tables, spec), "date_key", days)
        found = merged(stored, states_of(rows, spec), spec, rows.where("false"))
        tables.replace_partitions(spec.states, batch_id, "date_key", days, found)


def mode(histogram: Column) -> Column:
    """The label with the highest count, the lowest of several."""
    ranked = F.transform(F.map_entries(histogram), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("label")))
    return F.array_min(ranked)["label"]


def population_measures(states: DataFrame) -> DataFrame:
    def mean(name: str, units: int) -> Column:
        total = F.col(f"{name}_sum") * (5 if units else 1)
        return numbers.mean_of_units(total, F.col(f"{name}_count"), units)

    return states.select(
        *HOUR_KEYS, F.col("snapshots").alias("snapshot_count"), mean("low", 0).alias("avg_population_min"),
        mean("high", 0).alias("avg_population_max"), mean("doubled", 1).alias("avg_estimated_population"),
        "min_population_min", "peak_population_max",
        *[F.coalesce(F.try_element_at("congestion_level", F.lit(label)), F.lit(0)).alias(name)
          for label, name in CONGESTION_COUNTS.items()],
        "latest_fact_loaded_at")


def weather_measures(states: DataFrame) -> DataFrame:
    def mean(name: str) -> Column:
        return numbers.mean_of_units(F.col(f"{name}_sum"), F.col(f"{name}_count"), 2).alias(f"avg_{name}")

    dry = F.coalesce(F.try_element_at("precipitation_type", F.lit(NO_PRECIPITATION)), F.lit(0))
    known = F.aggregate(F.map_values("precipitation_type"), F.lit(0).cast("bigint"), lambda a, n: a + n)
    return states.select(
        *HOUR_KEYS, F.col("snapshots").alias("weather_snapshot_count"), *[mean(c) for c in _DECIMALS[:4]],
        "max_wind_speed_mps", mean("pm10"), mean("pm25"), "max_precipitation_mm",
        dry.alias("no_precipitation_count"), (known - dry).alias("precipitation_observed_count"),
        mode(F.col("precipitation_type")).alias("dominant_precipitation_type"),
        mode(F.col("air_quality_index")).alias("dominant_air_quality_index"), "latest_weather_fact_loaded_at")
