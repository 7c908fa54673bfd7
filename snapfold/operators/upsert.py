"""Set-wise upserts: fold many arrivals into one row per business key.

A one-row upsert per arrival becomes two steps over whole batches:

1. ``latest`` reduces the batch to one row per key.  Spark turns the
   ``row_number() = 1`` filter into a group limit that runs before the shuffle, so
   a key with a third of all arrivals leaves each map task as a single row.
2. ``upsert`` full-outer joins the reduced batch with the stored rows.  Both sides
   are unique on the key, so no key is hot in the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in ``order``; ``order`` must leave no ties."""
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    guard: str | None = None,
    keep: Sequence[str] = (),
    changed: Sequence[str] = (),
) -> DataFrame:
    """Merge ``incoming`` (one row per key, see :func:`latest`) into ``stored``.

    A key that is not stored yet is inserted.  A stored one is replaced, unless
    ``guard`` names a column in which the stored row is newer, or ``changed`` names
    columns and none of them differs.  Columns in ``keep`` stay as first inserted.
    """
    if stored.columns != incoming.columns:
        incoming = incoming.select(*stored.columns)
    old, new = stored.alias("old"), incoming.alias("new")
    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    is_stored = F.col(f"old.{keys[0]}").isNotNull()
    is_incoming = F.col(f"new.{keys[0]}").isNotNull()
    allowed = F.lit(True)
    if guard:
        allowed = allowed & (F.col(f"new.{guard}") >= F.col(f"old.{guard}"))
    if changed:
        differs = F.lit(False)
        for name in changed:
            differs = differs | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
        allowed = allowed & differs
    take_new = is_incoming & (~is_stored | F.coalesce(allowed, F.lit(False)))

    def resolved(name: str) -> Column:
        chosen = take_new & ~is_stored if name in keep else take_new
        return F.when(chosen, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return old.join(new, same_key, "full_outer").select(*[resolved(c) for c in stored.columns])


def latest_keeping(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], arrival: str
) -> DataFrame:
    """:func:`latest`, with the ``keep`` columns of each key's first arrival.

    So what a key was first inserted with does not depend on how its arrivals fall into batches.
    The first arrivals are a partial aggregation, one row per key and task.
    """
    if not keep:
        return latest(df, keys, order)
    first = df.groupBy(*keys).agg(F.min(F.struct(arrival, *[F.col(c).alias(f"_first_{c}") for c in keep])).alias("_first"))
    newest = latest(df, keys, order)
    joined = newest.join(first, list(keys))
    return joined.select(*[F.col(f"_first._first_{c}").alias(c) if c in keep else F.col(c) for c in df.columns])


def fold(
    stored: DataFrame,
    arrivals: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    guard: str | None = None,
    keep: Sequence[str] = (),
    changed: Sequence[str] = (),
    arrival: str | None = None,
) -> DataFrame:
    """``latest`` and ``upsert`` in one go; ``order`` columns must be stored columns.

    ``arrival`` names the column that tells which arrival came first, for the ``keep`` columns.
    """
    newest = latest_keeping(arrivals, keys, order, keep if arrival else (), arrival or "")
    return upsert(stored, newest, keys, guard, keep, changed)


def folded(rows: DataFrame, name: str) -> DataFrame:
    """All arrivals of a table in one fold onto nothing."""
    rule = RULES[name]
    return latest_keeping(rows, rule["keys"], rule["order"], rule.get("keep", ()) if rule.get("arrival") else (), rule.get("arrival", ""))


# How each table takes its arrivals.  Unguarded tables keep the last arrival, the
# facts keep the last collected one and, between equals, the later arrival.
RULES: dict[str, dict] = {
    "realtime_city_header": {"keys": ("ingestion_id",), "order": ("collected_at", "area_code", "observed_at")},
    "realtime_population_snapshot": {
        "keys": ("area_code", "observed_at"),
        "order": ("ingestion_id",),
        "keep": ("population_snapshot_id",),
        "arrival": "ingestion_id",
    },
    "realtime_weather_snapshot": {"keys": ("ingestion_id",), "order": ("observed_at", "area_code")},
    "dim_location": {
        "keys": ("area_code",),
        "changed": ("area_name", "timezone_name", "is_active"),
        "keep": ("location_id", "area_category", "latitude", "longitude", "created_at"),
    },
    "fact_city_snapshot": {
        "keys": ("location_id", "observed_at"),
        "order": ("collected_at", "source_ingestion_id"),
        "guard": "collected_at",
        "keep": ("city_snapshot_id", "dw_loaded_at"),
        "arrival": "source_ingestion_id",
    },
    "fact_weather_snapshot": {
        "keys": ("location_id", "observed_at"),
        "order": ("collected_at", "source_ingestion_id"),
        "guard": "collected_at",
        "keep": ("weather_snapshot_id", "dw_loaded_at"),
        "arrival": "source_ingestion_id",
    },
    "subway_station_daily": {
        "keys": ("usage_date", "line_name", "station_id"),
        "order": ("raw_id",),
        "keep": ("subway_usage_id",),
        "arrival": "raw_id",
    },
    "realtime_event": {
        "keys": ("staging_id", "event_name", "event_start_at"),
        "order": ("loaded_at", "source_event_id", "event_end_at", "venue_name", "event_category", "event_url"),
    },
}
