"""The same loads driven by Structured Streaming, one query per checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import documents
from ..operators.upsert import latest
from ..plans import hour_states
from ..plans.load import run_batch
from ..sources.tables import MedallionTables


def _start(stream: DataFrame, checkpoint: str):
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)


def ingest_raw(calls: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Classify new calls and append them to a raw folder, each exactly once."""
    return (
        _start(documents.classify(calls), checkpoint)
        .format("parquet").outputMode("append").partitionBy("ingest_date").start(folder)
    )


def load_batches(
    calls: DataFrame, tables: MedallionTables, checkpoint: str, stamp: Callable[[int], Column]
) -> StreamingQuery:
    """Run the whole load per micro-batch; a replayed batch has the same number."""

    def load(batch: DataFrame, batch_id: int) -> None:
        run_batch(tables, batch, batch_id, stamp(batch_id))

    return _start(calls, checkpoint).foreachBatch(load).start()


def merge_arrivals(
    arrivals: DataFrame, tables: MedallionTables, name: str, checkpoint: str
) -> StreamingQuery:
    """Fold arrivals into one table per micro-batch; stale ones do not win."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        tables.merge(name, batch, batch_id)

    # timeouts wait for the next batch with rows: else a stream that has read all would run empty batches for ever
    spark, setting = tables.spark, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return _start(arrivals, checkpoint).outputMode("update").foreachBatch(merge).start()
    finally:
        spark.conf.set(setting, before)


def newer_only(arrivals: DataFrame, keys: list[str], order: list[str], forget_after_ms: int = 7 * 86_400_000) -> DataFrame:
    """The guarded fold as arbitrary state: of each key's arrivals those newer than all before, one per micro-batch.

    The state of a key is what it was last ordered by; ``order`` names times and whole numbers and leaves no ties
    between different arrivals.  A key that nothing arrives for is forgotten after a while: its newest row is in the
    table by then, whose merge is guarded as well.
    """
    def rank(row: pd.DataFrame) -> tuple[int, ...]:
        values = (row[c].iloc[0] for c in order)
        return tuple(int(v.value) if isinstance(v, pd.Timestamp) else int(v) for v in values)

    def guard(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held, best = (tuple(state.get) if state.exists else None), None
        for batch in batches:
            last = batch.sort_values(order).iloc[[-1]]
            if held is None or rank(last) > held:
                held, best = rank(last), last
        state.update(held)
        state.setTimeoutDuration(forget_after_ms)
        if best is not None:
            yield best

    state = T.StructType([T.StructField(c, T.LongType()) for c in order])
    return arrivals.groupBy(*keys).applyInPandasWithState(
        guard, arrivals.schema, state, "update", GroupStateTimeout.ProcessingTimeTimeout)


def merge_hours(arrivals: DataFrame, tables: MedallionTables, spec: hour_states.Spec, checkpoint: str) -> StreamingQuery:
    """Hourly groups that lose nothing: each micro-batch's states are added to the stored hours, however late its rows.

    The stream keeps no state of its own; a replayed micro-batch is known by its number and adds nothing twice.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        hour_states.add(tables, spec, batch, batch_id)

    return _start(arrivals, checkpoint).foreachBatch(add).start()


def newest_per_key(arrivals: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The guarded fold as streaming state: per key the last row in ``order``."""
    row = F.struct(*[F.col(c) for c in arrivals.columns if c not in keys])
    newest = F.max_by(row, F.struct(*[F.col(c) for c in order])).alias("row")
    return arrivals.groupBy(*keys).agg(newest).select(*keys, "row.*")


def event_time_hours(
    arrivals: DataFrame, measures: list[Column], by: list[str], lateness: str
) -> DataFrame:
    """Hourly groups on event time, with a watermark that bounds the state.

    Rows later than ``lateness`` are lost, so it must cover the oldest arrival that
    still counts; the state holds one row per area and hour of that span.
    Windows start on whole UTC hours, which are whole local hours in any zone whose
    offset is a whole number of hours.
    """
    hours = F.window("observed_at", "1 hour")
    grouped = arrivals.withWatermark("observed_at", lateness).groupBy(hours, *by).agg(*measures)
    return grouped.withColumn("hour_start_at", F.col("window.start")).drop("window")


def emit_updates(groups: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's changed groups to its own folder of an update log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return _start(groups, checkpoint).outputMode("update").foreachBatch(write).start()


def read_updates(groups: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """The newest state of every group in an update log."""
    schema = T.StructType([*groups.schema.fields, T.StructField("batch_id", T.LongType())])
    log = groups.sparkSession.read.schema(schema).parquet(folder)
    return latest(log, keys, ["batch_id"]).drop("batch_id")
