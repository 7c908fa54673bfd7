"""Surrogate ids without a sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def dense_ids(df: DataFrame, key: str, name: str, start: Column | int = 1) -> DataFrame:
    """Number rows ``start, start + 1, ...`` by a unique text key, with no global sort.

    Rows are numbered inside 4096 hash buckets and each bucket is shifted by the
    size of the buckets before it.  Only the 4096 bucket sizes meet in one task.
    The order is (first three hex digits of the key's md5, key), so it is the same
    on every run.
    """
    start = F.lit(start) if isinstance(start, int) else start
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(key).cast("binary")), 1, 3))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(key)
    return (
        bucketed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")  # at most 4096 rows
        .withColumn(name, (start + F.col("_offset") + F.col("_place") - 1).cast("bigint"))
        .drop("_bucket", "_place", "_offset")
    )


def snapshot_id(location_id: Column, observed_at: Column) -> Column:
    """An id made of its business key: location times 2**32 plus minutes since 1970.

    No two keys share an id.  An observation off the minute, or a location id past 2**31, has none: the
    NULL breaks the table's rules, so the row is refused and the others load.
    """
    seconds = F.unix_seconds(observed_at)
    packed = location_id * F.lit(4294967296) + F.call_function("div", seconds, F.lit(60))
    return F.when((seconds % 60 == 0) & (location_id < F.lit(1 << 31)), packed)
