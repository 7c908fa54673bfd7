from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from snapfold.functions import clock, numbers
from snapfold.operators import dimensions, ids


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_sentinels_differ_between_weather_and_ratios(spark):
    df = spark.createDataFrame([(t,) for t in ("-", "*", "\\N", "없음", "null", " 1.005 ", "x", None)], "t string")
    weather = [r[0] for r in df.select(numbers.weather_number(F.col("t"), "decimal(5,2)")).collect()]
    ratio = [r[0] for r in df.select(numbers.ratio(F.col("t"))).collect()]
    junk = [r[0] for r in df.select(numbers.ratio_is_junk(F.col("t"))).collect()]
    assert weather == [None, None, None, None, None, Decimal("1.01"), None, None]
    assert ratio == weather
    assert junk == [True, False, False, True, True, False, True, False]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=40))
def test_mean_rounds_half_away_from_zero(spark, cents):
    df = spark.createDataFrame([(Decimal(c) / 100,) for c in cents], "v decimal(9,2)")
    found = df.agg(numbers.mean_decimal(F.col("v")), numbers.mean_decimal(F.col("v"), digits=1)).first()
    total, count = sum(cents), len(cents)

    def half_up(unit):
        whole = (2 * abs(total) + count * unit) // (2 * count * unit)
        return (whole if total >= 0 else -whole)

    assert found[0] == Decimal(half_up(1)) / 100
    assert found[1] == Decimal(half_up(10)) / 10


def test_mean_ignores_nulls_and_may_be_null(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, None)], "a int, b int")
    row = df.agg(
        numbers.mean_int(F.col("a")), numbers.mean_int(F.col("b")), numbers.mean_midpoint(F.col("a"), F.col("a"), 1)
    ).first()
    assert row[0] == Decimal("1.50") and row[1] is None and row[2] == Decimal("1.5")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_clock_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = clock.parse_minute(F.lit("2024-03-01 00:30"))
        local = clock.local_time(at)
        assert one(spark, clock.utc_text(at), clock.date_key(local), clock.hour_key(local), F.unix_seconds(at)) == (
            "2024-02-29 15:30:00", 20240301, 0, 1709220600,
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar(spark):
    days = dimensions.dim_date_between(spark, "2024-02-28", "2024-03-03").orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20240228, 20240229, 20240301, 20240302, 20240303]
    assert [d.iso_day_of_week for d in days] == [3, 4, 5, 6, 7]
    assert [d.is_weekend for d in days] == [False, False, False, True, True]
    hours = dimensions.dim_hour(spark).orderBy("hour_key").collect()
    assert len(hours) == 24 and tuple(hours[7]) == (7, "07:00:00", "07:00")


def test_dense_ids_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("code"))
    first = {r.code: r.id for r in ids.dense_ids(df, "code", "id", 11).collect()}
    again = {r.code: r.id for r in ids.dense_ids(df.repartition(13), "code", "id", 11).collect()}
    assert sorted(first.values()) == list(range(11, 5011)) and first == again


def test_snapshot_id_of_a_time_off_the_minute_is_null(spark):
    at = F.lit("2024-01-01 00:01:00").cast("timestamp")
    assert one(spark, ids.snapshot_id(F.lit(3).cast("long"), at)) == (3 * 2**32 + 28401121,)
    assert one(spark, ids.snapshot_id(F.lit(3).cast("long"), at + F.expr("INTERVAL 1 SECOND"))) == (None,)


def test_rows_are_dealt_over_more_tasks_as_they_grow(spark, monkeypatch):
    from snapfold.functions import once as module

    monkeypatch.setattr(module, "ROWS_IN_A_TASK", 100)
    rows = spark.range(0, 5000, 1, 20).withColumn("a.b", F.lit(None).cast("string"))
    held = [sum(1 for _ in part) for part in module.spread(rows.union(rows)).rdd.glom().collect()]
    assert len(held) == 100 and sum(held) == 10_000 and max(held) < 300
    # a scan may have partitions enough, and all rows in one of them
    uneven = rows.coalesce(1).union(spark.range(0, 0, 1, 30).withColumn("a.b", F.lit("")))
    sizes = module.spread(uneven).rdd.map(lambda _: 1).glom().map(len).collect()
    assert len(sizes) == 50 and max(sizes) < 300


def test_columns_apart_are_computed_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def slow(value):
        calls.add(1)
        return value + 1

    from snapfold.functions.once import apart

    counted = F.udf(slow, "long")
    rows = apart(spark.range(10), n=counted("id")).where("n > 3 and n < 8 and n <> 5")
    assert sorted(r.n for r in rows.collect()) == [4, 6, 7]
    assert calls.value == 10
