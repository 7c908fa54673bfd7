"""What keeps the queries in step with their input: rows dealt out to many tasks, and each step done once."""

import pytest
from pyspark.sql import functions as F

from makers import call, document, landing
from snapfold.catalog import document_queries, feed, mart_queries, stream_queries, table_queries
from snapfold.functions import once
from snapfold.operators import documents
from snapfold.plans import load
from snapfold.schemas import HEADER
from snapfold.sources.tables import MedallionTables

EVENTS = 240


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Events of one file and two days, and the areas they name."""
    path = str(tmp_path_factory.mktemp("growth"))
    spark.range(EVENTS).coalesce(1).select(
        F.col("id").alias("event_id"),
        (F.timestamp_seconds(1_704_060_000 + F.col("id") * 600)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 90).cast("double").alias("value"), F.format_string('{"k": %d}', F.col("id") % 20).alias("props"),
    ).write.parquet(f"{path}/events.parquet")
    areas = spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"), F.concat(F.lit("N"), "id").alias("n_name"))
    areas.write.parquet(f"{path}/nation.parquet")
    return path


@pytest.fixture
def ticks(spark, monkeypatch):
    """Counts the rows that the feed's typed records are made for."""
    counted = spark.sparkContext.accumulator(0)

    def tick(value):
        counted.add(1)
        return value

    def counting(real):
        made = F.udf(tick, "double")
        return lambda events, *more, **named: real(events.withColumn("value", made("value")), *more, **named)

    for name in ("population_rows", "weather_rows"):
        monkeypatch.setattr(feed, name, counting(getattr(feed, name)))
    return counted


def test_documents_are_dealt_over_tasks_by_their_number(spark, folder, monkeypatch):
    monkeypatch.setattr(once, "ROWS_IN_A_TASK", 20)
    for rows in (feed.landing(spark, folder), document_queries.json_documents(spark, folder)):
        assert rows.rdd.getNumPartitions() == EVENTS // 20


def test_a_stream_deals_its_documents_out(spark, folder, monkeypatch):
    monkeypatch.setattr(once, "ROWS_IN_A_TASK", 20)
    found = stream_queries.stream_ingest(spark, folder)
    assert found.count() == EVENTS
    assert len(found.inputFiles()) >= EVENTS // 20


def test_a_root_that_ends_like_a_comment_is_not_taken_for_the_end(spark):
    texts = ["<a--><b></b><!-- </a-->", "<a></a>", "<a><b></b>", "<a/>", "<a></a><a></a>", "<a>x</a >", "<a.b></a.b>"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, body string")
    root = F.regexp_extract("body", documents.ROOT_START, 1)
    found = [r[0] for r in rows.select("i", "body", root.alias("root")).orderBy("i").select(
        documents._closed(F.col("body"), F.col("root"))).collect()]
    assert found == [False, True, False, True, False, True, True]


def test_a_rebuild_checks_its_rows_once(spark):
    calls = [call(i, document(area=f"POI00{i % 3}")) for i in range(6)]
    raw = documents.classify(landing(spark, calls), with_payload=False, keep_parts=True)
    built = load.rebuild(raw, F.lit("2024-02-02").cast("timestamp"))
    facts = built["fact_city_snapshot"]
    assert facts.count() == 3
    assert all("/city/" in path for path in facts.inputFiles())
    assert all("/populations/" in path for path in built["realtime_population_snapshot"].inputFiles())


def test_a_load_makes_its_rows_once(spark, tmp_path):
    counted = spark.sparkContext.accumulator(0)

    def tick(value):
        counted.add(1)
        return value

    tables = MedallionTables(spark, str(tmp_path))
    rows = spark.range(50).select(
        F.udf(tick, "long")("id").alias("ingestion_id"), F.lit("POI001").alias("area_code"), F.lit("Station").alias("area_name"),
        F.lit("2024-03-01").cast("timestamp").alias("observed_at"), F.lit("2024-03-01").cast("timestamp").alias("collected_at"),
        F.lit(True).alias("is_success"), F.lit("2024-03-01").cast("date").alias("ingest_date"))
    known = spark.range(40).select(F.col("id").alias("raw_id"))
    refused = load.load_rows(tables, HEADER.name, rows, 0, {"raw_api_response": known})
    assert refused.count() == 10 and tables.read(HEADER.name).count() == 40
    assert counted.value <= 100  # the rule check takes kept and broken rows apart, and no step after it makes them again
    assert not tables.exists(f"{tables.root}/_parsed/{HEADER.name}-0")


def test_staging_batches_make_their_rows_once(spark, folder, ticks):
    assert table_queries.weather_staging_merge(spark, folder).count() > 0
    assert ticks.value == EVENTS


def test_mart_batches_make_their_rows_once(spark, folder, ticks):
    assert mart_queries.mart_incremental_merged(spark, folder).count() > 0
    assert ticks.value == 2 * EVENTS
