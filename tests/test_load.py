import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from makers import call, document, landing, people, sky
from snapfold.operators import documents, facts, integrity
from snapfold.operators.lookup import lookup
from snapfold.operators.upsert import fold, latest, upsert
from snapfold.plans import load, marts
from snapfold.schemas import POPULATION, SUBWAY, TABLES
from snapfold.session import scratch_folder
from snapfold.sources import landing as source
from snapfold.sources.manifest import Conflict
from snapfold.sources.tables import MedallionTables
from snapfold.streaming import jobs

DAY = datetime(2024, 1, 1)


def at(text):
    return F.lit(text).cast("timestamp")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def warehouse(spark):
    tables = MedallionTables(spark, scratch_folder(spark, "tables"))
    load.seed_calendar(tables, "2024-02-01", "2024-04-30")
    return tables


def run(spark, tables, batch_id, calls, stamp="2024-03-01 00:00:00"):
    return load.run_batch(tables, landing(spark, calls), batch_id, at(stamp))


# ---- folds ----------------------------------------------------------------------------


def sequential(stored, arrivals, guarded):
    """One-row upserts in arrival order, the way a database would run them."""
    state = dict(stored)
    for arrival, key, collected, value in arrivals:
        old = state.get(key)
        if old is None:
            state[key] = (arrival, collected, value, arrival)
        elif not guarded or collected >= old[1]:
            state[key] = (arrival, collected, value, old[3])
    return state


def test_fold_equals_one_row_upserts(spark):
    rng = random.Random(7)
    for guarded in (True, False):
        def make(first, count):
            return [(first + i, rng.randrange(20), rng.randrange(6), rng.randrange(1000)) for i in range(count)]

        old, new = make(0, 60), make(100, 200)
        schema = "arrival long, key long, collected long, value long"

        def frame(items):
            return spark.createDataFrame(items, schema).withColumn("first", F.col("arrival"))

        order = ["collected", "arrival"] if guarded else ["arrival"]
        guard = "collected" if guarded else None
        empty = frame(old).where("false")
        stored = fold(empty, frame(old), ["key"], order, guard, keep=["first"], arrival="arrival")
        merged = fold(stored, frame(new), ["key"], order, guard, keep=["first"], arrival="arrival")
        expected = sequential(sequential({}, old, guarded), new, guarded)
        for row in merged.collect():
            assert (row.arrival, row.collected, row.value, row.first) == expected.pop(row.key)
        assert not expected


def test_fold_of_a_hot_key_leaves_each_map_task_as_one_row(spark):
    df = spark.range(1000, numPartitions=4).select((F.col("id") % 2).alias("key"), F.col("id").alias("arrival"))
    plan = latest(df, ["key"], ["arrival"])._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("Exchange"), plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2 and before < after


def test_change_only_upsert(spark):
    schema = "k string, name string, id long, updated string"
    stored = spark.createDataFrame([("a", "A", 1, "old"), ("b", "B", 2, "old"), ("c", None, 3, "old")], schema)
    incoming = spark.createDataFrame([("a", "A", None, "new"), ("b", "BB", None, "new"), ("c", None, None, "new"), ("d", "D", None, "new")], schema)
    merged = upsert(stored, incoming, ["k"], changed=["name"], keep=["id"])
    assert rows_of(merged, "k", "name", "id", "updated") == [
        ("a", "A", 1, "old"), ("b", "BB", 2, "new"), ("c", None, 3, "old"), ("d", "D", None, "new"),
    ]


def test_lookup_of_a_hot_key_is_split(spark):
    facts_ = spark.range(0, 400_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 400).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    dim = spark.range(300).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    plain = {how: lookup(facts_, dim, ["k"], how).count() for how in ("inner", "left", "left_semi", "left_anti")}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for how, count in plain.items():
            joined = lookup(facts_, dim, ["k"], how)
            assert joined.count() == count
        joined = lookup(facts_, dim, ["k"])
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def test_rules_split_rows(spark):
    good = (1, "2024-01-01", "2", "s1", "Station", 5, 6)
    bad = [(2, None, "2", "s1", "Station", 5, 6), (3, "2024-01-01", "2", "s1", "Station", -1, -2)]
    df = spark.createDataFrame([good, *bad], "raw_id long, usage_date string, line_name string, station_id string, station_name string, boardings int, alightings int")
    kept, broken = integrity.split(integrity.conform(df, SUBWAY), SUBWAY)
    assert [r.raw_id for r in kept.collect()] == [1]
    assert {r.raw_id: r.violations for r in broken.collect()} == {
        2: ["usage_date_required"], 3: ["boardings_not_negative", "alightings_not_negative"],
    }


def test_registry_is_sound(spark):
    for table in TABLES.values():
        names = set(table.columns)
        assert names >= {*table.key, *table.required, *table.defaults} and len(names) == len(table.columns)
        for reference in table.references:
            assert set(reference.parent_columns) <= set(TABLES[reference.parent].columns)


# ---- whole loads ----------------------------------------------------------------------


def test_batches_follow_the_arrival_rules(spark):
    tables = warehouse(spark)
    def doc(low, name="Station", **more):
        return document(name=name, inner=people(AREA_PPLTN_MIN=low), **more)

    first = run(spark, tables, 0, [
        call(1, doc("10"), at="2024-02-29 15:40:00"), call(2, doc("20"), at="2024-02-29 15:40:00"),
        call(3, document(area=None), at="2024-02-29 15:40:00"),
        call(4, document(area="POI002", name="Park", weather=sky(HUMIDITY="101")), at="2024-02-29 15:41:00"),
    ])
    # Equal collection times: the later arrival wins.
    city = tables.read("fact_city_snapshot").orderBy("location_id")
    found = {(r.source_ingestion_id, r.population_min, r.date_key, r.hour_key) for r in city.collect()}
    assert found == {(2, 20, 20240301, 0), (4, 100, 20240301, 0)}
    assert [r.reason for r in first["quarantine"].collect()] == ["citydata_key_missing"]
    assert [(r.ingestion_id, r.violations) for r in first["broken_rows"].collect()] == [(4, ["humidity_range"])]
    assert rows_of(first["audit_city"], "ingestion_id", "fact_count", "status") == [
        (1, 0, "superseded"), (2, 1, "ok"), (4, 1, "ok"),
    ]
    names = {r.area_code: r for r in tables.read("dim_location").collect()}
    assert {names["POI001"].location_id, names["POI002"].location_id} == {1, 2}

    # A stale arrival: staging keeps the last arrival, the fact the last collection.
    second = run(spark, tables, 1, [call(5, doc("30", name="New name"), at="2024-02-29 15:35:00")], "2024-03-02 00:00:00")
    staged = {r.area_code: r for r in tables.read("realtime_population_snapshot").collect()}
    assert (staged["POI001"].ingestion_id, staged["POI001"].population_min) == (5, 30)
    assert staged["POI001"].population_snapshot_id == 1  # its first ingestion's
    city = {r.location_id: r for r in tables.read("fact_city_snapshot").collect()}
    kept = city[names["POI001"].location_id]
    assert (kept.source_ingestion_id, kept.population_min) == (2, 20)
    assert rows_of(second["audit_city"], "ingestion_id", "fact_count", "status") == [(5, 0, "superseded")]
    renamed = {r.area_code: r for r in tables.read("dim_location").collect()}
    assert renamed["POI001"].area_name == "New name" and str(renamed["POI001"].updated_at) == "2024-03-02 00:00:00"
    assert str(renamed["POI001"].created_at) == "2024-03-01 00:00:00"
    assert str(renamed["POI002"].updated_at) == "2024-03-01 00:00:00"

    # An accepted update keeps the first load time and moves the other.
    run(spark, tables, 2, [call(6, doc("40"), at="2024-02-29 15:50:00")], "2024-03-03 00:00:00")
    kept = {r.location_id: r for r in tables.read("fact_city_snapshot").collect()}[kept.location_id]
    assert kept.population_min == 40
    assert str(kept.dw_loaded_at) == "2024-03-01 00:00:00" and str(kept.dw_updated_at) == "2024-03-03 00:00:00"

    # Marts follow.
    hourly = load.read_mart(tables, "city_population_hourly").orderBy("area_code").collect()
    assert [(r.area_code, r.snapshot_count, r.avg_population_min, r.normal_count) for r in hourly] == [
        ("POI001", 1, Decimal("40.00"), 1), ("POI002", 1, Decimal("100.00"), 1),
    ]
    merged = {r.area_code: r for r in load.read_mart(tables, "city_population_weather_hourly").collect()}
    assert merged["POI001"].weather_snapshot_count == 1 and merged["POI002"].weather_snapshot_count is None


def test_a_repeated_batch_changes_nothing(spark):
    tables = warehouse(spark)
    calls = [call(i, document(area=f"POI{i % 3:03d}"), at=f"2024-02-29 15:4{i}:00") for i in range(6)]
    run(spark, tables, 0, calls)
    names = ("raw_api_response", "realtime_city_header", "realtime_population_snapshot", "realtime_weather_snapshot", "dim_location", "fact_city_snapshot", "fact_weather_snapshot")
    before = {n: rows_of(tables.read(n), "*") for n in names}
    run(spark, tables, 0, calls)
    assert {n: rows_of(tables.read(n), "*") for n in names} == before
    assert len(before["fact_city_snapshot"]) == 3 and len(before["raw_api_response"]) == 6
    assert tables.read("fact_city_snapshot").groupBy("location_id", "observed_at").count().where("count > 1").count() == 0


def test_readers_see_a_commit_whole_or_not_at_all(spark, monkeypatch):
    """A reader between the write of the rows and the commit sees the old rows, and a job that dies there loses none."""
    tables = warehouse(spark)
    run(spark, tables, 0, [call(1, document())])
    name = "fact_city_snapshot"
    good, held = rows_of(tables.read(name), "*"), tables.read(name)
    change = tables.read(name).withColumn("population_min", F.lit(7))

    def dies(*args, **more):
        assert rows_of(tables.read(name), "*") == good
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", dies)
        with pytest.raises(OSError):
            tables.merge(name, change, 1)
    assert rows_of(tables.read(name), "*") == good
    tables.merge(name, change, 1)
    assert rows_of(tables.read(name), "population_min") == [(7,)]
    assert rows_of(held, "*") == good  # a reader that resolved the version before keeps its files
    assert rows_of(tables.read(name, as_of=0), "*") == good


def test_old_versions_are_dropped_with_their_files(spark):
    tables = MedallionTables(spark, scratch_folder(spark, "versions"), keep_versions=3)
    schema, name = TABLES["realtime_city_header"].schema, "realtime_city_header"
    for batch in range(6):
        row = (1, "POI001", str(batch), DAY, DAY, "INFO-000", "ok", True, DAY, DAY.date())
        tables.merge(name, spark.createDataFrame([row], schema), batch)
    history = tables.history(name)
    assert history.versions() == [4, 5, 6]
    left = {f"{c}/{p}" for c in tables.folders.names(f"{tables.path(name)}/data", True)
            for p in tables.folders.names(f"{tables.path(name)}/data/{c}", True)}
    assert left == {at for v in history.versions() for at in history.get(v).parts.values()}
    assert [rows_of(tables.read(name, as_of=b), "area_name") for b in (3, 4, 5)] == [[("3",)], [("4",)], [("5",)]]
    assert tables.manifest(name, as_of=1) is None


def test_a_key_that_arrives_for_another_partition_moves(spark):
    tables = MedallionTables(spark, scratch_folder(spark, "moves"))
    schema, name = TABLES["realtime_city_header"].schema, "realtime_city_header"
    days = [DAY.date() + timedelta(days=n) for n in range(3)]

    def arrive(batch, *rows):
        tables.merge(name, spark.createDataFrame(
            [(n, "POI001", f"b{batch}", DAY, DAY, "INFO-000", "ok", True, DAY, day) for n, day in rows], schema), batch)

    arrive(0, (1, days[0]), (2, days[0]), (3_000_000, days[1]))
    arrive(1, (1, days[1]), (2, None))
    arrive(2, (1, days[2]), (3_000_000, None), (4, days[0]))
    arrive(2, (1, days[2]), (3_000_000, None), (4, days[0]))
    assert rows_of(tables.read(name), "ingestion_id", "area_name", "ingest_date") == sorted([
        (1, "b2", days[2]), (2, "b1", None), (3_000_000, "b2", None), (4, "b2", days[0])], key=str)
    assert f"ingest_date={days[1]}" not in tables.manifest(name).parts  # its last row has gone


def test_two_writers_cannot_commit_one_version(spark):
    tables = MedallionTables(spark, scratch_folder(spark, "writers"))
    other = MedallionTables(spark, tables.root)
    tables.put_table("dim_hour", 0, tables.spark.range(0).selectExpr(
        "cast(id as smallint) hour_key", "'' hour_start", "'' hour_label"))
    taken = tables.history("dim_hour").newest()
    with pytest.raises(Conflict):
        other.history("dim_hour").commit(taken)


def test_runs_do_not_overlap(spark):
    tables = warehouse(spark)
    with tables.lease("another run"):
        with pytest.raises(Conflict):
            run(spark, tables, 0, [call(1, document())])
    run(spark, tables, 0, [call(1, document())])
    tables.lease("a run that died", seconds=-1).__enter__()
    run(spark, tables, 1, [call(2, document(area="POI002"))])  # its lease ran out
    assert tables.read("fact_city_snapshot").count() == 2
    with tables.lease("mine"), tables.lease("mine"):  # a replay takes its own lease again
        pass


def test_a_null_partition_is_merged_like_the_others(spark):
    """Headers without a day: stored ones stay, the first batch may have no other, a replay changes nothing."""
    tables = warehouse(spark)
    schema = TABLES["realtime_city_header"].schema

    def header(number, day):
        return (number, "POI001", "Station", DAY, DAY, "INFO-000", "ok", True, DAY, day)

    for _ in range(2):
        tables.merge("realtime_city_header", spark.createDataFrame([header(1, None)], schema), 0)
        tables.merge("realtime_city_header", spark.createDataFrame([header(2, None), header(10, DAY.date())], schema), 1)
        tables.merge("realtime_city_header", spark.createDataFrame([header(3, None), header(11, DAY.date())], schema), 2)
        assert rows_of(tables.read("realtime_city_header"), "ingestion_id") == [(1,), (10,), (11,), (2,), (3,)]


def test_a_lost_dimension_is_an_error_and_a_half_written_one_is_not_read(spark):
    tables = warehouse(spark)
    run(spark, tables, 0, [call(1, document(area="POI002"))])
    run(spark, tables, 1, [call(2, document(area="POI001"))])
    good = rows_of(tables.read("dim_location"), "area_code", "location_id")
    assert good == [("POI001", 2), ("POI002", 1)]
    tables._write("dim_location", "data", tables.read("dim_location").where("false"), None)  # and not committed
    assert rows_of(tables.read("dim_location"), "area_code", "location_id") == good
    tables.delete(tables.path("dim_location"))
    with pytest.raises(FileNotFoundError):
        tables.read("dim_location")


def test_marts_follow_a_rename_that_comes_on_another_day(spark):
    tables = warehouse(spark)
    run(spark, tables, 0, [call(1, document(name="Old"))])
    run(spark, tables, 1, [call(2, document(name="New", inner=people(PPLTN_TIME="2024-03-02 09:00")), at="2024-03-02 00:10:00")])
    for name in marts.MARTS[:1] + marts.MARTS[2:]:
        assert {r.area_name for r in load.read_mart(tables, name).collect()} == {"New"}


def test_off_minute_rows_are_refused_not_raised(spark):
    dim = spark.createDataFrame([("POI001", 1)], "area_code string, location_id long")
    rows = [(1, "POI001", datetime(2024, 1, 1, 0, 0, 30)), (2, "POI001", datetime(2024, 1, 1, 0, 1))]
    view = integrity.conform(spark.createDataFrame(rows, "ingestion_id long, area_code string, observed_at timestamp"), POPULATION)
    view = view.withColumn("collected_at", F.col("observed_at")).withColumn("area_name", F.lit("x"))
    found = facts.city_fact_rows(view, dim, at("2024-01-02"))
    kept, broken = integrity.split(found, TABLES["fact_city_snapshot"])
    assert [r.source_ingestion_id for r in kept.collect()] == [2]
    assert [(r.source_ingestion_id, r.violations) for r in broken.collect()] == [(1, ["city_snapshot_id_required"])]


def test_rebuild_equals_the_batches(spark):
    rng = random.Random(3)
    calls = []
    for i in range(60):
        moment = DAY + timedelta(days=59, hours=rng.randrange(6), minutes=rng.randrange(60))
        local = f"2024-02-29 {10 + i % 3}:{(i % 4) * 10:02d}"
        inner = people(PPLTN_TIME=local, AREA_PPLTN_MIN=str(i), AREA_PPLTN_MAX=str(500))
        calls.append(call(i, document(area=f"POI{i % 5:03d}", inner=inner), at=str(moment)))
    tables = warehouse(spark)
    for batch in range(3):
        run(spark, tables, batch, calls[batch * 20:(batch + 1) * 20])
    raw = tables.read("raw_api_response")
    rebuilt = load.rebuild(raw, at("2024-03-01"))
    same = ("date_key", "hour_key", "observed_at", "collected_at", "population_min", "source_ingestion_id")
    by_area = {}
    for kind, fact, dim in (
        ("batches", tables.read("fact_city_snapshot"), tables.read("dim_location")),
        ("rebuilt", rebuilt["fact_city_snapshot"], rebuilt["dim_location"]),
    ):
        by_area[kind] = rows_of(fact.join(dim, "location_id"), "area_code", *same)
    assert by_area["batches"] == by_area["rebuilt"]
    staged = ("area_code", "observed_at", "ingestion_id", "population_snapshot_id")
    staging = rows_of(tables.read("realtime_population_snapshot"), *staged)
    assert staging == rows_of(rebuilt["realtime_population_snapshot"], *staged)


def write_calls(folder, calls):
    folder.mkdir(parents=True, exist_ok=True)
    for area, stamp, xml in calls:
        place = folder / "seoul_realtime_city" / area
        place.mkdir(parents=True, exist_ok=True)
        (place / f"{stamp}-200.xml").write_text(xml, encoding="utf8")


def test_a_landing_folder_is_loaded_as_a_stream(spark, tmp_path):
    folder = tmp_path / "landing"
    write_calls(folder, [("명동 관광특구", "20240229T154000", document()), ("Park", "20240229T154100", document(area="POI002", name="Park"))])
    tables = warehouse(spark)
    checkpoint = scratch_folder(spark, "checkpoint")

    def go():
        calls = source.stream_folder(spark, str(folder))
        jobs.load_batches(calls, tables, checkpoint, lambda _: at("2024-03-01")).awaitTermination()

    go()
    raw = tables.read("raw_api_response").orderBy("area_code").collect()
    assert [(r.raw_id, r.http_status, str(r.requested_at)) for r in sorted(raw, key=lambda r: r.raw_id)][0][1] == 200
    assert {str(r.requested_at) for r in raw} == {"2024-02-29 15:40:00", "2024-02-29 15:41:00"}
    assert {r.raw_id for r in raw} == {1, 2} and raw[0].source_name == "seoul_realtime_city"
    write_calls(folder, [("명동 관광특구", "20240229T155000", document(inner=people(AREA_PPLTN_MIN="7")))])
    go()
    go()  # nothing new
    assert {r.raw_id for r in tables.read("raw_api_response").collect()} == {1, 2, 3}
    assert rows_of(tables.read("fact_city_snapshot"), "source_ingestion_id", "population_min")[-1] == (3, 7)
    assert tables.read("fact_city_snapshot").count() == 2


def test_streaming_state_keeps_the_newest(spark, tmp_path):
    schema = "k long, collected long, arrival long, v string"
    rows = [(1, 5, 1, "a"), (1, 3, 2, "late"), (2, 1, 3, "b"), (1, 5, 4, "tie")]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    groups = jobs.newest_per_key(stream, ["k"], ["collected", "arrival"])
    jobs.emit_updates(groups, str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    assert rows_of(jobs.read_updates(groups, str(tmp_path / "log"), ["k"]), "k", "v") == [(1, "tie"), (2, "b")]


def test_marts_count_unknown_labels_only_in_the_total(spark):
    tables = warehouse(spark)
    docs = [
        document(inner=people(PPLTN_TIME=f"2024-03-01 00:{m:02d}", AREA_CONGEST_LVL=level), weather=sky(WEATHER_TIME=f"2024-03-01 00:{m:02d}", PRECPT_TYPE=rain, AIR_IDX=air))
        for m, level, rain, air in ((0, "여유", "눈", "b"), (5, "odd", "비", "a"), (10, "붐빔", "", "b"), (15, "붐빔", "눈", "a"), (20, "붐빔", "비", "c"))
    ]
    run(spark, tables, 0, [call(i, d) for i, d in enumerate(docs)])
    fact, weather = tables.read("fact_city_snapshot"), tables.read("fact_weather_snapshot")
    dims = [tables.read(n) for n in ("dim_location", "dim_date", "dim_hour")]
    row = marts.population_hourly(fact, *dims).first()
    assert (row.snapshot_count, row.relaxed_count, row.crowded_count, row.very_crowded_count) == (5, 1, 3, 0)
    sky_row = marts.weather_hourly(weather, *dims).first()
    assert (sky_row.no_precipitation_count, sky_row.precipitation_observed_count) == (0, 4)
    assert (sky_row.dominant_precipitation_type, sky_row.dominant_air_quality_index) == ("눈", "a")
    assert sky_row.avg_feels_like_c is None and sky_row.avg_temperature_c == Decimal("-3.50")
    marts.create_views(fact, weather, *dims)
    assert spark.sql("SELECT population_snapshot_count FROM city_population_weather_hourly").first()[0] == 5


def test_areas_without_a_dimension_row_are_left_out_and_listed(spark):
    raw = documents.classify(landing(spark, [call(1, document()), call(2, document(area="POI002"))]), False, True)
    rows = documents.populations(raw, at("2024-03-01"), with_call=True)
    dim = spark.createDataFrame([(1, "POI001")], "location_id long, area_code string")
    assert facts.city_fact_rows(rows, dim, at("2024-03-01")).count() == 1
    assert [r.area_code for r in facts.lookup_misses(rows, dim).collect()] == ["POI002"]
