"""Queries beside their SQL at the smallest scale; tools/check.py runs them all."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import compare, connect
from snapfold.catalog import registry

SF = "/root/testdata/sf0.001"
SOME = (
    "raw_classify", "gate_reasons", "xml_extract_weather", "json_extract", "decimal_parse", "time_keys",
    "active_locations", "dim_location_upsert", "upsert_guarded", "check_rules", "guarded_fact",
    "document_edges", "population_merge", "header_merge", "mart_after_rename", "audit_city", "reconcile", "mart_merged", "avg_by_area_hour", "stream_hourly",
)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert compare([tuple(r) for r in df.collect()], df.columns, result.fetchall(), columns) == "ok"


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_entry_without_the_optional_package():
    script = (
        "import sys; sys.modules['snapfold.llm'] = None; import __spark_entry__ as e; from snapfold.catalog import registry; "
        "assert set(e.queries()) == set(registry.queries()) == set(e.oracle_sql())"
    )
    done = subprocess.run([sys.executable, "-c", script], cwd=Path(entry.__file__).parent, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
