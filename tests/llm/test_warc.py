"""WARC round trips, with magics and whole records inside payloads and records over many blocks."""

import hashlib

import duckdb
import pytest

from snapfold.llm import warc as op

SF = "/root/testdata/sf0.001"


def expected(rows):
    bodies = [(i, (html or "").encode()) for i, _, html in rows]
    first = {}
    for i, body in bodies:
        if len(body) >= op.LEAST and i is not None:
            first[body] = max(i, first.get(body, i))
    out = []
    for i, body in bodies:
        copy = body in first and i != first[body]
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if copy else "response", first[body] if copy else None))
    return sorted(out, key=repr)


def round_trip(spark, tmp_path, rows, **settings):
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, digest int, value string")
    folder = f"file://{tmp_path}/warc"
    op.write(pages.repartition(2), folder)
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = op.read(spark, folder).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert all(r.verified is not False for r in found)
    return sorted([tuple(r)[:5] for r in found], key=repr)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    assert sorted(map(tuple, op.op7_warc(spark, SF).collect())) == sorted(con.execute(op.OP7_SQL).fetchall())


@pytest.mark.parametrize("block", ["128m", "900b", "3000b"])
def test_magic_inside_payloads(spark, tmp_path, block):
    inner = (f"{op.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    rows = [
        (1, "http://a/", "<p>é</p>"), (2, None, None), (3, "u\r\nWARC-Type: x", ""), (4, "", "x" * 5000), (5, "", "x" * 5000),
        (6, "", f"a{op.MAGIC}b"), (7, "", inner * 30 + "end"), (8, "", op.MAGIC * 200), (9, "", inner), (10, "", "\r\n\r\n" * 700),
        (11, "", "y" * 999), (12, "", "y" * 999), (None, "", "x" * 5000), (5, "", "x" * 5000), (13, "", op.MAGIC[:-1] * 300),
        (14, "", inner * 30 + "end"),
    ]
    got = round_trip(spark, tmp_path, rows, **{
        "spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"})
    assert got == expected(rows)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    op.write(pages, f"file://{tmp_path}/none")
    assert op.read(spark, f"file://{tmp_path}/none").count() == 0
