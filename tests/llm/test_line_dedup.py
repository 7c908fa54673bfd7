"""Line dedup beside its SQL and beside a comparison of all pairs of lines."""

import random
import re

import duckdb
import pytest

from pyspark.sql import functions as F

from snapfold.llm import line_dedup as op

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    """Whether two different word lists are one insertion, deletion or replacement apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    back = 0
    while back < min(len(a), len(b)) - front and a[-1 - back] == b[-1 - back]:
        back += 1
    return max(len(a), len(b)) - front - back <= 1


def expected(rows):
    lines = []
    for doc, text in rows:
        for no, body in enumerate((text or "").split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", body)
            if text is not None and words:
                lines.append(((doc, no), words))
    out = set()
    for rank, words in lines:
        for other, theirs in lines:
            if other < rank and (words == theirs or min(len(words), len(theirs)) >= op.MIN_WORDS and one_edit(words, theirs)):
                out.add(rank)
                break
    return out


def got(df):
    return {(r.doc, r.line) for r in op.dropped_lines(df).collect()}


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(op.OP1_SQL).fetchall()}
    rows = {r.doc_id: tuple(r)[1:] for r in op.op1_line_dedup(spark, SF).collect()}
    assert rows == want
    assert sum(r[1] for r in rows.values()) > 0


def test_edits_at_every_place(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(6)}" for _ in range(n)] for n in (7, 8, 9, 16, 33, 64, 70) for _ in range(2)]
    rows, no = [], 0
    for words in base:
        for place in range(len(words) + 1):
            for change in ([], [words[place]] if place < len(words) else [], ["new"], ["other", "two"]):
                rows.append((no, " ".join(words[:place] + change + words[place + 1:])))
                no += 1
    rng.shuffle(rows)
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


@pytest.mark.parametrize("hot", [400])
def test_one_line_with_many_endings(spark, hot):
    start = "all rights of this long line are kept by number"
    rows = [(i, f"{start} {i}\nown words of line {i} that nobody else has at all {i * 7}x\n") for i in range(hot)]
    gone = got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert gone == {(i, 0) for i in range(1, hot)}


def test_edges_of_input(spark):
    long_line = " ".join(f"x{i % 977}" for i in range(5000))
    rows = [(3, None), (4, ""), (5, " \n\t"), (6, "a b\n\na b"), (7, "A b\na  b "), (8, long_line), (9, long_line + " end"),
            (9, "twice\nonce here"), (9, "twice\nonce here"), (1, "twice")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, dropped int, words int")
    assert got(df) == expected(rows)
    kept = op.dedup_lines(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text is not None) == [
        (1, "twice"), (4, ""), (5, " \n\t"), (6, "a b\n"), (7, "A b"), (8, long_line), (9, "once here"), (9, "once here")]
    assert kept.where("text is null").count() == 1
    assert got(df.limit(0)) == set() and op.dedup_lines(df.limit(0)).count() == 0
    assert op.dropped_lines(spark.createDataFrame([(None, "q w"), (1, "q w")], "doc_id long, text string")).count() == 1


def test_texts_that_share_an_id_or_have_none_are_judged_for_themselves(spark, tmp_path):
    rows = [(None, "only one here\nsaid twice"), (None, "said twice\nonly two here"), (None, "said twice\nonly two here"),
            (7, "only three here\nthe same"), (7, "the same\nonly four here"), (8, "only five here\nsaid twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text.split("\n")) for r in op.dedup_lines(docs).collect()]
    lines = [(i, line) for i, text in kept for line in text]
    assert lines.count((None, "only one here")) == 1 and lines.count((None, "only two here")) == 2
    assert all((i, f"only {n} here") in lines for i, n in [(7, "three"), (7, "four"), (8, "five")])
    # of lines that stand in several documents those of one stay: a document's repeated rows agree
    assert [x for x in lines if x[1] == "the same"] == [(7, "the same")]
    assert [x for x in lines if x[1] == "said twice"] in ([(None, "said twice")], [(None, "said twice")] * 2)
    assert len(kept) == 6

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = [(r.doc_id, r.n_lines, r.n_dropped) for r in op.op1_line_dedup(spark, str(tmp_path)).collect()]
    assert len(found) == 6 and {n for _, n, _ in found} == {2}
    assert sum(n for _, _, n in found) == 12 - len(lines) and sum(n for i, _, n in found if i is None) in (1, 2)


def test_columns_with_any_name_are_kept(spark):
    names = ("__hash", "__touched", "__dropped", "__bucket", "__marks", "__doc", "__others", "col1", "__id", "__text")
    line = "one two three four five six seven eight"
    docs = spark.createDataFrame([(i, line + f"\nown {i}") for i in range(2)], "doc_id long, text string")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    rows = sorted(op.dedup_lines(docs).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == [line + "\nown 0", "own 1"]
    assert [[r[n] for n in names] for r in rows] == [[f"{n}{r.doc_id}" for n in names] for r in rows]
