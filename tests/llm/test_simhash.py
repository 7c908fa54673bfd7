"""Covering SimHash beside a comparison of all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from snapfold.llm import common, simhash_covering as op
from snapfold.llm.components import connected

SF = "/root/testdata/sf0.001"


def plain_print(text):
    words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in split(text)]
    rows = [words[i:i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
    counts = [0] * 64
    for row in rows:
        h = xxhash.xxh64(" ".join(row).encode(), seed=42).intdigest()
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(rows))


def split(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_groups(prints, radius=4):
    """Component per distinct print, as the set of its prints."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                parent[top(a)] = top(b)
    return {p: top(p) for p in prints}


def expected(rows):
    prints = {i: plain_print(t) for i, t in rows}
    groups = plain_groups(prints.values())
    least = {}
    for i, p in prints.items():
        least[groups[p]] = min(least.get(groups[p], i), i)
    return {i: (f"{p:016x}", least[groups[p]]) for i, p in prints.items()}


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    rng = random.Random(radius)
    table = [m & (1 << 64) - 1 for m in op.masks(radius)]
    for _ in range(3000):
        change = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not change & m for m in table)


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op.op4_simhash_covering(spark, SF).collect()}
    assert got == expected(rows)


def test_edges_of_input(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (6, "É a b c d"),
            (7, "é a b c d"), (8, "w " * 30000), (None, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1)).withColumn("root", F.lit(2))
    got = op.group(df).collect()
    assert len(got) == len(rows)
    want = expected([r for r in rows if r[0] is not None])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [4]
    assert sorted(r.doc_id for r in op.keep_first(df).collect() if r.doc_id) == sorted({c for _, c in want.values()})
    assert op.group(df.limit(0)).count() == 0
    assert op.keep_first(df).columns == df.columns


def test_large_buckets_are_tiled(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 3)
    prints = {int(b) ^ sum(1 << int(x) for x in rng.choice(63, rng.integers(0, 6), replace=False)) for b in base for _ in range(300)}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = plain_groups(prints)
    for tile in (16, 2048):
        roots = {r.node: r.root for r in connected(op.links(df, tile=tile)).collect()}
        got = {p: roots.get(p, p) for p in prints}
        assert len({(got[p], want[p]) for p in prints}) == len(set(got.values())) == len(set(want.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(5, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{k: 100 for k in range(101, 160)}}


def test_texts_that_share_an_id_each_speak_for_their_component(spark):
    text = lambda n: " ".join(f"{n}word{k * n}" for k in range(60))
    rows = [(1, text(3)), (2, text(3)), (2, text(5)), (3, text(5)), (4, text(7)), (4, text(11)), (4, text(11))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in op.keep_first(docs).collect())
    assert kept == sorted([(1, text(3)), (2, text(5)), (4, text(7)), (4, text(11))])


def test_columns_with_any_name_are_kept(spark):
    names = ("__hash", "__special", "__bucket", "__marks", "__own", "__others", "col1", "__fp")
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "quite another text of some words")], "doc_id long, text string")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    rows = sorted(op.keep_first(docs).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [1, 3]
    assert [[r[n] for n in names] for r in rows] == [[f"{n}{r.doc_id}" for n in names] for r in rows]
