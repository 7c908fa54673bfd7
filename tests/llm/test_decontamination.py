"""Spaced seeds beside a comparison of every alignment."""

import itertools
import random

from snapfold.llm import common, spaced_seeds as op

SF = "/root/testdata/sf0.01"


def plain(docs, items, settings=op.Settings()):
    """Pairs with a long enough stretch of some diagonal that agrees well enough."""
    out = set()
    for d, text in docs:
        a = op.tokens(text)
        for i, item in items:
            b = op.tokens(item)
            need = min(settings.least_words, len(b))
            for shift in range(-len(b) + 1, len(a)):
                low, high = max(0, shift), min(len(a), shift + len(b))
                same = [a[k] == b[k - shift] for k in range(low, high)]
                if sum(same) >= need * settings.similarity and any(
                        sum(same[x:y]) >= settings.similarity * (y - x) - 1e-9
                        for x in range(len(same)) for y in range(x + need, len(same) + 1)):
                    out.add((d, i))
                    break
    return out


def test_masks_miss_no_pattern_of_substitutions():
    masks = [(sum(1 << k for k, c in enumerate(m) if c == "1"), len(m)) for m in op.Settings().masks]
    for size in range(13, 24):
        for places in itertools.combinations(range(size), int(size * 0.2 + 1e-9)):
            changed = sum(1 << p for p in places)
            assert any(not (mask << at) & changed for mask, span in masks for at in range(size - span + 1))


def test_search_equals_all_alignments():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([5, 9, 13, 15, 30, 50])))) for i in range(25)]
    docs = []
    for d in range(120):
        around = [f"x{rng.randrange(300)}" for _ in range(rng.randrange(30))]
        piece = items[rng.randrange(25)][1].split()
        start = rng.randrange(max(1, len(piece) - 12))
        piece = piece[start:start + rng.randrange(5, 60)]
        for _ in range(rng.randrange(8)):
            piece[rng.randrange(len(piece))] = "changed"
        cut = rng.randrange(len(around) + 1)
        docs.append((d, " ".join(around[:cut] + piece + around[cut:]).upper() + rng.choice(["", ".", " !"])))
    block = op.Benchmark([(i, op.tokens(t)) for i, t in items], op.Settings())
    got = {(docs[t][0], i) for t, i, *_ in block.search([t for _, t in docs])}
    want = plain(docs, items)
    assert got == want and 20 < len(want) < 120


def test_query_finds_the_items(spark):
    found = {(r.doc_id, r.item_id) for r in op.op10_spaced_seeds(spark, SF).collect()}
    items = [(r.item_id, b" ".join(op.tokens(r.text))) for r in common.table(spark, SF, "benchmark").collect()]
    docs = [(r.doc_id, b" " + b" ".join(op.tokens(r.text)) + b" ") for r in common.table(spark, SF, "documents").collect()]
    exact = {(d, i) for d, text in docs for i, item in items if b" " + item + b" " in text}
    assert exact and exact <= found


def test_edges_of_input(spark):
    item = " ".join(f"i{k}" for k in range(20))
    docs = [(1, None), (2, ""), (3, " \n"), (None, item), (5, "a " + item), (5, "a " + item), (6, "x " * 100_000 + item + " y" * 50_000),
            (7, " ".join(item.split()[:12])), (8, "one two three")]
    df = spark.createDataFrame([(*d, "x", 3) for d in docs], "doc_id long, text string, item_id string, n_words int")
    bench = spark.createDataFrame([(9, item), (9, item), (10, None), (11, ""), (12, "one two three"), (None, item), (13, "... !")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in op.overlaps(df, bench).collect()), key=repr)
    assert set(got) == {(d, i) for d in (None, 5, 6) for i in (9, None)} and got.count((5, 9)) == 4
    one_at_a_time = op.overlaps(df, bench, settings=op.Settings(block_words=1))
    assert sorted(((r.doc_id, r.item_id) for r in one_at_a_time.collect()), key=repr) == got
    kept = op.keep_clean(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 7, 8]
    assert op.overlaps(df.limit(0), bench).count() == 0 == op.overlaps(df, bench.limit(0)).count()
    assert op.keep_clean(df, bench.limit(0)).count() == len(docs)
