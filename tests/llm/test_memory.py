"""What bounds the memory of Python workers."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from snapfold.llm import common, simhash_covering, spaced_seeds, suffix_tree


@pytest.fixture
def unset(spark):
    before = spark.conf.get(common.BATCH, None)
    spark.conf.unset(common.BATCH)
    yield spark
    spark.conf.unset(common.BATCH)
    if before is not None:
        spark.conf.set(common.BATCH, before)


@pytest.mark.parametrize("number", [0, 2, 3, 4])
def test_stages_with_python_tasks_get_texts_in_small_batches(unset, number):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    docs = unset.range(0, 1500, 1, 1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 2000).alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(22_000).cast("long").alias("n_chars"))
    pipeline.STAGES[number][1](unset, docs.limit(0), "/root/testdata/sf0.001")
    assert max(r.size for r in docs.mapInArrow(sizes, "size long").collect()) < 5_000_000


def test_a_limit_of_the_session_holds(unset):
    unset.conf.set(common.BATCH, "1m")
    common.small_batches(unset)
    assert unset.conf.get(common.BATCH) == "1m"


def test_memory_of_a_finished_step_goes_back():
    held = pa.array(["x" * 1000] * 50_000)
    del held
    common.give_back()
    assert pa.default_memory_pool().bytes_allocated() < 40_000_000


def test_the_filter_of_a_benchmark_is_small():
    block = spaced_seeds.Benchmark([(1, spaced_seeds.tokens(" ".join(f"w{i}" for i in range(40))))], spaced_seeds.Settings())
    assert all(table[-1].nbytes <= 1 << 19 for table in block.tables)
    assert len(block.search([" ".join(f"w{i}" for i in range(40)), "", None])) == 1


def test_a_filled_bitmap_lets_few_strangers_pass(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_BITMAPS", 1)
    keys = np.random.default_rng(7).integers(0, 1 << 64, 23_000, np.uint64)
    held, strangers = keys[:3000], keys[3000:]
    rows = spark.createDataFrame([(int(k),) for k in held.view(np.int64)], "key long")
    bits = common.Bits.of(rows)
    assert bits.has(held).all() and bits.has(held[:0]).tolist() == []
    assert bits.has(strangers).mean() < 0.05  # one place a hash: 0.09


def peak_mb(step, *arguments):
    tracemalloc.start()
    try:
        step(*arguments)
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_fingerprints_of_special_rows_are_taken_once(spark):
    """Two Python tasks in one take two workers a core, and the first read the texts of all rows."""
    docs = spark.createDataFrame([(i, f"some words of text number {i // 2} here", "en") for i in range(40)], "doc_id long, text string, lang string")
    plan = simhash_covering.keep_first(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_hashing_words_holds_little_beside_the_text():
    data = np.frombuffer(b"some words of seven more " * 80_000, np.uint8)  # 2 MB
    inside = data != 32
    assert peak_mb(common.words_of, data, inside) < 25  # all at once: 51


@pytest.mark.parametrize("step", [1, 7, 64, 1 << 16])
def test_words_hash_the_same_in_any_step(monkeypatch, step):
    def alone(word):
        powers = [pow(int(common._PRIME), j + 1, 1 << 64) for j in range(len(word))]
        return sum(int(common._BYTES[c]) * p for c, p in zip(word, powers)) % (1 << 64)

    monkeypatch.setattr(common, "STEP", step)
    for text in (b"", b" ", b"a", b"a bc  def ", b" one" * 50 + b" " + b"x" * 300 + b" one"):
        data = np.frombuffer(text, np.uint8)
        starts, ends, hashed = common.words_of(data, data != 32)
        assert [text[a:b] for a, b in zip(starts, ends)] == text.split()
        assert hashed.tolist() == common.mixed(np.array([alone(w) for w in text.split()], np.uint64)).tolist()


def test_a_tally_merges_column_by_column():
    rng, tally, found = np.random.default_rng(5), common.Tally(), []
    parts = [np.unique(rng.integers(0, 1 << 20, 100_000).astype(np.uint64)) for _ in range(8)]

    def count():
        for keys in parts:
            found.extend(tally.add(keys.copy(), np.full(len(keys), 2), keys * 3, keys * 5, keys * 7))
        found.extend(tally.rest())

    assert peak_mb(count) < 80  # all columns at once: 101
    (keys, n, three, five, seven), = found
    assert dict(zip(keys.tolist(), n.tolist())) == {k: 2 * c for k, c in Counter(np.concatenate(parts).tolist()).items()}
    assert (three == keys * 3).all() and (five == keys * 5).all() and (seven == keys * 7).all()


def test_answers_are_looked_up_with_little_beside_them():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 64, 1_100_000, np.uint64))
    numbers = np.arange(len(keys), dtype=float) + 1
    assert peak_mb(suffix_tree._Held, keys, numbers) < 30  # all first places at once: 33.6
    held = suffix_tree._Held(keys, numbers)
    assert (held.of(keys[::7]) == numbers[::7]).all()
    assert (held.of(np.array([keys[5] + 1, 0, 2**64 - 1], np.uint64)) == 0).all()


def test_a_block_asks_for_each_key_once(monkeypatch):
    monkeypatch.setattr(suffix_tree._Asked, "LEAST", 10)
    asked, parts = suffix_tree._Asked(), [np.arange(k, k + 9, dtype=np.uint64) for k in (5, 0, 3, 40, 5, 2)]
    assert [keys.tolist() for keys in suffix_tree._Asked().all()] == [[], []]
    for part in parts:
        asked.add((part, part[:1] + np.uint64(100)))
    assert asked.all()[0].tolist() == [*range(14), *range(40, 49)]
    assert asked.all()[1].tolist() == [100, 102, 103, 105, 140]


def test_the_suffix_tree_gets_texts_in_small_batches(unset, tmp_path):
    suffix_tree.op12_suffix_tree(unset, "/root/testdata/sf0.001")
    assert unset.conf.get(common.BATCH) == common.BATCH_BYTES
