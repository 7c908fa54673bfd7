"""Periodic runs beside a brute-force version over all periods."""

import hashlib
import random
import time

from pyspark.sql import functions as F

from snapfold.llm import common, periodic_runs as op

SF = "/root/testdata/sf0.001"


def plain(words, least=op.LEAST_WORDS):
    """Every maximal stretch of every period, smallest period first."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i + q < len(words) and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                if i - start >= q and i - start + q >= least:
                    found.setdefault((start, i - start + q), q)
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_equal_brute_force():
    rng = random.Random(3)
    cases = ["", "a", "aa", "a" * 40, "ab" * 30, "aab" * 20, fibonacci(300), ("a" * 12 + "b") * 9, "abc" * 11 + "abd" * 11]
    for _ in range(400):
        n, letters = rng.randrange(90), rng.choice(["ab", "abc", "abcdefgh"])
        cases.append("".join(rng.choice(letters) for _ in range(n)))
    for _ in range(400):  # runs of all periods, broken and nested
        text = ""
        while len(text) < rng.randrange(20, 300):
            piece = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 40)))
            text += (piece * rng.randrange(1, 5))[: rng.randrange(1, 120)]
        cases.append(text)
    for text in cases:
        for least in (2, 12):
            assert op.runs_of(text, least) == plain(text, least), text


def test_words_may_come_in_pieces():
    text = fibonacci(200) + "abcabd" * 20
    for size in (1, 3, 64):
        catchers = op.Catchers()
        for at in range(0, len(text), size):
            catchers.extend(text[at:at + size])
        assert catchers.finish() == op.Catchers().extend(text).finish()


def test_long_periodic_texts_take_little_time():
    start = time.time()
    assert op.runs_of(["a"] * 200_000) == [(0, 200_000, 1)]
    assert op.runs_of(list(range(50_000)) * 3) == [(0, 150_000, 50_000)]
    found = op.runs_of((["a"] * 999 + ["b"]) * 20)
    assert found[0] == (0, 999, 1) and (0, 20_000, 1000) in found and len(found) == 21
    assert time.time() - start < 30


def test_echo_and_digests_equal_plain_python(spark):
    import zlib

    texts = [None, "", " \n", "a", "one two three", " ".join(map(str, range(30))), "x y " * 40, "é ü\x0b\x0cz " * 9]
    rows = [(i, t) for i in range(60) for t in [texts[i % len(texts)]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in op.find_runs(docs.select("doc_id", op.echoed(F.col("text"), F.col("doc_id")).alias("text"))).collect()}
    turned = 0
    for number, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(number).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            turned += 1
        runs = plain(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert [tuple(r) for r in got[number].runs] == runs
        assert got[number].collapsed == b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
    assert turned


def test_query_covers_all_documents(spark):
    docs = common.table(spark, SF, "documents")
    rows = op.op11_periodic_runs(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    empty = hashlib.sha256(b"").hexdigest()
    for r in rows:
        assert (r.n_runs == 0) == (r.start is None) == (r.runs_sha256 == empty)
        assert not r.n_runs or (r.length >= max(12, 2 * r.period) and r.exponent_milli == 1000 * r.length // r.period)


def test_edges(spark):
    docs = spark.createDataFrame(
        [(None, None, 1, "r"), (None, "a " * 20, 2, "r"), ("s", "", 3, "r"), ("s", "a " * 20, 4, "r")],
        "doc_id string, text string, runs int, collapsed string")
    found = op.find_runs(docs).collect()
    assert [(r.doc_id, len(r.runs), r.collapsed) for r in found] == [(None, 0, ""), (None, 1, "a"), ("s", 0, ""), ("s", 1, "a")]
    assert op.find_runs(docs.limit(0)).collect() == []
