"""Quality rules beside plain Python, and their bands on prose, loops and noise."""

import random
import re

import pytest
import zstandard

from snapfold.llm import common, quality_rules as op

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
    if many is None:
        from collections import Counter
        many = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in many for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def judged(text):
    return op.judge(text, op.Bands(), zstandard.ZstdCompressor(level=3).compress)


def test_base_counts():
    rng = random.Random(2)
    texts = ["", None, " \n\t", "a b c d e a b c d e", "a " * 50, "é|ü\x0bx\x0cy z", "x\n\nx\n x\nx"]
    texts += ["".join(rng.choice(["a", "b", "c", " ", " ", "\n", "#", "é"]) for _ in range(rng.randrange(400))) for _ in range(200)]
    texts += [" ".join(f"w{rng.randrange(4)}" for _ in range(n)) for n in (5, 6, 30, 2000)]
    for text in texts:
        assert judged(text)[:6] == plain(text), text


def test_codes_stay_exact_when_the_vocabulary_is_large():
    words = [f"w{i}" for i in range(70_000)]
    text = " ".join([*words, *words[100:107], "end"])
    assert judged(text)[4] == 14


def test_bands():
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    noise = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))
    assert all(judged(prose(n))[-1] for n in (12, 40, 150, 1000, 20000))
    wrapped = lambda n: " ".join(noise(60) for _ in range(n // 60))
    assert not judged(wrapped(3000))[-1] and not judged(wrapped(40000))[-1]
    loop = " ".join(f"{w} {w} {w} {w}x" for w in ["one", "two"]) * 200
    assert not judged(loop)[-1]
    half = prose(2000) + " " + wrapped(40000)
    assert not judged(half)[-1] and judged(half)[-2] > 0.5


def test_bands_part_labelled_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = op.op2_quality_rules(spark, sf).join(common.table(spark, sf, "labels"), "doc_id").where("not base_failed").collect()
    kept = lambda label: [r.kept for r in rows if r.quality == label and r.n_words >= 200]
    bad, clean = kept(0), kept(1)
    assert len(bad) > 5 and sum(bad) < 0.2 * len(bad)
    assert len(clean) > 50 and sum(clean) > 0.99 * len(clean)


def test_a_list_of_words_in_a_long_text_shows_in_its_chunks():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9)))
    prose = " ".join(word() for _ in range(5000))
    few = [word() for _ in range(150)]
    some = " | ".join(rng.choice(few) for _ in range(2500))
    got = judged(prose + " " + some)
    assert judged(prose)[-1] and 0.25 <= got[-3] < 0.5 and not got[5] and not got[-1]


def test_query_equals_plain_counts(spark):
    texts = {r.doc_id: r.text for r in common.table(spark, SF, "documents").collect()}
    rows = op.op2_quality_rules(spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in rows} == {i: plain(t) for i, t in texts.items()}
    assert all(not (r.kept and r.base_failed) for r in rows)


def test_edges_of_input(spark):
    df = spark.createDataFrame([(1, None, True, "x"), (None, "", False, "y"), (1, "z " * 200_000, None, None)],
                               "doc_id long, text string, kept boolean, q string")
    assert [r.kept for r in op.assess(df).collect()] == [False] * 3
    good = spark.createDataFrame([(1, "the quick brown fox jumps over a lazy dog and runs home", True, "x")] * 2, df.schema)
    kept = op.keep_good(df.unionAll(good))
    assert kept.columns == df.columns and kept.count() == 2
    assert op.assess(df.limit(0)).count() == 0 == op.keep_good(df.limit(0)).count()
