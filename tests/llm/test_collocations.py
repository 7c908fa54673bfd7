"""Collocations beside plain counting over every piece."""

import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa

from snapfold.llm import collocations as op, common

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(rows, s):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(UPPER)):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for size in range(1, s.words + 1):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        c = {p: a for p, a in counts.items() if len(p) > 1 and a >= s.least}
        found = []
        for p, a in c.items():
            if any(len(q) > len(p) and 100 * b >= s.cover_percent * a and any(
                    q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in c.items()):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:s.top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def corpus(seed, rows=120):
    rng = random.Random(seed)
    words = ["The", "of", "new", "york", "times", "é", "STRASSE", "straße", "a-b", "#1", "I"] + [f"w{i}" for i in range(30)]
    hot = " ".join(rng.choice(words) for _ in range(25)) + ". New York Times, of the new york"
    out = [(None, "en"), ("", None), (" .,;\t\n", "fr"), ("ΑΒΓ É I ı", None)]
    for _ in range(rows):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", "\n", "\x0b", "! "]) for _ in range(rng.randrange(60)))
        out.append((text + (hot if rng.random() < 0.5 else ""), rng.choice(["en", "en", "de", None])))
    return out


def found(spark, rows, settings):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    return sorted(tuple(r) for r in op.collocations(docs, settings=settings).collect())


def test_equal_to_plain_counts(spark):
    for seed, settings in ((1, op.Settings(least=5)), (2, op.Settings(least=4, modulus=2, top=7, range_words=100)), (3, op.Settings(words=4, least=6, modulus=3))):
        rows = corpus(seed)
        assert found(spark, rows, settings) == plain(rows, settings)


def test_chunks_hold_every_phrase_once():
    rng = random.Random(5)
    for words, modulus in product((2, 3, 5), (1, 2, 8)):
        s = op.Settings(words=words, modulus=modulus)
        texts = [" ".join(rng.choice("abcde") for _ in range(rng.randrange(40))) + rng.choice([".", ""]) for _ in range(50)]
        chunks = op.cut(texts, s)
        names = list(chunks)
        places = op._Places("en", [c for c, _ in names], np.array([e for _, e in names]), np.array([chunks[c] for c in names]), words - 1)
        for size in range(1, words + 1):
            got = Counter()
            at = places.at(size)
            for phrase, n in zip(places.texts(at, size), places.n[at].tolist()):
                got[phrase] += n
            wanted = Counter()
            for text in texts:
                w = text.rstrip(".").split()
                wanted.update(" ".join(w[i:i + size]) for i in range(len(w) - size + 1))
            assert got == wanted


def test_places_are_made_of_arrow_columns():
    """Chunks are read as a column, sliced or not, with no object for each; their places are those of a list."""
    rng = random.Random(7)
    rows = [(rng.choice(["en", "", "straße"]), " ".join(rng.choice(["é", "b", "new"]) for _ in range(rng.randrange(1, 9))).encode(),
             rng.random() < 0.5, rng.randrange(1, 5)) for _ in range(400)]
    names = ["lang", "chunk", "closed", "n"]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    assert isinstance(op._Places("en", whole.column("chunk"), np.ones(400, bool), np.ones(400, np.int64), 2).plain, bytes)
    got = []
    for name, places in op._each(iter([whole.slice(3, 150), whole.slice(153, 0), whole.slice(153)]), op.Settings(), lambda *found: [found]):
        own = [r for r in rows[3:] if r[0] == name]
        wanted = op._Places(name, [r[1] for r in own], np.array([r[2] for r in own]), np.array([r[3] for r in own]), 2)
        for size in (1, 2, 3):
            at = places.at(size)
            assert at.tolist() == wanted.at(size).tolist() and places.texts(at, size) == wanted.texts(at, size)
            keys, first, total = places.sum(places.keys(size), at)
            assert total.sum() == wanted.n[at].sum() and len(keys) == len(set(wanted.texts(at, size))) == len(set(places.texts(first, size)))
        got.append(name)
    assert got == list(dict.fromkeys(r[0] for r in rows[3:]))
    assert list(op._each(iter([whole.slice(0, 0)]), op.Settings(), lambda *found: [found])) == []


def test_copies_share_chunks():
    rng = random.Random(6)
    passage = " ".join(f"x{rng.randrange(1000)}" for _ in range(400))
    once, often = op.cut([passage], op.Settings()), op.cut([f"other {i} words {passage}" for i in range(50)], op.Settings())
    assert len(often) < len(once) + 110 and max(often.values()) == 50


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    rows, settings = corpus(8), op.Settings(least=4)
    wanted = found(spark, rows, settings)
    monkeypatch.setattr(common.Bits, "has", lambda self, keys: np.ones(len(keys), bool))
    docs = spark.createDataFrame(rows, "text string, lang string")
    parsed = op.parse(docs, settings=settings)
    assert parsed.count() and found(spark, rows, settings) == wanted


def test_exact_past_64_bits(spark):
    big = 3_000_000_000_000
    candidates = spark.createDataFrame([("en", "a b", 2, big), ("en", "c d", 2, 7)], "lang string, phrase string, size int, a long")
    parts = spark.createDataFrame([("en", "a", big + 1), ("en", "b", big + 2), ("en", "c", 10**9), ("en", "d", 10**9)], "lang string, phrase string, f long")
    got = {r.phrase: r.score for r in op.score(candidates, parts).collect()}
    assert got == {"a b": 1000000 * big * big // ((big + 1) * (big + 2)), "c d": 0}


def test_edges(spark):
    rows = [("new york", None, 1, "x")] * 12 + [(None, "en", 2, "x"), ("one", "en", 2, "x")]
    docs = spark.createDataFrame(rows, "text string, lang string, n int, phrase string")
    assert [tuple(r) for r in op.collocations(docs).collect()] == [("und", 1, "new york", 12, 12, 12, 24, 1000000)]
    assert op.collocations(docs.limit(0)).collect() == []
    long = spark.createDataFrame([("go on " * 300_000, "en")], "text string, lang string")
    assert sorted((r.phrase, r.a) for r in op.collocations(long).collect()) == [("go on go", 299_999), ("on go on", 299_999)]
