"""The transducer beside the reference library of the format, and round trips."""

import random

import numpy as np
import pytest
import sentencepiece

from snapfold.llm import sentencepiece_fst as op

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def machine():
    with open(op.MODEL, "rb") as file:
        return op.Transducer(file.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=op.MODEL)


def test_ids_equal_the_librarys(machine, library):
    rng = random.Random(8)
    parts = [" ", "  ", "   ", " " * 17, "a", "th", "in", "É", "é", "\n", "\t", "日本", "ﬁ", "①", "...", "==", "0", "12", "▁", "aaaa", "　", "\x00", "😀",
             "ing", "er", "((", "--", "//", "_", "the", "The", "tion", "xyz"]
    texts = ["", " ", "x" * 3000, "ab " * 2000] + ["".join(rng.choice(parts) for _ in range(rng.randrange(16))) for _ in range(6000)]
    for text in texts:
        assert machine.encode(text) == library.encode(text), text
        if "▁" not in text:
            assert machine.decode(np.array(machine.encode(text), np.int32)) == text


def test_unigram_paths_are_the_least(machine):
    """With weights on the arcs the path is the least over all ways to cut the word."""
    rng = random.Random(1)
    letters = {"a": -2.0, "b": -2.5, "c": -3.0, "ab": -3.1, "bc": -4.0, "abc": -6.0, "ca": -4.6, "aab": -4.5}
    lattice = op.Transducer.__new__(op.Transducer)
    lattice.text, lattice.score = list(letters), list(letters.values())
    lattice.arcs, lattice.merges, lattice.trie = {t: i for i, t in enumerate(letters)}, False, {}
    for text, i in lattice.arcs.items():
        node = lattice.trie
        for letter in text:
            node = node.setdefault(letter, {})
        node[None] = i

    def least(word):
        return 0.0 if not word else min(least(word[k:]) - letters[word[:k]] for k in range(1, len(word) + 1) if word[:k] in letters)

    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        path = lattice.shortest_path(word)
        assert "".join(lattice.text[i] for i in path) == word
        assert abs(-sum(lattice.score[i] for i in path) - least(word)) < 1e-9


def test_query_round_trips(spark, library):
    rows = op.op9_sentencepiece_fst(spark, SF).collect()
    assert rows and all(r.round_trip for r in rows) and all(r.n_tokens > 0 for r in rows)


def test_edges_of_input(spark, library):
    texts = [None, "", "a b", "a b", "wörd " * 20_000, " lead", "tail "]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, token_ids int, decoded string")
    made = op.encode(df)
    assert sorted(made.columns) == sorted(df.columns)
    got = {r.doc_id: r.token_ids for r in made.collect()}
    assert got == {i: None if t is None else library.encode(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.decoded for r in op.decode(made).collect()} == dict(enumerate(texts))
    assert op.decode(op.encode(df.limit(0))).count() == 0


def test_short_words_are_searched_whole_and_once(machine, library, monkeypatch):
    """A word is one search, not one for each of its parts, unless a letter is in no piece; its ids are those of the parts."""
    rng = random.Random(3)
    words = ["".join(rng.choice(["en", "st", "the", "é", ",", "9", "qx", "ß", "\n", "😀"]) for _ in range(rng.randrange(1, 9))) for _ in range(2000)]
    calls, finite = [], machine.finite
    monkeypatch.setattr(machine, "finite", lambda word: calls.append(word) or finite(word))
    monkeypatch.setattr(machine, "words", op.Recent(machine.words.make, 100_000))
    plain = [w for w in words if "\n" not in w and "😀" not in w]
    assert machine.ids(" ".join(plain)).tolist() == library.encode(" ".join(plain))
    assert sorted(calls) == sorted({op.SPACE + w for w in plain})
    assert machine.ids(" ".join(words)).tolist() == library.encode(" ".join(words))
    whole = [machine.path(w) for w in words]
    monkeypatch.setattr(op, "WHOLE", 0)
    assert [machine.path(w) for w in words] == whole
    monkeypatch.setattr(machine, "parts", op.Recent(machine.parts.make, 10))
    assert machine.path("x" * 3000) and not machine.parts  # held once, as a word


def test_remembered_words_are_bounded():
    made = []
    recent = op.Recent(lambda key: made.append(key) or key.encode(), 3)
    for key in "abcadaea":
        assert recent[key] == key.encode()
        assert len(recent) <= 3 and len(recent.old) <= 3
    assert made == list("abcde")
