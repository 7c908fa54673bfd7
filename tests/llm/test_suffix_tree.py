"""The suffix tree beside one built with plain dictionaries, and on documents it has not seen."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from snapfold.llm import common, suffix_tree as op

SF = "/root/testdata/sf0.001"
END = "<end>"


class Plain:
    """All contexts in dictionaries; the same definition, token by token."""

    def __init__(self, texts, s):
        self.s, self.next = s, defaultdict(Counter)
        for text in texts:
            words = self.tokens(text)
            for i, x in enumerate(words):
                for d in range(min(i, s.depth) + 1):
                    self.next[tuple(words[i - d:i])][x] += 1
        self.n, self.v, self.states = sum(self.next[()].values()), len(self.next[()]), {}
        for d in range(1, s.depth + 1):
            for ctx in [c for c in self.next if len(c) == d and END not in c]:
                counts = self.next[ctx]
                total, apiece = sum(counts.values()), {x: n for x, n in counts.items() if n >= s.evidence}
                if total < s.least or not apiece:
                    continue
                short = {x: self.p(ctx[1:], x) for x in apiece}
                rest, other = total - sum(apiece.values()), max(1 - sum(short.values()), 1e-12)
                gain = sum(n * math.log(n / total / short[x]) for x, n in apiece.items())
                gain += rest * math.log(rest / total / other) if rest else 0
                if gain >= s.nats * (len(apiece) + 1):
                    self.states[ctx] = (apiece, total, 1 - sum(n - s.discount for n in apiece.values()) / total)

    @staticmethod
    def tokens(text):
        lowered = "".join(c.lower() if c < "\x7f" else c for c in text or "")
        return [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in lowered).split(" ") if w] + [END]

    def p(self, ctx, x):
        p = (self.next[()][x] + 0.1) / (self.n + 0.1 * (self.v + 1))
        for d in range(1, len(ctx) + 1):
            if ctx[-d:] in self.states:
                apiece, total, back = self.states[ctx[-d:]]
                p = back * p + ((apiece[x] - self.s.discount) / total if x in apiece else 0)
        return p

    def score(self, text):
        words = self.tokens(text)
        known = sum(self.next[()][x] > 0 for x in words)
        base = sum(math.log10(self.p((), x)) for x in words)
        return len(words), known, base, sum(math.log10(self.p(tuple(words[max(0, i - self.s.depth):i]), x)) for i, x in enumerate(words))


def corpus(seed, rows=150):
    rng = random.Random(seed)
    passage = [f"p{rng.randrange(40)}" for _ in range(30)]
    out = [None, "", " \n"]
    for _ in range(rows):
        words = [rng.choice(["The", "of", "É", "x", "y"]) if rng.random() < 0.6 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(40))]
        if rng.random() < 0.4:
            words[5:5] = passage[rng.randrange(10):]
        out.append("".join(w + rng.choice([" ", "\n", " \x0b"]) for w in words))
    return out


@pytest.mark.parametrize("settings", [op.Settings(depth=3, least=4, nats=1.0), op.Settings(depth=2, least=6, evidence=2, block_chars=500, range_chars=300), op.Settings(depth=4, least=3, evidence=2, nats=0.3, discount=0.5)])
def test_equals_plain_tree(spark, settings):
    train, unseen = corpus(1), corpus(2, 40) + ["p1 p2 p3 never seen"]
    model = op.fit(spark.createDataFrame([(t,) for t in train], "text string").repartition(3), settings=settings)
    plain = Plain(train, settings)
    assert (model.tokens, model.words) == (plain.n, plain.v) and len(plain.states) > 20
    assert {len(c) for c in plain.states} == set(range(1, settings.depth + 1))
    rows = list(enumerate(train + unseen))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in op.score(docs, model).collect()}
    assert len(got) == len(rows)
    for number, text in rows:
        n, known, base, score = plain.score(text)
        r = got[number]
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-6)


def test_states_sum_to_one():
    plain = Plain(corpus(3), op.Settings(depth=3, least=4, nats=0.5))
    for ctx in [(), *list(plain.states)[:60]]:
        total = sum(plain.p(ctx, x) for x in [*plain.next[()], "unknown"])
        assert total == pytest.approx(1, abs=1e-9)


def test_query_beats_words_alone_on_unseen_documents(spark):
    rows = op.op12_suffix_tree(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in common.table(spark, SF, "documents").select("doc_id").collect())
    unseen = [r for r in rows if r.held_out]
    assert unseen and sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert len({r.train_tokens for r in rows}) == 1
    assert all(r.n_known == r.n_tokens for r in rows if not r.held_out)


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, 1, 2), (None, "a b a b", 1, 2), ("s", "a b a b", 1, 2), ("s", "a b a b", 1, 2)],
                                 "doc_id string, text string, block int, key int")
    model = op.fit(docs.limit(0))
    assert (model.tokens, model.words) == (0, 0)
    rows = op.score(docs, model).collect()
    assert [r.score for r in rows] == [0.0] * 4 and sorted(r.n_tokens for r in rows) == [1, 5, 5, 5]
    model = op.fit(docs)
    assert op.score(docs.limit(0), model).collect() == []
    assert len({(r.base_score, r.score) for r in op.score(docs, model).where("n_tokens = 5").collect()}) == 1
    long = spark.createDataFrame([(1, "go on " * 200_000)], "doc_id int, text string")
    r = op.score(long, op.fit(long)).first()
    assert r.n_tokens == 400_001 and r.score > -100 and np.isfinite(r.base_score)
