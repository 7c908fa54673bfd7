"""Language-model scoring by a probabilistic suffix tree over words.

A token's state is the longest retained suffix of the words before it, up to ``depth`` words.  The root is the
smoothed word distribution of the corpus.  Level by level, every context that occurs ``least`` times is a candidate:
its next tokens seen ``evidence`` times are counted apiece and the others as one.  It is retained if telling its
tokens from what the shorter states predict saves ``nats`` for every number so kept (the divergence of the two
distributions, times the occurrences).  A retained context s gives token x the probability
``(c(s, x) - discount + rest * P(x | next shorter state)) / N(s)``, without the first two terms if x is not kept
apiece; rest is what all kept tokens leave of N(s).  So every state's distribution sums to one, with 0.1 of a token
left to unknown words at the root.

Counts come from the whole corpus and live in tables keyed by 64-bit hashes of word sequences.  Tasks count what
they read and send packed arrays, dealt by key ranges whose number grows with the corpus, so no key is hot.  Most
sequences occur once: 32 bits of each key are counted first, and only sequences that may reach ``evidence`` are sent
whole and counted exactly.  Texts are scored in blocks: a block asks for the distinct keys of its tokens, packed by
key range; each range answers from its part of the model with one number for each key, in the order asked; and the
answers meet the block's texts again, which give the same keys in the same order.  Bitmaps of bounded size keep most
questions without an answer from being asked.

Defined results: null texts are empty, hence the end token alone; rows without an id are learned from; texts are read
whole; repeated rows count and score each; with nothing to learn from, every token has probability 1; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import saved, scratch_folder
from . import common

SEED = 42
END = 0x6A09E667F3BCC909  # the key of the end token
STATE, PAIR = np.uint64(0x5DEECE66D1F3A7B9), np.uint64(0xA3C59AC2B7E15163)  # told apart from words, and each other
ADDED = 0.1


@dataclass(frozen=True)
class Settings:
    depth: int = 2
    least: int = 10
    evidence: int = 3
    nats: float = 4.0
    discount: float = 0.75
    block_chars: int = 16_000_000  # of texts scored at once
    range_chars: int = 8_000_000  # of texts for each range of keys counted at once


@dataclass(frozen=True)
class Model:
    rows: DataFrame  # (key, n, f): words' counts, states' and pairs' factors
    tokens: int
    words: int
    ranges: int  # of keys, by the size of what was learned from
    states: common.Bits
    pairs: common.Bits
    settings: Settings


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


class _Tokens:
    """The hashed tokens of some texts in one array, each text with its end; no object per word."""

    def __init__(self, texts: list[str | None]) -> None:
        raw = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = common.LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
        starts, _, words = common.words_of(data, ~_SPACE[data])
        until = np.searchsorted(starts, np.cumsum(lengths + 1))  # words up to the end of each text
        self.sizes = np.diff(np.concatenate(([0], until))) + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.hashed = np.insert(words, until, np.uint64(END))
        self._keys = [self.hashed]

    def forget(self) -> None:
        """Let go of all keys but those of single tokens."""
        del self._keys[1:]

    def keys(self, size: int) -> np.ndarray:
        """Of the ``size`` tokens that begin at each place."""
        while len(self._keys) < size:
            self._keys.append(common.longer(self._keys[-1], self.hashed, len(self._keys) + 1))
        return self._keys[size - 1]

    def after(self, depth: int) -> np.ndarray:
        """Places with ``depth`` words before them in their text."""
        there = np.ones(len(self.hashed), bool)
        for place in range(depth):
            there[self.starts[self.sizes > place] + place] = False
        return np.flatnonzero(there)


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns.values()], list(columns))


def _planes(values: np.ndarray) -> bytes:
    """The bytes of numbers, first bytes first: those that hardly vary lie together and compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().reshape(-1).view(kind)


def _steps(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    return _planes(np.diff(keys, prepend=keys.dtype.type(0)))


def _walked(planes: bytes, kind: type = np.uint64) -> np.ndarray:
    return np.cumsum(_numbers(planes, kind), dtype=kind)


def _by_range(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """The ranges, by first bits, that sorted keys fall in, and where the keys of each stand."""
    own = (keys >> np.uint64(65 - ranges.bit_length())).astype(np.int32)
    edges = np.flatnonzero(np.diff(own, prepend=-1))
    for start, end in zip(edges.tolist(), [*edges[1:].tolist(), len(keys)]):
        yield int(own[start]), slice(start, end)


WORDS, NEXT, LIKELY = 0, 1, 2
PACKED = "kind int, range int, key binary, up binary, sym binary, n binary"
COUNTED = "kind int, key long, up long, sym long, n long"


def _scan(docs: DataFrame, depth: int, ranges: int, settings: Settings,
          frequent: common.Bits | None, likely: common.Bits | None) -> DataFrame:
    """One pass over the texts: the next tokens of contexts of ``depth`` words, and what may be counted in the next.

    Depth 0 counts the words.  The sequences of a depth that are likely to occur often enough are found in the pass
    before, among those whose context is.
    """
    low = np.uint64(33 - ranges.bit_length())  # bits of a sequence that are not counted: all but 32 behind its range's

    def count(tokens: _Tokens) -> Iterator[tuple]:
        if depth == 0:
            yield WORDS, *np.unique(tokens.hashed, return_counts=True)
        else:
            at = tokens.after(depth) - depth
            at = at[frequent.has(tokens.keys(depth)[at]) & likely.has(tokens.keys(depth + 1)[at] >> low)]
            keys, first, n = np.unique(tokens.keys(depth + 1)[at], return_index=True, return_counts=True)
            at = at[first]
            up = [tokens.keys(depth - 1)[at + 1]] if depth > 1 else []
            yield NEXT, keys, n, tokens.keys(depth)[at], *up
        if depth < settings.depth:
            at = tokens.after(depth + 1) - depth - 1
            if depth:
                at = at[likely.has(tokens.keys(depth + 1)[at] >> low)]
            yield LIKELY, *np.unique(tokens.keys(depth + 2)[at], return_counts=True)

    def pack(kind: int, keys: np.ndarray, n: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        if kind == NEXT:  # by context, so that what a context's entries share is a step of zero
            order = np.argsort(columns[0])
            contexts, *up = (c[order] for c in columns)
            ups = up[0] if up else np.zeros(len(order), np.uint64)
            symbols = keys[order] ^ common.mixed(contexts)  # a key is made of these two
            n, cut = n[order], list(_by_range(contexts, ranges))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cut), kind, np.int32)), pa.array([r for r, _ in cut], pa.int32()),
                 *(pa.array([packing(c[at]) for _, at in cut], pa.binary())
                   for c, packing in ((contexts, _steps), (ups, _steps), (symbols, np.ndarray.tobytes), (n, _planes)))],
                ["kind", "range", "key", "up", "sym", "n"])
            return
        cut = list(_by_range(keys, ranges))
        if kind == LIKELY:
            keys, n = (keys >> low).astype(np.uint32), np.minimum(n, 255).astype(np.uint8)
        nothing = pa.nulls(len(cut), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cut), kind, np.int32)), pa.array([r for r, _ in cut], pa.int32()),
             pa.array([_steps(keys[at]) for _, at in cut], pa.binary()), nothing, nothing,
             pa.array([_planes(n[at]) for _, at in cut], pa.binary())], ["kind", "range", "key", "up", "sym", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {kind: common.Tally() for kind in (WORDS, NEXT, LIKELY)}
        for batch in batches:
            for _, texts in common.parts(batch, "text"):
                for kind, *found in count(_Tokens(texts)):
                    for merged in tallies[kind].add(*found):
                        yield from pack(kind, *merged)
        for kind, tally in tallies.items():
            for merged in tally.rest():
                yield from pack(kind, *merged)

    def reduce(key: tuple, rows: pa.Table) -> pa.Table:
        counted = total(key, rows)
        common.give_back()
        return counted

    def total(key: tuple, rows: pa.Table) -> pa.Table:
        kind, own = key[0].as_py(), key[1].as_py()
        if kind != NEXT:
            of_key, of_n = (np.uint32, np.uint8) if kind == LIKELY else (np.uint64, np.int64)
            keys = np.concatenate([_walked(raw, of_key) for raw in rows.column("key").to_pylist()])
            keys, times, _ = common.summed(keys, np.concatenate([_numbers(raw, of_n) for raw in rows.column("n").to_pylist()]))
            if kind == LIKELY:
                keys = keys.astype(np.uint64) | np.uint64(own << 32)
        else:
            contexts = np.concatenate([_walked(raw) for raw in rows.column("key").to_pylist()])
            ups = np.concatenate([_walked(raw) for raw in rows.column("up").to_pylist()])
            symbols = common.unpacked(rows, "sym", np.uint64)
            _, times, first = common.summed(
                common.mixed(contexts) ^ symbols, np.concatenate([_numbers(raw, np.int64) for raw in rows.column("n").to_pylist()]))
            keys, ups, symbols = contexts[first], ups[first], symbols[first]
        enough = times >= (1 if kind == WORDS else settings.evidence)
        nothing = np.zeros(len(keys), np.uint64)
        more = {"up": ups, "sym": symbols} if kind == NEXT else {"up": nothing, "sym": nothing}
        return pa.Table.from_batches([_batch(
            kind=np.full(int(enough.sum()), kind, np.int32), key=keys[enough],
            **{name: c[enough] for name, c in more.items()}, n=times[enough])])

    return docs.select("text").mapInArrow(common.lean(run), PACKED).groupBy("kind", "range").applyInArrow(reduce, COUNTED)


WORD, FACTOR = 0, 1  # what is asked for
KINDS = {WORD: np.int64, FACTOR: np.float32}


def _packed_model(rows: DataFrame, ranges: int) -> DataFrame:
    """(kind, range, key, value): the model's keys and numbers, many to a row."""
    def pack(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, f = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("key", "n", "f"))
        key = key.view(np.uint64)
        for kind, of_kind, values in ((WORD, n > 0, n), (FACTOR, n == 0, f)):
            order = np.flatnonzero(of_kind)
            order = order[np.argsort(key[order])]
            keys, numbers = key[order], values[order].astype(KINDS[kind])
            cut = list(_by_range(keys, ranges))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(cut), kind, np.int32)), pa.array([r for r, _ in cut], pa.int32()),
                pa.array([_steps(keys[at]) for _, at in cut], pa.binary()),
                pa.array([_planes(numbers[at]) for _, at in cut], pa.binary())], ["kind", "range", "key", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= common.Tally.LIMIT:
                yield from pack(held)
                held, size = [], 0
        if held:
            yield from pack(held)

    return rows.mapInArrow(common.lean(run), "kind int, range int, key binary, value binary")


class _Asked:
    """The distinct keys of each kind that a block asks for.  What comes in is merged once it is half of what is held."""

    LEAST = 500_000

    def __init__(self) -> None:
        self.held: list[list[np.ndarray]] = [[] for _ in KINDS]

    def add(self, wanted: tuple[np.ndarray, ...]) -> None:
        for held, keys in zip(self.held, wanted):
            held.append(keys)
            if sum(map(len, held[1:])) > max(len(held[0]) // 2, self.LEAST):
                self._merge(held)

    def _merge(self, held: list[np.ndarray]) -> None:
        keys = np.concatenate([*held, np.zeros(0, np.uint64)])
        held.clear()
        held.append(common.distinct(keys))

    def all(self) -> list[np.ndarray]:
        for held in self.held:
            self._merge(held)
        return [keys for keys, in self.held]


class _Held:
    """Numbers of sorted, well-spread keys.  A key's first bits say where to begin looking, a step or two away."""

    def __init__(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.empty(1 << bits, np.int32)
        for low in range(0, 1 << bits, common.STEP):
            high = min(low + common.STEP, 1 << bits)
            self.starts[low:high] = np.searchsorted(keys, np.arange(low, high, dtype=np.uint64) << self.shift)
        self.keys, self.numbers = np.append(keys, np.uint64(2**64 - 1)), np.append(numbers, 0)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """The numbers of keys; 0 for one that is not held."""
        place = np.take(self.starts, (wanted >> self.shift).view(np.int64))
        there = np.take(self.keys, place)
        behind = np.flatnonzero(there < wanted)
        while len(behind):
            place[behind] += 1
            there[behind] = now = self.keys[place[behind]]
            behind = behind[now < wanted[behind]]
        return np.where(there == wanted, np.take(self.numbers, place), 0)


def _tell(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
    """For each block that asks in one range of keys, the number of each of its keys in order; 0 if there is none."""
    told = _told(key, asked, known)
    common.give_back()
    return told


def _told(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
    own, number = key[0].as_py(), key[1].as_py()
    keys = [_walked(raw) for raw in known.column("key").to_pylist()]
    values = [_numbers(raw, KINDS[own]) for raw in known.column("value").to_pylist()]
    keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
    values = np.concatenate([*values, np.zeros(0, KINDS[own])])
    order = np.argsort(keys)
    keys, values = keys[order], np.append(values[order], KINDS[own](0))
    told = []
    for raw in asked.column("key").to_pylist():
        wanted = _walked(raw)
        place = np.searchsorted(keys, wanted)
        there = np.append(keys, np.uint64(0))[place] == wanted
        told.append(_planes(values[np.where(there & (place < len(keys)), place, len(keys))]))
    blocks = asked.column("block").to_pylist()
    return pa.table({
        "block": pa.array(blocks, pa.int32()), "kind": pa.array([own] * len(blocks), pa.int32()),
        "range": pa.array([number] * len(blocks), pa.int32()), "value": pa.array(told, pa.binary())})


def _joined_keys(rows: DataFrame) -> DataFrame:
    """Adds ``key``: that of the context with the symbol behind it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ctx, sym = (batch.column(c).to_numpy().view(np.uint64) for c in ("ctx", "sym"))
            key = (common.mixed(ctx) ^ sym).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "key"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("key", T.LongType())]))


def _gain() -> Column:
    """Nats that a candidate's own distribution saves over that of the shorter states."""
    rest = F.col("total") - F.col("held")
    apiece = F.col("n_ln_n") - F.col("held") * F.ln("total") - F.col("n_ln_q")
    others = rest * (F.ln(rest / F.col("total")) - F.ln(F.greatest(1 - F.col("q"), F.lit(1e-12))))
    return apiece + F.when(rest > 0, others).otherwise(0.0)


def fit(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> Model:
    """Learn from all rows of ``docs``."""
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession, "suffix-tree")
    docs, work = docs.select(F.col(f"`{text}`").alias("text")), f"{folder}/work"
    ranges = _ranges(_chars(docs), settings)

    def scan(depth: int, *sifts: common.Bits | None) -> DataFrame:
        found = saved(_scan(docs, depth, ranges, settings, *(sifts or (None, None))), f"{work}/counts-{depth}")
        common.release(spark)
        return found

    def likely(found: DataFrame) -> common.Bits:
        return common.Bits.of(found.where(F.col("kind") == LIKELY).select("key"))

    found = scan(0)
    counts = found.where(F.col("kind") == WORDS).select(F.col("key").alias("sym"), "n")
    tokens, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    rows = counts.select(F.col("sym").alias("key"), "n", F.lit(0.0).cast("float").alias("f"))
    before = counts.select("sym", ((F.col("n") + ADDED) / (tokens + ADDED * (words + 1))).alias("q"))
    frequent = counts.where((F.col("n") >= settings.least) & (F.col("sym") != END)).select(
        F.col("sym").alias("ctx"), F.col("n").alias("total"))
    all_states, all_pairs = [], []
    for depth in range(1, settings.depth + 1):
        found = scan(depth, common.Bits.of(frequent.select("ctx")), likely(found))
        nexts = found.where(F.col("kind") == NEXT).withColumnRenamed("key", "ctx")
        on = ["sym"] if depth == 1 else ["up", "sym"]
        known = saved(nexts.join(before, on).select("ctx", "sym", "n", "q"), f"{work}/known-{depth}")
        n = F.col("n").cast("double")
        candidates = known.groupBy("ctx").agg(
            F.sum("n").alias("held"), F.sum("q").alias("q"), F.sum(n * F.ln(n)).alias("n_ln_n"),
            F.sum(n * F.ln("q")).alias("n_ln_q"), F.count("*").alias("apiece")).join(frequent, "ctx")
        states = candidates.where(_gain() >= settings.nats * (F.col("apiece") + 1)).select(
            "ctx", "total", (1 - (F.col("held") - settings.discount * F.col("apiece")) / F.col("total")).alias("b"))
        states = saved(states, f"{work}/states-{depth}")
        pairs = known.join(states, "ctx", "left").withColumn("a", (F.col("n") - settings.discount) / F.col("total"))
        pairs = pairs.select("ctx", "sym", "n", F.coalesce(F.col("a") + F.col("b") * F.col("q"), "q").alias("q"), "a", "b")
        pairs = saved(_joined_keys(pairs), f"{work}/pairs-{depth}")
        all_states.append(states.select(F.col("ctx").bitwiseXOR(F.lit(int(STATE.view(np.int64)))).alias("key"), F.col("b").alias("f")))
        all_pairs.append(pairs.where("b is not null").select(
            F.col("key").bitwiseXOR(F.lit(int(PAIR.view(np.int64)))).alias("key"), F.col("a").alias("f")))
        before = pairs.select(F.col("ctx").alias("up"), "sym", "q")
        frequent = pairs.where((F.col("n") >= settings.least) & (F.col("sym") != END)).select(
            F.col("key").alias("ctx"), F.col("n").alias("total"))
    bits = []
    for tables in (all_states, all_pairs):
        joined = tables[0]
        for table in tables[1:]:
            joined = joined.unionByName(table)
        bits.append(common.Bits.of(joined.select("key")))
        # single precision is ample for a factor, and halves what the answers weigh
        rows = rows.unionByName(joined.select("key", F.lit(0).cast("long").alias("n"), F.col("f").cast("float").alias("f")))
    model = Model(saved(rows, f"{folder}/model"), tokens, words, ranges, *bits, settings)
    common.drop_folder(spark, work)
    common.release(spark)
    return model


def _chars(texts: DataFrame) -> int:
    return texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]


def _ranges(chars: int, settings: Settings) -> int:
    return 1 << max(4, (chars // settings.range_chars).bit_length())


def score(docs: DataFrame, model: Model, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every row."""
    settings, known, distinct = model.settings, model.tokens, model.words
    states, pairs = model.states, model.pairs
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    chars = _chars(rows)
    blocks, ranges = 1 + chars // settings.block_chars, max(model.ranges, _ranges(chars, settings))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")).repartition(blocks, "block")

    def questions(tokens: _Tokens) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for depth in range(1, settings.depth + 1):
            at = tokens.after(depth) - depth
            state = tokens.keys(depth)[at] ^ STATE
            has = states.has(state)
            pair = tokens.keys(depth + 1)[at[has]] ^ PAIR
            found += [state[has], pair[pairs.has(pair)]]
        return common.distinct(tokens.hashed.copy()), common.distinct(np.concatenate(found))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Asked] = defaultdict(_Asked)
        for batch in batches:
            own = batch.column("block").to_numpy()
            for block in np.unique(own).tolist():
                texts = batch.filter(pa.array(own == block))
                for _, some in common.parts(texts, "text"):
                    held[block].add(questions(_Tokens(some)))
        for block, wanted in held.items():
            for kind, keys in enumerate(wanted.all()):
                cut = list(_by_range(keys, ranges))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(cut), block, np.int32)), pa.array(np.full(len(cut), kind, np.int32)),
                    pa.array([r for r, _ in cut], pa.int32()), pa.array([_steps(keys[at]) for _, at in cut], pa.binary()),
                ], ["block", "kind", "range", "key"])

    asked = dealt.mapInArrow(common.lean(ask), "block int, kind int, range int, key binary")
    answers = asked.groupBy("kind", "range").cogroup(_packed_model(model.rows, ranges).groupBy("kind", "range")).applyInArrow(
        _tell, "block int, kind int, range int, value binary")
    schema = T.StructType().add("id", docs.schema[id_column].dataType)
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(name, kind)

    def answer(key: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        found = answered(texts, told)
        common.give_back()
        return found

    def answered(texts: pa.Table, told: pa.Table) -> pa.Table:
        parts, asked = [], _Asked()
        for batch in texts.to_batches():
            for part, some in common.parts(batch, "text"):
                tokens = _Tokens(some)
                asked.add(questions(tokens))
                tokens.forget()
                parts.append((part.column("id"), tokens))
        wanted = asked.all()
        told, held = told.sort_by("range"), []
        for kind, dtype in KINDS.items():
            raw = told.filter(pc.equal(told.column("kind"), kind)).column("value").to_pylist()
            numbers = np.concatenate([*(_numbers(r, dtype) for r in raw), np.zeros(0, dtype)])
            held.append(_Held(wanted[kind], numbers.astype(np.float64)))
        del asked, wanted

        found = []
        for ids, tokens in parts:
            count = held[WORD].of(tokens.hashed)
            base = (count + ADDED) / (known + ADDED * (distinct + 1))
            p = base.copy()
            for depth in range(1, settings.depth + 1):
                at = tokens.after(depth)
                back = held[FACTOR].of(tokens.keys(depth)[at - depth] ^ STATE)
                at, back = at[back > 0], back[back > 0]
                p[at] = back * p[at] + held[FACTOR].of(tokens.keys(depth + 1)[at - depth] ^ PAIR)
            tokens.forget()
            sums = [np.add.reduceat(x, tokens.starts) for x in ((count > 0).astype(np.int64), np.log10(base), np.log10(p))]
            found.append(pa.Table.from_arrays(
                [pa.chunked_array([ids]), *(pa.chunked_array([x]) for x in (tokens.sizes, *sums))],
                ["id", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(found)

    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answer, schema)
    return scored.withColumnRenamed("id", id_column)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text ends with 0; a row without an id does not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def op12_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")
