"""Phrase collocations by prefix-free parsing.

Texts are cut into pieces at punctuation, and pieces into overlapping chunks at content triggers: a window of
``words - 1`` words whose hash is divisible by ``modulus`` ends one chunk and begins the next.  Equal passages
are cut alike wherever they stand, so the chunks form a dictionary with the parse's frequencies, and copies cost
one row.  Phrases are counted inside the distinct chunks, weighted by frequency.  Neighbours share the window,
which is one word shorter than the longest phrase: every phrase lies whole in the chunk that its first word
stands in before the last window, and is counted there, once.

Counting goes by length.  A phrase can reach ``least`` only if both phrases one word shorter do.  32 bits of each
phrase's hash and its number are counted first, in packed arrays dealt by ranges whose number grows with the
dictionary; a bitmap of bounded size over the hashes that reach ``least`` then tells the tasks which phrases to
count by their texts.  So the counts are those of texts; with a full bitmap more of them are counted, and nothing
else changes.

Defined results: null texts hold no words; a null language is ``und``; repeated rows count each; ties in the
ranking go to the phrase that is first by its bytes; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import saved, scratch_folder
from . import common

UNKNOWN = "und"
_ENDS = np.zeros(256, bool)  # bytes that end a piece
_ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
_BETWEEN = _ENDS.copy()  # bytes outside of words
_BETWEEN[list(b" \t")] = True


@dataclass(frozen=True)
class Settings:
    words: int = 3  # of the longest phrase
    least: int = 10  # occurrences of a candidate
    modulus: int = 8  # one window in so many ends a chunk
    cover_percent: int = 50  # of a phrase's occurrences inside one longer candidate
    top: int = 2000  # of each language
    range_words: int = 1_000_000  # in chunks, for each range of hashes counted at once


def cut(texts: list[str | None], settings: Settings) -> Counter:
    """How often each (chunk, whether its piece ends with it) is in the texts."""
    raw = b"\n".join([t.encode("utf-8", "replace") for t in texts if t]) + b"\n"
    data = common.LOWER[np.frombuffer(raw, np.uint8)]
    inside = ~_BETWEEN[data]
    starts, ends, hashed = common.words_of(data, inside)
    if not len(starts):
        return Counter()
    piece = np.cumsum(_ENDS[data])[starts]
    edge = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(starts))
    inside[ends] = True  # with the byte behind each word, as the one space between them
    data[ends] = 32
    plain = data[inside].tobytes()
    overlap, window = settings.words - 1, hashed
    for size in range(2, overlap + 1):
        window = common.longer(window, hashed, size)
    at = np.flatnonzero((common.mixed(window) >> np.uint64(32)) % np.uint64(settings.modulus) == 0)
    piece = np.searchsorted(edge, at, "right") - 1
    at = at[(at > edge[piece]) & (at + overlap < edge[piece + 1])]  # inside its piece, and not at an end of it
    begins = np.concatenate((edge[:-1], at))
    order = np.argsort(begins, kind="stable")
    begins = begins[order]
    ends_piece = np.append(order[1:] < len(edge) - 1, True)
    until = np.append(begins[1:], len(starts)) + np.where(ends_piece, 0, overlap)
    place = np.append(0, np.cumsum(ends - starts + 1))
    chunks = zip(place[begins].tolist(), (place[until] - 1).tolist(), ends_piece.tolist())
    return Counter([(plain[a:b], closed) for a, b, closed in chunks])


def parse(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """The dictionary: (lang, chunk, closed: whether its piece ends with it, n: how often it is in the parse)."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in common.parts(batch, "text"):
                langs = part.column("lang").to_pylist()
                for name in dict.fromkeys(langs):
                    found = cut([t for t, own in zip(texts, langs, strict=True) if own == name], settings)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found), pa.string()), pa.array([c for c, _ in found], pa.binary()),
                         pa.array([e for _, e in found], pa.bool_()), pa.array(found.values(), pa.int64())],
                        ["lang", "chunk", "closed", "n"])

    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(chunks, "lang string, chunk binary, closed boolean, n long")
    return found.groupBy("lang", "chunk", "closed").agg(F.sum("n").alias("n"))


class _Places:
    """The words of some chunks of one language, with the phrases that begin at each."""

    def __init__(self, lang: str, chunks: list[bytes] | pa.BinaryArray, closed: np.ndarray, n: np.ndarray, overlap: int) -> None:
        if isinstance(chunks, list):
            chunks = pa.array(chunks, pa.binary())
        self.plain = pc.binary_join(pa.ListArray.from_arrays([0, len(chunks)], chunks), pa.scalar(b" ", chunks.type))[0].as_py()
        data = np.frombuffer(self.plain, np.uint8)
        self.starts, self.ends, hashed = common.words_of(data, data != 32)
        _, _, seed = common.words_of(name := np.frombuffer(lang.encode("utf-8", "replace") or b" ", np.uint8), np.ones(len(name), bool))
        self.hashed = common.mixed(hashed ^ seed)
        until = np.searchsorted(self.starts, np.cumsum(pc.binary_length(chunks).to_numpy().astype(np.int64) + 1))
        sizes = np.diff(until, prepend=0)
        self.left = np.repeat(until, sizes) - np.arange(len(self.starts))  # words from here to the chunk's end
        self.begins = self.left > np.repeat(np.where(closed, 0, overlap), sizes)
        self.n = np.repeat(n, sizes)
        self._keys = [self.hashed]

    def keys(self, size: int) -> np.ndarray:
        while len(self._keys) < size:
            self._keys.append(common.longer(self._keys[-1], self.hashed, len(self._keys) + 1))
        return self._keys[size - 1]

    def at(self, size: int) -> np.ndarray:
        """Places at which a phrase of ``size`` words begins that is counted in its chunk."""
        return np.flatnonzero(self.begins & (self.left >= size))

    def texts(self, at: np.ndarray, size: int) -> list[str]:
        return [self.plain[a:b].decode() for a, b in zip(self.starts[at].tolist(), self.ends[at + size - 1].tolist())]

    def sum(self, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of some places, the first place of each, and their weights."""
        distinct, total, first = common.summed(keys[at], self.n[at])
        return distinct, at[first], total


def _each(batches: Iterator[pa.RecordBatch], settings: Settings, count) -> Iterator[pa.RecordBatch]:
    """What ``count(lang, places)`` gives for the chunks of one language at a time; no object per chunk."""
    for part in common.gathered(batches, "chunk"):
        langs = part.column("lang").dictionary_encode()
        codes, chunks = langs.indices.to_numpy(), part.column("chunk")
        closed, n = part.column("closed").to_numpy(False), part.column("n").to_numpy()
        for code, name in enumerate(langs.dictionary.to_pylist()):
            own = np.flatnonzero(codes == code)
            yield from count(name, _Places(name, chunks.take(pa.array(own)), closed[own], n[own], settings.words - 1))


def _text_counts(dictionary: DataFrame, settings: Settings, sifts: dict[int, common.Bits]) -> DataFrame:
    """(lang, phrase, size, a) of the phrases that pass the sift of their size and occur ``least`` times."""
    def count(name: str, places: _Places) -> Iterator[pa.RecordBatch]:
        for size, bits in sifts.items():
            keys, at = places.keys(size), places.at(size)
            _, first, total = places.sum(keys, at[bits.has(keys[at])])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(first), pa.string()), pa.array(places.texts(first, size), pa.string()),
                 pa.array(np.full(len(first), size, np.int32)), pa.array(total)], ["lang", "phrase", "size", "a"])

    found = dictionary.mapInArrow(lambda batches: _each(batches, settings, count), "lang string, phrase string, size int, a long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a")).where(F.col("a") >= settings.least)


def _likely(dictionary: DataFrame, settings: Settings, sizes: tuple[int, ...], shorter: common.Bits | None, ranges: int) -> DataFrame:
    """(size, key): low bits of the hashes of phrases that may occur ``least`` times, of some sizes."""
    shift = np.uint64(ranges.bit_length() - 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {size: common.Tally() for size in sizes}

        def pack(size: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            own, found = common.packed(ranges, keys, key=(keys >> shift).astype(np.uint32), n=n)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), size, np.int32)), pa.array(own), pa.array(found["key"], pa.binary()),
                 pa.array(found["n"], pa.binary())], ["size", "range", "key", "n"])

        def count(name: str, places: _Places) -> Iterator[pa.RecordBatch]:
            for size in sizes:
                at = places.at(size)
                if shorter:
                    likely = shorter.has(places.keys(size - 1))
                    at = at[likely[at] & likely[at + 1]]
                keys, _, total = places.sum(places.keys(size), at)
                for merged in tallies[size].add(keys, total):
                    yield pack(size, *merged)

        yield from _each(batches, settings, count)
        for size, tally in tallies.items():
            for merged in tally.rest():
                yield pack(size, *merged)

    def reduce(key: tuple, rows: pa.Table) -> pa.Table:
        keys, total, _ = common.summed(common.unpacked(rows, "key", np.uint32), common.unpacked(rows, "n", np.int64))
        whole = keys[total >= settings.least].astype(np.uint64) << shift | np.uint64(key[1].as_py())
        return pa.table({"size": np.full(len(whole), key[0].as_py(), np.int32), "key": whole.view(np.int64)})

    found = dictionary.mapInArrow(scan, "size int, range int, key binary, n binary")
    return found.groupBy("size", "range").applyInArrow(reduce, "size int, key long")


def score(candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """Adds l, r, k and score of the lowest-scoring cut; ``parts`` has f of every (lang, phrase) that may be a part."""
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumn("w", words)
    cuts = cuts.withColumn("left", F.array_join(F.slice("w", 1, F.col("k")), " "))
    cuts = cuts.withColumn("right", F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ")).drop("w")
    for side, f in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f)), ["lang", side])
    whole = "decimal(15,0)"  # a * a * 1000000 and l * r fit 38 digits
    ratio = F.expr(f"cast((1000000 * cast(a as {whole}) * cast(a as {whole})) div (cast(l as {whole}) * cast(r as {whole})) as long)")
    lowest = F.min(F.struct(ratio.alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "size", "a").agg(lowest.alias("c")).select("lang", "phrase", "size", "a", "c.*")


def covered(candidates: DataFrame, settings: Settings) -> DataFrame:
    """(lang, phrase, longest) of the phrases inside longer candidates, with the highest frequency of those."""
    w = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda s: F.transform(
        F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: F.array_join(F.slice(w, i, s), " "))))
    return candidates.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")).groupBy(
        "lang", "phrase").agg(F.max("longer").alias("longer"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first ``top`` phrases of each language."""
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession, "collocations")
    dictionary = saved(parse(docs, text, lang, settings), f"{folder}/dictionary")
    common.release(spark)
    plain = F.col("chunk").cast("string")
    size_of = F.length(plain) - F.length(F.translate(plain, " ", "")) + 1
    counted = size_of - F.when(F.col("closed"), 0).otherwise(settings.words - 1)
    totals = saved(dictionary.groupBy(F.col("lang").alias("of")).agg(
        F.sum(F.col("n") * counted).alias("n"), F.sum(size_of).alias("words")), f"{folder}/totals")
    total = totals.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    ranges = 1 << max(4, (total // settings.range_words).bit_length())
    bits: dict[int, common.Bits] = {}
    for sizes in ((1, 2), *((size,) for size in range(3, settings.words + 1))):
        keys = saved(_likely(dictionary, settings, sizes, bits.get(sizes[0] - 1), ranges), f"{folder}/keys-{sizes[0]}")
        bits |= {size: common.Bits.of(keys.where(F.col("size") == size).select("key")) for size in sizes}
        common.release(spark)
    phrases = saved(_text_counts(dictionary, settings, bits), f"{folder}/phrases")
    common.release(spark)
    candidates = phrases.where("size > 1")
    parts = phrases.where(F.col("size") < settings.words).select("lang", "phrase", F.col("a").alias("f"))
    found = score(candidates, parts).join(covered(candidates, settings), ["lang", "phrase"], "left")
    found = found.where(F.col("longer").isNull() | (100 * F.col("longer") < settings.cover_percent * F.col("a")))
    ranked = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= settings.top)
    found = found.join(totals.drop("words"), F.col("lang") == F.col("of"))
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, s.size AS size, array_to_string(ws[i.i:i.i + s.size - 1], ' ') AS phrase
  FROM ws, (VALUES (1), (2), (3)) AS s(size), unnest(range(1, len(ws) - s.size + 2)) AS i(i)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
  UNION ALL SELECT lang, phrase, a, 2, array_to_string(w[1:2], ' '), w[3] FROM c WHERE size = 3),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, fx.f AS l, fy.f AS r,
    ((1000000::HUGEINT * a * a) // (fx.f::HUGEINT * fy.f))::BIGINT AS score
  FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.phrase = x JOIN f fy ON fy.lang = cuts.lang AND fy.phrase = y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE size = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE size = 3) GROUP BY ALL),
stay AS (
  SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM stay)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
