"""Benchmark decontamination by spaced-seed hashing.

A seed is a window of ``span`` words under a mask that ignores some of its positions; two windows with
equal words at the others collide, whatever was substituted at the ignored ones.  Several fixed masks are
used, so that one or two changed words anywhere leave a mask that does not look at them.  The hashes of
all windows of the benchmark are joined with those of every training window; each hit fixes an
alignment (a diagonal), on which the words around it are compared one by one.  A document is
contaminated by an item if some stretch of the diagonal has at least ``least_words`` words (or the whole
item, if it is shorter) of which at least ``similarity`` agree.

The benchmark goes to the tasks in blocks of at most ``block_words`` words, one pass over the corpus
for each block, so what is broadcast is bounded however large the benchmark grows.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case and ASCII punctuation cut off both ends.

Defined results: null, empty and blank texts match nothing, nor do items of fewer words than
the shortest mask looks at; texts and items are read whole; repeated documents each get their rows; repeated items
are matched under each id; an empty table on either side gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from . import common

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    #: 1: the position is looked at.  Wherever a fifth of 13 to 26 words was substituted, one of these
    #: masks has a place where it looks at none of them; a test tries every case.
    masks: tuple[str, ...] = ("11111", "1100111", "11010011", "110101001")
    similarity: float = 0.8
    least_words: int = 13
    block_words: int = 500_000


def tokens(text: str | None) -> list[bytes]:
    if not text:
        return []
    words = [w.strip(PUNCTUATION) for w in text.encode("utf-8", "replace").lower().split()]
    return [w for w in words if w]


def seed_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """A hash per window, of the ids at the positions that the mask looks at."""
    count = len(ids) - len(mask) + 1
    out = np.zeros(max(0, count), np.uint64)
    if count > 0:
        for at, look in enumerate(mask):
            if look == "1":
                out = (out ^ ids[at:at + count]) * MULTIPLIER
                out ^= out >> np.uint64(29)
    return out


class Benchmark:
    """One block of items, with the hashes of their windows under every mask."""

    def __init__(self, items: list[tuple[int, list[bytes]]], settings: Settings) -> None:
        self.settings, self.ids = settings, {}
        self.items = [(item, np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words], np.uint64))
                      for item, words in items]
        self.tables = []
        for mask in settings.masks:
            hashes = [seed_hashes(words, mask) for _, words in self.items]
            sizes = np.array([len(h) for h in hashes], np.int64)
            item = np.repeat(np.arange(len(hashes)), sizes)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            order = np.argsort(flat, kind="stable")
            filter_ = np.zeros(1 << 22, bool)
            filter_[flat >> np.uint64(42)] = True
            self.tables.append((mask, flat[order], item[order], place[order], np.packbits(filter_, bitorder="little")))

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word in the text, words, agreeing words): the longest stretch of each pair."""
        get = self.ids.get
        each = [[get(w, 0) for w in tokens(t)] for t in texts]
        sizes = np.array([len(e) for e in each], np.int64)
        starts = np.cumsum(sizes) - sizes
        flat = np.array([i for e in each for i in e], np.uint64)
        owner = np.repeat(np.arange(len(each)), sizes)
        diagonals = []
        for mask, hashes, item, place, filter_ in self.tables:
            got = seed_hashes(flat, mask)
            looked = [k for k, c in enumerate(mask) if c == "1"]
            slot = got >> np.uint64(42)
            at = np.flatnonzero(filter_[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
            at = at[owner[at] == owner[at + len(mask) - 1]] if len(at) else at  # within one text
            for k in looked:  # no word that the benchmark lacks
                at = at[flat[at + k] != 0]
            left, right = (np.searchsorted(hashes, got[at], side) for side in ("left", "right"))
            times = right - left
            at = np.repeat(at, times)
            hit = np.repeat(left, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            diagonals.append(np.stack((owner[at], item[hit], at - place[hit]), axis=1))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for text, item, shift in np.unique(np.concatenate(diagonals), axis=0) if diagonals else ():
            words = self.items[item][1]
            a = max(int(shift), int(starts[text]))
            b = min(int(shift) + len(words), int(starts[text] + sizes[text]))
            found = self._stretch(flat[a:b] == words[a - shift:b - shift], len(words))
            if found and found[1] > best.get((text, item), (0, 0, 0))[1]:
                best[text, item] = (a - int(starts[text]) + found[0], *found[1:])
        return [(int(t), int(self.items[i][0]), *found) for (t, i), found in best.items()]

    def _stretch(self, agrees: np.ndarray, whole: int) -> tuple[int, int, int] | None:
        """The longest stretch of enough words with enough agreement: (start, words, agreeing)."""
        need = min(self.settings.least_words, whole)
        n = len(agrees)
        if n < need:
            return None
        sums = np.concatenate(([0.0], np.cumsum(agrees - self.settings.similarity)))
        # the longest i < j with sums[i] <= sums[j], by the least sum so far and the greatest yet to come
        low = np.minimum.accumulate(sums)
        high = np.maximum.accumulate(sums[::-1])[::-1] + 1e-9
        top, i, j = (0, 0, 0), 0, 0
        while j <= n:
            if low[i] <= high[j]:
                top = max(top, (j - i, i, j))
                j += 1
            else:
                i += 1
        words, i, j = top
        if words < need:
            return None
        return i, words, int(agrees[i:j].sum())


NO_ID = -(1 << 63)  # stands for the id of an item that has none

FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "item_id", "first_word", "n_words", "n_equal")])


def blocks(benchmark: DataFrame, settings: Settings, text: str, id_column: str) -> Iterator[Benchmark]:
    """The benchmark in bounded blocks, read one row at a time."""
    held: list[tuple[int, list[bytes]]] = []
    size = 0
    for row in benchmark.select(F.col(id_column).cast("long"), text).toLocalIterator():
        words = tokens(row[1])
        if not words:
            continue
        if held and size + len(words) > settings.block_words:
            yield Benchmark(held, settings)
            held, size = [], 0
        held.append((NO_ID if row[0] is None else row[0], words))
        size += len(words)
    if held:
        yield Benchmark(held, settings)


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id",
             item_text: str = "text", item_id: str = "item_id", settings: Settings = Settings()) -> DataFrame:
    """One row for each pair of document and item that overlap: where, how many words, how many equal."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], FOUND)
    for block in blocks(benchmark, settings, item_text, item_id):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in common.parts(batch, "text"):
                    ids = part.column(0)
                    hits = [(ids[t].as_py(), *rest) for t, *rest in sent.value.search(texts)]
                    hits = [(doc, None if item == NO_ID else item, *rest) for doc, item, *rest in hits]
                    columns = list(zip(*hits, strict=True)) or [()] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], FOUND.names)

        found = found.unionAll(rows.mapInArrow(search, FOUND))
    return found.withColumnRenamed("doc_id", id_column) if id_column != "doc_id" else found


def keep_clean(text_rows: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``text_rows`` (doc_id, text and others) without an overlap, with all their columns.

    The decision is made beside the row, so rows need no id and are not joined.
    """
    kept = text_rows
    for block in blocks(benchmark, settings, "text", "item_id"):
        sent = text_rows.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in common.parts(batch, "text", common.FEW_CHARS):
                    hit = {t for t, *_ in sent.value.search(texts)}
                    yield part.filter(pa.array([i not in hit for i in range(len(texts))], pa.bool_()))
                common.give_back()

        kept = kept.mapInArrow(clean, kept.schema)
    return kept


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
