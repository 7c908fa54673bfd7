"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Characters that one step inside a Python task holds at once, whatever a batch brings.
CHARS_AT_ONCE = 2_000_000
FEW_CHARS = 500_000  # where each character costs many bytes

#: Bytes of rows that Spark hands to a Python task at once; its own limit is 64 MB, held several times over by each core.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"

BITMAP = 32768  # bits in one bitmap of Spark's own
MOST_BITMAPS = 2048  # 8 MB: the bound of what flag() broadcasts

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_UNDONE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))  # times the prime: 1
_BYTES = np.random.default_rng(42).integers(0, 1 << 64, 256, np.uint64)  # a value of each byte

STEP = 1 << 16  # bytes that are hashed at once, one word at least

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: its cleaner follows the driver's garbage collector."""
    gc.collect()
    spark._jvm.System.gc()


def give_back() -> None:
    """Hand freed memory back to the system: a Python worker outlives its task, and several wait on an executor."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A step over batches that gives its memory back when it ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of this run that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Let the session's Python tasks get their rows in batches of bounded bytes; a limit that the session has set holds."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` knows just these six separators."""
    return text.encode("utf-8", "replace").split() if text else []


def mixed(keys: np.ndarray) -> np.ndarray:
    """Well-spread bits of 64-bit keys, one to one."""
    return (keys ^ (keys >> np.uint64(29))) * _PRIME


def longer(keys: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """Keys of the sequences of ``size`` words, from those one word shorter that begin at the same place."""
    last = words[size - 1:]
    return mixed(keys[:len(last)]) ^ last


def words_of(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and 64-bit hash of each run of bytes that are ``inside`` a word; no object per word."""
    edges = np.ones(len(inside) + 1, bool)
    if len(inside):
        edges[0], edges[-1] = inside[0], inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=edges[1:-1])
    else:
        edges[0] = False
    turns = np.flatnonzero(edges)
    starts, ends = turns[::2], turns[1::2]
    hashed = np.empty(len(starts), np.uint64)
    powers = undone = np.zeros(0, np.uint64)
    a = 0
    while a < len(starts):  # eight bytes for each of the data are held for one step only
        low = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, low + STEP, "right")))
        size = int(ends[b - 1]) - low
        if size > len(powers):
            powers, undone = (np.multiply.accumulate(np.full(max(size, STEP), p)) for p in (_PRIME, _UNDONE))
        # a byte's power is that of its place in the step; what lies before the word is undone again
        values = np.take(_BYTES, data[low:low + size])
        values *= powers[:size]
        sums = np.add.reduceat(values, turns[2 * a:2 * b - 1] - low)[::2]
        hashed[a:b] = sums * undone[starts[a:b] - low] * _PRIME
        a = b
    return starts, ends, mixed(hashed)


def distinct(keys: np.ndarray) -> np.ndarray:
    """The keys, each once, sorted.  The array given is sorted in place."""
    keys.sort()
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted, the sum of the numbers of each, and where it stands first."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    total = np.add.reduceat(n[order], edges, dtype=np.int64) if len(edges) else np.zeros(0, np.int64)
    return keys[edges], total, order[edges]


def packed(ranges: int, at: np.ndarray, **columns: np.ndarray) -> tuple[np.ndarray, dict[str, list[bytes]]]:
    """The ranges (a power of two) that hashes fall in, and for each the entries of every column as bytes."""
    own = (at & np.uint64(ranges - 1)).astype(np.int32)
    order = np.argsort(own, kind="stable")
    own = own[order]
    edges = np.flatnonzero(np.diff(own, prepend=-1))
    ends = np.append(edges[1:], len(own))
    return own[edges], {name: [c[a:b].tobytes() for a, b in zip(edges, ends)]
                        for name, c in ((name, c[order]) for name, c in columns.items())}


class Tally:
    """Keys that a task counts, merged, and handed out once there are many; columns come with a key's first row."""

    LIMIT = 1_000_000

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, keys: np.ndarray, n: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        if len(keys):
            self.held.append((keys, n.astype(np.int64), *columns))
            self.size += len(keys)
        if self.size > self.LIMIT:
            self._merge()
            if self.size > self.LIMIT // 2:
                yield from self.rest()

    def _merge(self) -> None:
        held, self.held = [list(c) for c in zip(*self.held)], []
        n, keys = np.concatenate(held.pop(1)), np.concatenate(held.pop(0))
        keys, n, first = summed(keys, n)
        merged = []
        while held:  # one column at a time, so that the rows are not all there twice
            merged.append(np.concatenate(held.pop(0))[first])
        self.held, self.size = [(keys, n, *merged)], len(keys)

    def rest(self) -> Iterator[tuple[np.ndarray, ...]]:
        """What is held: keys, counts, columns."""
        if self.held:
            self._merge()
            yield self.held[0]
        self.held, self.size = [], 0


def gathered(batches: Iterator[pa.RecordBatch], column: str, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches put together to about ``size`` bytes of a text column each."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if total >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def unpacked(rows: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)


def slices(texts: Sequence[str | None], budget: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``budget`` characters each, one text at least."""
    start, held = 0, 0
    for at, text in enumerate(texts):
        size = len(text) if text else 0
        if at > start and held + size > budget:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def parts(batch: pa.RecordBatch, text: str, budget: int = CHARS_AT_ONCE) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """A batch in parts of about ``budget`` bytes of text, with the texts of each."""
    column = batch.column(text)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > budget:
            yield batch.slice(start, at - start), column.slice(start, at - start).to_pylist()
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start), column.slice(start).to_pylist()


def flag(rows: DataFrame, wanted: DataFrame, hashed: str, name: str) -> DataFrame:
    """``rows`` with a boolean: False where the hash is surely not in ``wanted``, else mostly in it.

    One bit per hash in bitmaps of bounded size, sent to all tasks, so that what surely does not meet
    ``wanted`` need not be shuffled to it.  Both sides have the column ``hashed`` (long).  With more hashes
    than the bound has room for, more rows pass, and nothing else changes.
    """
    count, bitmaps = wanted.count(), 1
    while bitmaps * BITMAP < 64 * count and bitmaps < MOST_BITMAPS:
        bitmaps *= 2
    bucket = F.pmod(F.shiftright(hashed, 15), F.lit(bitmaps))
    word, bit = F.pmod(F.shiftright(hashed, 6), F.lit(BITMAP // 64)).cast("int"), F.col(hashed).bitwiseAND(F.lit(63)).cast("int")
    words = wanted.select(bucket.alias("__bucket"), word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    words = words.groupBy("__bucket", "word").agg(F.bit_or("bit").alias("bits"))
    held = words.groupBy("__bucket").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    marks = held.select("__bucket", F.transform(
        F.sequence(F.lit(0), F.lit(BITMAP // 64 - 1)),
        lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long"))).alias("__marks"))
    found = rows.withColumn("__bucket", bucket).join(F.broadcast(marks), "__bucket", "left")
    is_set = F.call_function("shiftright", F.get("__marks", word), bit).bitwiseAND(F.lit(1)) == 1
    return found.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("__bucket", "__marks")


def likely(rows: DataFrame, wanted: DataFrame, hashed: str) -> DataFrame:
    """``rows`` without those that are surely not in ``wanted``."""
    return flag(rows, wanted, hashed, "__likely").where("__likely").drop("__likely")


class Bits:
    """A bitmap over 64-bit hashes: what it does not hold was surely not put in.

    Each hash has two bits, so that a bitmap that is filled to a part lets the square of that part pass.  At most ``MOST_BITMAPS`` bitmaps, so 8 MB; with more hashes than that has room for, more pass.
    """

    APART = 13  # bits between the two places that are read off a hash

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks  # a power of two of bytes

    @classmethod
    def of(cls, keys: DataFrame) -> Bits:
        """The bitmap of the only column (long) of ``keys``, built by tasks."""
        name, count, bitmaps = keys.columns[0], keys.count(), 1
        while bitmaps * BITMAP < 64 * count and bitmaps < MOST_BITMAPS:
            bitmaps *= 2
        both = F.array(F.col(name), F.col(name).bitwiseXOR(F.shiftrightunsigned(name, cls.APART)))
        places = keys.select(F.explode(both).alias("place"))
        bucket = F.shiftrightunsigned("place", 15).bitwiseAND(F.lit(bitmaps - 1))
        rows = places.groupBy(bucket.alias("bucket")).agg(
            F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(BITMAP - 1))).alias("marks")).collect()
        marks = np.zeros((bitmaps, BITMAP // 8), np.uint8)
        for row in rows:
            marks[row.bucket, :len(row.marks)] = np.frombuffer(row.marks, np.uint8)
        return cls(marks.reshape(-1))

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key (uint64) may be in."""
        found = self._marked(keys)
        at = np.flatnonzero(found)
        likely = keys[at]
        found[at] = self._marked(likely ^ (likely >> np.uint64(self.APART)))
        return found

    def _marked(self, keys: np.ndarray) -> np.ndarray:
        place = (keys & np.uint64(8 * len(self.marks) - 1)).view(np.int64)
        return (np.take(self.marks, place >> 3) >> (place & 7).astype(np.uint8) & 1).view(bool)
