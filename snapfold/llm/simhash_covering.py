"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit of a fingerprint is given a non-zero vector of ``radius + 1`` bits.  Each of the
``2 ** (radius + 1) - 1`` non-zero vectors v makes one table, whose mask holds the fingerprint bits
with an odd product with v.  The vectors of at most ``radius`` differing bits span a space that some v
is orthogonal to, and in that table the masked fingerprints are equal: no pair within the radius is
missed.  Buckets are read in sorted order inside tasks that compare whole arrays; a bucket gives
links that keep its members connected, never all its pairs.  A bucket above ``tile`` members is dealt
out over pairs of blocks, so that a task holds two blocks at most and every pair still meets.

Defined results: null, empty and blank texts have fingerprint zero, which links like any other;
texts are read whole; equal rows have equal fingerprints, hence one component; an empty table gives no
rows; extra columns are not read.  A null id is never a component's name, unless no member has an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from ..session import saved, scratch_folder
from . import common
from .components import connected

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 2048
SMALL = 32
BITS = 64


def shingle_hashes(text: str | None, words: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of the text in lower case (A-Z only), repeats included."""
    parts = text.encode("utf-8", "replace").lower().split() if text else []  # bytes: A-Z only
    if not parts:
        return []
    if len(parts) < words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    joined = b" ".join(parts)
    ends = list(accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends[: -words]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[words - 1:], strict=True)]


def majorities(hashes: list[list[int]]) -> np.ndarray:
    """Per list, the bits set in over half of its hashes; zero for an empty list."""
    out = np.zeros(len(hashes), np.uint64)
    sizes = np.array([len(h) for h in hashes], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat = np.concatenate([np.array(hashes[i], np.uint64) for i in full])
    sizes = sizes[full]
    starts = np.cumsum(sizes) - sizes
    runs = -(-sizes // 255)  # sums over 255 hashes at most fit a byte lane
    first_run = np.cumsum(runs) - runs
    inside = np.arange(runs.sum()) - np.repeat(first_run, runs)
    run_starts = np.repeat(starts, runs) + 255 * inside
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = np.add.reduceat((flat >> np.uint64(bit)) & lanes, run_starts)
        counts = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        for byte in range(8):
            set_ = (2 * counts[:, byte] > sizes).astype(np.uint64)
            out[full] |= set_ << np.uint64(8 * byte + bit)
    return out


def fingerprint(text: Column, words: int = SHINGLE) -> Column:
    """The 64-bit fingerprint as a (signed) long."""

    @pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts, found = list(texts), []
            for a, b in common.slices(texts, common.FEW_CHARS):
                found.append(majorities([shingle_hashes(t, words) for t in texts[a:b]]).view(np.int64))
            common.give_back()
            yield pd.Series(np.concatenate(found) if found else np.zeros(0, np.int64))

    return of(text)


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks as signed longs, one per non-zero vector of ``radius + 1`` bits."""
    top = (1 << radius + 1) - 1
    vectors = [1 + bit % top for bit in range(BITS)]
    out = []
    for v in range(1, top + 1):
        mask = sum(1 << bit for bit, w in enumerate(vectors) if (v & w).bit_count() % 2)
        out.append(mask - (1 << BITS) if mask >> BITS - 1 else mask)
    return out


def _near(a: np.ndarray, b: np.ndarray | np.uint64, radius: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= radius


def bucket_links(groups: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """Links (two columns) that connect what is within the radius inside each run of equal groups."""
    edges = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    sizes = np.diff(np.append(edges, len(groups)))
    found = []
    small = np.repeat(np.where(sizes <= SMALL, sizes, 0), sizes)
    place = np.arange(len(groups)) - np.repeat(edges, sizes)
    for step in range(1, min(SMALL, int(small.max(initial=1)))):
        at = np.flatnonzero(place + step < small)
        at = at[_near(prints[at], prints[at + step], radius)]
        found.append(np.stack((prints[at], prints[at + step]), axis=1))
    for at in np.flatnonzero(sizes > SMALL):
        found += _forest(prints[edges[at]: edges[at] + sizes[at]], radius)
    links = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    return np.unique(links, axis=0)


def _forest(members: np.ndarray, radius: int) -> list[np.ndarray]:
    """Breadth first: each member is compared with those not yet reached, and links them once."""
    left, out = np.unique(members), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = _near(left, node, radius)
            if near.any():
                reached = left[near]
                out.append(np.stack((np.full(len(reached), node), reached), axis=1))
                queue.extend(reached)
                left = left[~near]
    return out


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all pairs within the radius."""
    spark = prints.sparkSession
    rows = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for t, m in enumerate(masks(radius))])
    keys = prints.select("fp", F.inline(rows))
    large = keys.groupBy("t", "key").count().where(F.col("count") > tile)
    large = saved(large.select("t", "key", F.ceil(F.col("count") / tile).cast("int").alias("blocks")),
                  scratch_folder(spark, "simhash-large"))
    dealt = keys.join(large, ["t", "key"], "left")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    dealt = dealt.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    bucket = F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(bucket.alias("bucket"), "fp").repartition("bucket").sortWithinPartitions("bucket")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.uint64))

        def out(groups: np.ndarray, members: np.ndarray) -> pa.RecordBatch:
            got = bucket_links(groups, members, radius).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["a", "b"])

        for batch in batches:  # a bucket may run over batches: its part waits for the next
            groups = np.concatenate((held[0], batch.column(0).to_numpy()))
            members = np.concatenate((held[1], batch.column(1).to_numpy().view(np.uint64)))
            if not len(groups):
                continue
            cut = int(np.searchsorted(groups, groups[-1]))
            held = (groups[cut:], members[cut:])
            if cut:
                yield out(groups[:cut], members[:cut])
        if len(held[0]):
            yield out(*held)

    return dealt.mapInArrow(find, "a long, b long").distinct()


def _grouped(docs: DataFrame, text: str, id_column: str, words: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(id, fp, component_id, root: a print that names the component) of every row."""
    folder = scratch_folder(docs.sparkSession, "simhash")
    rows = saved(docs.select(F.col(id_column).alias("id"), fingerprint(F.col(text), words).alias("fp")), f"{folder}/rows")
    prints = saved(rows.groupBy("fp").agg(F.min("id").alias("id")), f"{folder}/prints")
    roots = connected(links(prints.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
    named = prints.join(roots, "fp", "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    named = saved(named, f"{folder}/named")
    first = saved(named.groupBy("root").agg(F.min("id").alias("component_id")), f"{folder}/first")
    of_print = saved(named.join(first, "root").select("fp", "component_id", "root"), f"{folder}/components")
    return rows.join(of_print, "fp")


def group(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
          words: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Id, fingerprint (hex) and component_id of every row."""
    return _grouped(docs, text, id_column, words, radius, tile).select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per component, that of the least id, with all columns.

    Rows are judged by id and fingerprint, so different texts under one id each speak for their component.  Of a
    component's rows that share the least id one stays; rows without an id cannot be named and all stay.
    """
    folder = scratch_folder(docs.sparkSession, "simhash-special")
    named = _grouped(docs, text, id_column).where("id is not null").groupBy("id", "fp", "root").agg(
        F.first(F.col("id") == F.col("component_id")).alias("__stays"), F.count("*").alias("rows"))
    named = saved(named, f"{folder}/named")
    # only ids that go, or stand on several rows, need their rows looked at; the others are not shuffled
    special = named.groupBy("id").agg(F.min("__stays").alias("stays"), F.sum("rows").alias("rows"))
    special = saved(special.where("not stays or rows > 1").select(F.xxhash64("id").alias("__hash")), f"{folder}/special")
    # the other columns travel in one, so that none of them can have the name of a column made here
    others = [c for c in docs.columns if c not in (text, id_column)]
    packed = docs.select(F.col(f"`{id_column}`").alias("__own"), F.col(f"`{text}`").alias("__text"),
                         (F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)).alias("__others"))
    rows = common.flag(packed.withColumn("__hash", F.xxhash64("__own")), special, "__hash", "__special").drop("__hash")
    rows = rows.withColumn("__special", F.col("__special") & F.col("__own").isNotNull())
    verdicts = named.select(F.col("id").alias("__id"), F.col("fp").alias("__print"), F.col("root").alias("__root"), "__stays")
    # null-safe, as no fingerprint is null: else Spark tests that of every row for null, in a second Python task beside the first
    looked_at = rows.where("__special").withColumn("__fp", fingerprint(F.col("__text"))).join(
        common.likely(verdicts.withColumn("__hash", F.xxhash64("__id")), special, "__hash").drop("__hash"),
        (F.col("__own") == F.col("__id")) & F.col("__fp").eqNullSafe(F.col("__print")))
    stay = looked_at.where("__stays").dropDuplicates(["__own", "__root"]).select("__own", "__text", "__others", "__special")
    found = rows.where("not __special").unionByName(stay)
    own = {text: F.col("__text"), id_column: F.col("__own")}
    return found.select(*[(own[c] if c in own else F.col("__others").getField(c)).alias(c) for c in docs.columns])


def op4_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(common.table(spark, sf_dir, "documents"))
