"""Periodic runs of words by online dyadic square catching.

Words are appended one by one.  Every completed block of ``2 ** k`` words (at a multiple of ``2 ** k``) gets a
name from the names of its halves and becomes a catcher for the periods ``2 ** (k + 1) - 1`` to
``2 ** (k + 2) - 2``: the first half of any square with such a period p holds a whole block, which stands again
p words later.  An appended word extends the named suffixes, level by level, and stops at the first suffix that
equals no block, so most words cost one look-up.  At each level just two catchers can meet a suffix.  One that
does opens a stretch of its period, extended to the left at once and by each appended word from then on; a word
that differs closes it.  A stretch of at least two periods is a square whose later copies merged into one run.

A stretch lies inside an open one whose period divides its own, or is no longer than the block, only if its own
period is not the least one; it is not opened then.  So what is closed is a run with its least period.

Defined results: a null or empty text has no runs and collapses to the empty text; texts are read whole; equal
rows give equal results; null ids are kept; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import common

LEAST_WORDS = 12
SEPARATORS = r"[\x20\x09-\x0D]+"


class Catchers:
    """Runs of one sequence of hashable words, which may arrive in any number of pieces."""

    def __init__(self) -> None:
        self.text: list = []
        self.blocks: list[list[int]] = [[]]  # by level: names of the completed blocks
        self.names: list[dict] = [{}]  # by level: names of (left half, right half)
        self.suffixes: list[dict[int, int]] = [{}]  # by level: last word -> name, where it equals a block
        self.open: dict[int, int] = {}  # period -> first word of the stretch that the last word is in
        self.runs: list[tuple[int, int, int]] = []  # closed ones: start, length, period

    def extend(self, words: Iterable) -> Catchers:
        text, blocks, names, suffixes, stretches = self.text, self.blocks, self.names, self.suffixes, self.open
        for word in words:
            at = len(text)
            text.append(word)
            if stretches:
                for period in [p for p in stretches if text[at - p] != word]:
                    self._close(period, at)
            if at and text[at - 1] == word and 1 not in stretches:
                self._catch(1, at, 1)
            if at > 1 and text[at - 2] == word and 2 not in stretches:
                self._catch(2, at, 1)
            level, size, left, right = 1, 2, text[at - 1] if at else None, word
            while left is not None and level < len(names):
                right = names[level].get((left, right))
                if right is None:
                    break
                suffixes[level][at] = right
                block = (at + 2) // size - 3  # the last one whose copy may end here
                for catcher in (block, block - 1):
                    if catcher >= 0 and blocks[level][catcher] == right:
                        period = at + 1 - (catcher + 1) * size
                        if period not in stretches:
                            self._catch(period, at, size)
                left = suffixes[level].get(at - size)
                level, size = level + 1, 2 * size
            if at & 1:
                self._complete(at + 1)
        return self

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs by start, then period; nothing can be appended after."""
        for period in list(self.open):
            self._close(period, len(self.text))
        return sorted(self.runs, key=lambda run: (run[0], run[2]))

    def _complete(self, length: int) -> None:
        """Name the blocks that end with the last word."""
        left, right, level = self.text[-2], self.text[-1], 1
        while True:
            if level == len(self.names):
                self.names.append({})
                self.blocks.append([])
                self.suffixes.append({})
            known = self.names[level]
            self.blocks[level].append(known.setdefault((left, right), len(known)))
            if length >> level & 1:
                return
            left, right = self.blocks[level][-2:]
            level += 1

    def _catch(self, period: int, at: int, size: int) -> None:
        """Open the stretch around a block that ended ``period`` words ago and ends again with word ``at``."""
        text, start = self.text, at - period - size + 1
        for other, first in self.open.items():
            if first <= start and (other <= size or period % other == 0):
                return
        while start and text[start - 1] == text[start - 1 + period]:
            start -= 1
        self.open[period] = start

    def _close(self, period: int, end: int) -> None:
        start = self.open.pop(period)
        if end - start >= 2 * period:
            self.runs.append((start, end - start, period))


def runs_of(words: Iterable, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` words and two periods, by start, then period."""
    return [run for run in Catchers().extend(words).finish() if run[1] >= least]


def collapse(words: list[bytes], runs: Iterable[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    kept, dropped = bytearray(b"\1") * len(words), False
    for start, length, period in runs:
        kept[start + period:start + length] = bytes(length - period)
        dropped = True
    return [w for w, stays in zip(words, kept, strict=True) if stays] if dropped else words


def find_runs(docs: DataFrame, text: str = "text", id_column: str = "doc_id", least: int = LEAST_WORDS) -> DataFrame:
    """Id, ``runs`` (array of start, length, period) and ``collapsed`` text of every row."""
    run = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = T.StructType().add("id", docs.schema[id_column].dataType).add("runs", T.ArrayType(run)).add("collapsed", "string")
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in run.fieldNames()]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in common.parts(batch, "text"):
                found, short = [], []
                for one in texts:
                    words = common.raw_words(one)
                    ids: dict[bytes, int] = {}
                    runs = runs_of([ids.setdefault(w, len(ids)) for w in words], least)
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                    short.append(b" ".join(collapse(words, runs)).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(found, run_type), pa.array(short, pa.string())],
                    ["id", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(find, schema).withColumnRenamed("id", id_column)


def echoed(text: Column, number: Column) -> Column:
    """The text, made periodic from some word on where crc32 of the decimal number ends with 0."""
    crc = F.crc32(number.cast("string").cast("binary"))
    turn = F.floor(crc / 10).cast("long")
    words = F.filter(F.split(text, SEPARATORS), lambda w: w != "")
    # one struct per step keeps the words from being split again for every use
    found = F.transform(F.array(F.struct(words.alias("w"), turn.alias("g"))), lambda s: F.struct(
        s["w"].alias("w"), F.size(s["w"]).alias("n"), (s["g"] % F.size(s["w"])).alias("a"), s["g"].alias("g")))
    found = F.transform(found, lambda s: F.struct(s["w"].alias("w"), s["n"].alias("n"), s["a"].alias("a"), (
        1 + F.floor((s["n"] - s["a"]) / (3 + s["g"] % 8))).alias("p")))
    made = F.transform(found, lambda s: F.concat_ws(" ", F.transform(
        F.sequence(F.lit(0), s["n"] - 1),
        lambda i: F.get(s["w"], F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int")))))
    return F.when((crc % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), made[0]).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", echoed(F.col("text"), F.col("doc_id")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.concat_ws("\n", lines), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: Every pair of equal words by distance, cut into stretches: a stretch as long as its distance makes a run.
OP11_SQL = """
WITH crc AS (
  SELECT doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      range(1, length(doc_id::VARCHAR) + 1), lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384))) AS h FROM documents),
split AS (SELECT doc_id, h, h // 10 AS g, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM crc),
turned AS (SELECT *, len(ws) AS n, g % greatest(len(ws), 1) AS a FROM split),
made AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
    CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE ws END AS ws
  FROM turned),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM made),
p AS (SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i),
s AS (SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k, i FROM p),
stretch AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY doc_id, q, k HAVING count(*) >= q),
r AS (SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= 12 GROUP BY doc_id, start, length),
digest AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first(start ORDER BY length DESC, start, period) AS start, first(length ORDER BY length DESC, start, period) AS length,
    first(period ORDER BY length DESC, start, period) AS period FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM w
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = w.doc_id AND gone.i = w.i) GROUP BY doc_id)
SELECT made.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM made LEFT JOIN digest ON made.doc_id = digest.doc_id LEFT JOIN kept ON made.doc_id = kept.doc_id
"""
