"""Quality rules by compression bands.

A document's zstandard ratio (compressed over plain bytes) says how much it repeats itself: far
below the usual band it is a loop, far above it is noise.  The band depends on the length, as short
texts never compress well.  The ratio is taken over the whole document, which sees repeats at any
distance, and over fixed chunks, which see a long document that is half loop or half noise.

Defined results: a null or empty text has no words, fails the base rule and is not kept; texts of
any length are read whole; rows are judged one by one, so ties and repeated rows get equal results,
and an empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from . import common

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, low_chunks double, high_chunks double, kept boolean"
)


@dataclass(frozen=True)
class Bands:
    """Limits (bytes, lowest ratio, highest ratio), ascending by length.

    ``document``: read between the points by the logarithm of the length, as the ratio falls steadily with it.
    The lowest are 1.5 % below the 0.5 % quantile of clean texts from 1448 bytes to 32 KB, 2.5 to 14 % below it
    under that, where they scatter and few are labelled, and carried on beyond it.  The sample: the 3330 rows of
    sf0.1 labelled quality 1 that pass the base rule.  The highest leave a sixth or more above the 99.5 % quantile,
    as no labelled text is bad that way.  Under 64 bytes the frame itself outweighs the text, and nothing is said.

    ``chunk``: (from this length of the document, ...); clean chunks lie between 0.436 and 0.513.  A chunk is as long
    in any document, so one band holds for all.
    """

    document: tuple[tuple[int, float, float], ...] = (
        (64, 0.80, 1.70), (128, 0.68, 1.20), (256, 0.54, 0.95), (512, 0.54, 0.85), (724, 0.512, 0.78), (1024, 0.494, 0.72),
        (1448, 0.480, 0.68), (2048, 0.467, 0.64), (2896, 0.456, 0.62), (4096, 0.441, 0.60), (5793, 0.428, 0.58),
        (8192, 0.420, 0.57), (11585, 0.414, 0.56), (16384, 0.406, 0.55), (32768, 0.391, 0.55), (131072, 0.36, 0.55),
    )
    chunk: tuple[tuple[int, float, float], ...] = ((0, 0.43, 0.60),)
    chunk_bytes: int = 4096
    chunk_share: float = 0.25  # of a document's chunks, out of band, that it may not pass
    level: int = 3


def limits(bands: tuple[tuple[int, float, float], ...], size: int) -> tuple[float, float]:
    """Between the points; nothing is refused before the first, and the last holds on."""
    if size < bands[0][0]:
        return 0.0, 9.0
    points, low, high = np.array(bands).T
    at, points = np.log2(size), np.log2(points)
    return float(np.interp(at, points, low)), float(np.interp(at, points, high))


def chunk_limits(bands: tuple[tuple[int, float, float], ...], size: int) -> tuple[float, float]:
    """Those of the last point reached."""
    return next((low, high) for least, low, high in reversed(bands) if size >= least)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    code, bound = ids, len(known)
    for k in range(1, WINDOW):
        if bound * len(known) >= 1 << 62:  # make the codes dense again, so that they stay exact
            seen, code = np.unique(code, return_inverse=True)
            bound = len(seen)
        code = code[:-1] * len(known) + ids[k:]
        bound *= len(known)
    ordered = np.sort(code)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(np.isin(code, twice))
    edges[at] += 1
    edges[at + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def chunk_ratios(body: bytes, size: int, squeeze) -> list[float]:
    """Ratios of fixed chunks; a tail under half a chunk joins its neighbour."""
    cuts = list(range(0, len(body), size))
    if len(cuts) > 1 and len(body) - cuts[-1] < size // 2:
        cuts.pop()
    ends = [*cuts[1:], len(body)]
    return [len(squeeze(body[a:b])) / (b - a) for a, b in zip(cuts, ends, strict=True)]


def judge(text: str | None, bands: Bands, squeeze) -> tuple:
    """One row of ``STATS``."""
    text = text or ""
    body = text.encode("utf-8", "replace")
    words = body.split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * len(words)
    ratio, low, high, fits = 0.0, 0.0, 0.0, False
    if body:
        ratio = len(squeeze(body)) / len(body)
        least, most = limits(bands.document, len(body))
        fits = least <= ratio <= most
        if len(body) >= 2 * bands.chunk_bytes:
            parts = chunk_ratios(body, bands.chunk_bytes, squeeze)
            least, most = chunk_limits(bands.chunk, len(body))
            low = sum(r < least for r in parts) / len(parts)
            high = sum(r > most for r in parts) / len(parts)
            fits = fits and low < bands.chunk_share and high < bands.chunk_share
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeats, failed, ratio, low, high, fits and not failed,
    )


def quality(text: Column, bands: Bands = Bands()) -> Column:
    """A struct of ``STATS`` for a column of texts."""

    @pandas_udf(STATS)
    def stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=bands.level).compress
        names = [part.split()[0] for part in STATS.split(", ")]
        for texts in batches:
            yield pd.DataFrame([judge(t, bands, squeeze) for t in texts], columns=names)
            common.give_back()

    return stats(text)


def assess(docs: DataFrame, text: str = "text", id_column: str = "doc_id", bands: Bands = Bands()) -> DataFrame:
    """The id and ``STATS`` of every row."""
    return docs.select(id_column, quality(F.col(text), bands).alias("q")).select(id_column, "q.*")


def keep_good(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows that pass, with all their columns."""
    return docs.where(quality(docs[text], bands)["kept"])


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(common.table(spark, sf_dir, "documents"))
