"""Toxicity as severity grades by cumulative-link (proportional odds) regression.

``P(grade > k) = sigmoid(weights . features - threshold_k)`` with ascending thresholds: all grades share
one weight per feature and differ in their threshold only.  Features are sparse: the distinct words of a
text in lower case and their beginnings (insults are inflected and compounded at the end), hashed to
buckets.  An L1 penalty keeps the features that matter and zeroes the rest, so that a long text does not
gather noise.  The output is the expected severity, the sum of the ``P(grade > k)``.

``labels`` only says toxic or not, so severity grades are made on the training rows: 0 where not toxic,
else one more for every threshold in ``grade_at`` that the number of the text's telling features reaches.
A feature is telling if its share among toxic texts is ``telling`` times that among others.

Training sees a bounded sample: ``rows_per_class`` documents of either label, drawn by a hash of the id.

Defined results: null, empty and wordless texts have no features and grade 0 with severity 0; texts are
read whole; repeated rows get equal results; several labels of one id count as toxic if one is; without
any toxic label, or without any other, severity is 0 everywhere; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from . import common

BUCKETS = 1 << 20
REMEMBERED = 300_000
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5)


@dataclass(frozen=True)
class Settings:
    rows_per_class: int = 3000
    grade_at: tuple[int, ...] = (6, 12)
    telling: float = 20.0
    deviations: float = 5.0  # by how many a feature's shares in the two classes must differ
    least_rows: int = 3  # texts of the sample that a feature must occur in
    penalty: float = 0.0005
    rounds: int = 300
    toxic_at: float = 0.5  # P(grade > 0) from which a text counts as toxic


def features(word: str) -> set[int]:
    """Buckets of a word and of its beginnings."""
    names = {word, *(f"^{word[:k]}" for k in BEGINNINGS if len(word) >= k)}
    return {zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS for name in names}


def text_features(text: str | None) -> bytes:
    """The distinct buckets of a text, as 32-bit numbers."""
    found: set[int] = set()
    for word in set(WORD.findall(text.lower())) if text else ():
        found |= features(word)
    return np.array(sorted(found), np.int32).tobytes()


class CumulativeLink:
    """Sparse weights by bucket, and ascending thresholds."""

    def __init__(self, weights: dict[int, float], thresholds: np.ndarray, toxic_at: float) -> None:
        self.weights, self.thresholds, self.toxic_at = weights, thresholds, toxic_at
        self.words: dict[str, tuple[int, ...]] = {}

    def logit(self, text: str) -> float:
        """Sum of the weights of a text's distinct buckets; a word's weighted buckets are remembered."""
        known, used = self.words, set()
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(WORD.findall(text.lower())):
            buckets = known.get(word)
            if buckets is None:
                buckets = known[word] = tuple(b for b in features(word) if b in self.weights)
            if buckets:
                used.update(buckets)
        return sum(self.weights[b] for b in sorted(used))

    def grades(self, texts: list[str | None]) -> pd.DataFrame:
        has = np.array([bool(t and WORD.search(t)) for t in texts], bool)
        z = np.array([self.logit(t) if h else 0.0 for t, h in zip(texts, has, strict=True)])
        over = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -50, 50))) * has[:, None]
        severity = over.sum(axis=1) if over.shape[1] else np.zeros(len(z))
        first = over[:, 0] if over.shape[1] else severity
        return pd.DataFrame({
            "expected_severity": severity, "p_toxic": first, "grade": (over >= 0.5).sum(axis=1).astype(np.int64),
            "toxic": first >= self.toxic_at if over.shape[1] else np.zeros(len(z), bool),
        })


def sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> list:
    """(toxic, buckets) of a bounded sample of labelled rows."""
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = None
    for toxic in (0, 1):
        part = marked.where(F.col("__toxic") == toxic).orderBy(*order).limit(settings.rows_per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    buckets = pandas_udf(lambda texts: texts.map(text_features), "binary")
    # at most 2 x rows_per_class ids: small enough to be sent to every task
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.withColumnRenamed("doc_id", "__id")), F.col("doc_id") == F.col("__id"))
    found = rows.select("doc_id", "__toxic", buckets("text").alias("buckets")).dropDuplicates(["doc_id"])
    return sorted(found.collect(), key=lambda r: r.doc_id)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> CumulativeLink:
    rows = sample(docs, labels, settings)
    toxic = np.array([r["__toxic"] for r in rows], np.int64)
    if not toxic.any() or toxic.all():
        return CumulativeLink({}, np.zeros(0), settings.toxic_at)
    each = [np.frombuffer(r.buckets, np.int32) for r in rows]
    sizes, flat = np.array([len(e) for e in each]), np.concatenate(each)
    row = np.repeat(np.arange(len(rows)), sizes)
    seen, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    use = count[column] >= settings.least_rows
    row, column = row[use], column[use]
    among = [np.bincount(column[toxic[row] == k], minlength=len(seen)) for k in (0, 1)]
    share = [(a + 0.5) / ((toxic == k).sum() + 1) for k, a in enumerate(among)]
    telling = share[1] >= settings.telling * share[0]
    # features whose shares in the classes differ by chance alone say nothing, and only slow the fit
    sizes = [(toxic == k).sum() for k in (0, 1)]
    pooled = (among[0] + among[1]) / len(rows)
    spread = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / sizes[0] + 1 / sizes[1]))
    use = (np.abs(among[1] / sizes[1] - among[0] / sizes[0]) >= settings.deviations * spread)[column]
    row, column = row[use], column[use]
    hits = np.bincount(row[telling[column]], minlength=len(rows))
    grade = toxic * (1 + sum((hits >= at).astype(np.int64) for at in settings.grade_at))
    weights, thresholds = _proximal(row, column, len(seen), grade, settings)
    return CumulativeLink({int(b): float(w) for b, w in zip(seen, weights, strict=True) if w}, thresholds, settings.toxic_at)


def _proximal(row: np.ndarray, column: np.ndarray, width: int, grade: np.ndarray, settings: Settings) -> tuple:
    """Accelerated proximal gradient on the mean of the K binary losses "grade > k", L1 on the weights.

    Classes are weighed alike.  Every feature has a step of its own: with binary features, the row sizes
    summed over a feature's rows bound the curvature along it, so rare features move as fast as common ones.
    The thresholds start at the grades' frequencies and are kept in order.
    """
    levels = np.arange(grade.max())
    over = (grade[:, None] > levels[None, :]).astype(np.float64)
    weigh = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    mean = np.clip((over * weigh[:, None]).sum(axis=0), 1e-3, 1 - 1e-3)
    w, cut = np.zeros(width), np.sort(np.log((1 - mean) / mean))
    ahead_w, ahead_cut, pace = w.copy(), cut.copy(), 1.0
    size = weigh * (1 + np.bincount(row, minlength=len(grade)))
    step = 4.0 / np.maximum(1e-9, len(levels) * np.bincount(column, weights=size[row], minlength=width))
    cut_step = 4.0 / size.sum()
    for _ in range(settings.rounds):
        z = np.bincount(row, weights=ahead_w[column], minlength=len(grade))
        error = (1 / (1 + np.exp(np.clip(ahead_cut[None, :] - z[:, None], -50, 50))) - over) * weigh[:, None]
        slope = np.bincount(column, weights=error.sum(axis=1)[row], minlength=width)
        new_w = ahead_w - step * slope
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * settings.penalty, 0)
        new_cut = np.sort(ahead_cut + cut_step * error.sum(axis=0))
        new_pace = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        gain = (pace - 1) / new_pace
        ahead_w, ahead_cut = new_w + gain * (new_w - w), new_cut + gain * (new_cut - cut)
        w, cut, pace = new_w, new_cut, new_pace
    return w, cut


def severity(text: Column, model: CumulativeLink, spark: SparkSession) -> Column:
    """A struct (expected_severity, p_toxic, grade, toxic); the model's few weights are broadcast."""
    sent = spark.sparkContext.broadcast(model)

    @pandas_udf("expected_severity double, p_toxic double, grade long, toxic boolean")
    def grade(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        link = sent.value
        for texts in batches:
            yield link.grades(list(texts))

    return grade(text)


def op8_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, common.table(spark, sf_dir, "labels"))
    return docs.select("doc_id", severity(F.col("text"), model, spark).alias("s")).select("doc_id", "s.*")
