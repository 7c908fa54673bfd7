"""Language identification by a small convolutional network over bytes, in numpy.

Filters of several widths slide over the bytes of fixed-length windows; each filter's greatest
response in a window (max pooling) feeds a softmax over the languages.  A text's scores are the mean of
its windows' probabilities, over the whole text.  Training sees a bounded sample: ``rows_per_language``
documents of each language, drawn by a hash of the id, with ``windows_per_row`` excerpts each.

Defined results: a text that is null, or has no letter, is ``und`` with score 0, and so is every text if
nothing could be learned; rows without a language or text are not learned from; repeated rows get equal
results; ties between languages go to the first by name; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.functions import pandas_udf

from . import common

UNKNOWN = "und"
SLOTS = 64  # parts that a language's sample is drawn in first
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Settings:
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 8  # of each width
    window: int = 256
    rows_per_language: int = 400
    windows_per_row: int = 3
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


def windows(text: str, size: int) -> np.ndarray:
    """The text's bytes as rows of ``size``, the last filled up with spaces."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(raw) // size))
    out = np.full(rows * size, 32, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(rows, size)


class ByteCNN:
    """Weights: per width a table (offset, byte, filter); then a dense layer to the languages."""

    def __init__(self, labels: list[str], settings: Settings) -> None:
        rng = np.random.default_rng(settings.seed)
        self.labels, self.settings = labels, settings
        self.tables = [rng.normal(0, 0.3, (w, 256, settings.filters)).astype(np.float32) for w in settings.widths]
        size = settings.filters * len(settings.widths)
        self.bias = np.zeros(size, np.float32)
        self.dense = rng.normal(0, 0.1, (size, len(labels))).astype(np.float32)
        self.offset = np.zeros(len(labels), np.float32)
        self.pairs: list[list[np.ndarray]] | None = None

    def _responses(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Per width, each filter's response at every place: (window, place, filter)."""
        if self.pairs is None:
            for table in self.tables:
                places = x.shape[1] - len(table) + 1
                yield sum(table[k][x[:, k:k + places]] for k in range(len(table)))
            return
        two = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        for table, paired in zip(self.tables, self.pairs, strict=True):
            places = x.shape[1] - len(table) + 1
            out = paired[0].take(two[:, :places], axis=0)
            for k, more in enumerate(paired[1:], 1):
                out += more.take(two[:, 2 * k:2 * k + places], axis=0)
            if len(table) % 2:
                out += table[-1].take(x[:, len(table) - 1:], axis=0)
            yield out

    def freeze(self) -> ByteCNN:
        """Join neighbouring offsets into tables over byte pairs: half the look-ups, equal results."""
        self.pairs = [[(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1)
                       for k in range(0, len(t) - 1, 2)] for t in self.tables]
        return self

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.dense + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        pooled = np.concatenate([r.max(axis=1) for r in self._responses(x)], axis=1)
        return self._softmax(np.maximum(pooled + self.bias, 0))

    def train(self, x: np.ndarray, y: np.ndarray) -> ByteCNN:
        """Adam on the cross-entropy; a pooled response passes its gradient to the place it came from."""
        s, rng = self.settings, np.random.default_rng(self.settings.seed)
        weights = [*self.tables, self.bias, self.dense, self.offset]
        first = [np.zeros_like(w) for w in weights]
        second = [np.zeros_like(w) for w in weights]
        step, filters = 0, np.arange(s.filters)
        for _ in range(s.epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), s.batch):
                rows = order[at:at + s.batch]
                xb, yb = x[rows], y[rows]
                held = list(self._responses(xb))
                places = [r.argmax(axis=1) for r in held]
                peaks = [np.take_along_axis(r, p[:, None, :], 1)[:, 0] for r, p in zip(held, places, strict=True)]
                pooled = np.maximum(np.concatenate(peaks, axis=1) + self.bias, 0)
                error = self._softmax(pooled)
                error[np.arange(len(rows)), yb] -= 1
                error /= len(rows)
                back = (error @ self.dense.T) * (pooled > 0)
                grads = []
                for w, (table, place) in enumerate(zip(self.tables, places, strict=True)):
                    part, grad = back[:, w * s.filters:(w + 1) * s.filters], np.zeros_like(table)
                    for k in range(len(table)):
                        byte = np.take_along_axis(xb, place + k, 1)
                        np.add.at(grad[k], (byte, filters[None, :]), part)
                    grads.append(grad)
                grads += [back.sum(0), pooled.T @ error, error.sum(0)]
                step += 1
                for weight, grad, m, v in zip(weights, grads, first, second, strict=True):
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad * grad - v)
                    weight -= s.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """A language and score per text; all windows of some texts are scored together."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if self.labels else []
        if not known:
            return names, scores
        parts = [windows(texts[i], self.settings.window) for i in known]
        x, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        step = 2000
        each = np.concatenate([self.probabilities(x[a:a + step]) for a in range(0, len(x), step)])
        mean = np.add.reduceat(each.astype(np.float64), np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        for i, row in zip(known, mean, strict=True):
            best = int(row.argmax())
            names[i], scores[i] = self.labels[best], float(min(1.0, row[best]))
        return names, scores


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", id_column: str = "doc_id",
        settings: Settings = Settings()) -> ByteCNN:
    """Train on the labelled rows of ``docs``, a bounded number of each language.

    Only excerpts leave the executors: at most rows x windows x window characters for each language.
    """
    t = F.col("text")
    part = settings.windows_per_row
    cut = F.transform(F.sequence(F.lit(0), F.lit(part - 1)), lambda i: F.substring(
        t, (F.lit(1) + F.floor(i * F.length(t) / F.lit(part))).cast("int"), F.lit(settings.window)))
    order = (F.xxhash64("id"), F.col("id"), F.xxhash64("cut"))
    # twice, so that no task gathers a common language from all others
    slot = Window.partitionBy("lang", F.pmod(F.xxhash64("id"), F.lit(SLOTS))).orderBy(*order)
    place = Window.partitionBy("lang").orderBy(*order)
    rows = (
        docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
        .where(F.col("lang").isNotNull() & t.rlike(r"\p{L}"))
        .select("id", "lang", cut.alias("cut"))
        .withColumn("place", F.row_number().over(slot))
        .where(F.col("place") <= settings.rows_per_language)
        .withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= settings.rows_per_language)
        .select("lang", "cut", "id").collect()
    )
    rows.sort(key=lambda r: (r.lang, str(r.id), r.cut))
    labels = sorted({r.lang for r in rows})
    model = ByteCNN(labels, settings)
    held, marks = [], []
    for row in rows:
        for text_ in dict.fromkeys(row.cut):
            if text_ and LETTER.search(text_):
                held.append(windows(text_, settings.window)[0])
                marks.append(labels.index(row.lang))
    if held:
        model.train(np.stack(held), np.array(marks))
    return model


def language(text: Column, model: ByteCNN, spark: SparkSession) -> Column:
    """A struct (lang_pred, score) for a column of texts; the model's few weights are broadcast."""
    sent = spark.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cnn = sent.value.freeze()
        for texts in batches:
            texts, names, scores = list(texts), [], []
            for a, b in common.slices(texts):
                got = cnn.predict(texts[a:b])
                names += got[0]
                scores += got[1]
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predict(text)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a row without an id does not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def crc(value: int) -> int:
    return zlib.crc32(str(value).encode())


def op6_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    found = docs.select("doc_id", held_out().alias("held_out"), language(F.col("text"), model, spark).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")
