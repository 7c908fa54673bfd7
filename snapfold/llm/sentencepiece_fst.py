"""SentencePiece encoding and decoding as a shortest path through a weighted transducer.

The model file is compiled into a transducer: the normaliser (identity, with the leading space and the
visible space sign), one arc per piece, and byte arcs for characters no piece holds.  Composing it with
a text gives a lattice over the text's positions; the path of least weight (tropical semiring: weights
add along a path, the least path wins) is the encoding.  For a unigram model an arc weighs the piece's
negated score.  A BPE model is not additive: its weight sits on neighbouring arcs and is zero where
merging the two pieces' characters gives just these two pieces again, and infinite elsewhere.  A
sequence all of whose neighbours are so is the one that merging yields, so the only path of finite
weight is the encoding.  No piece has a space sign behind another character (checked when compiling),
so a path passes every word start, and words can be composed one by one and remembered.

Defined results: a null text has null token ids, an empty text has none; texts are read whole; a
character outside the pieces becomes its UTF-8 bytes, so decoding gives the text again, but for
U+2581, which the format itself reads as a space.  Rows are read one by one, so repeated rows are equal,
and an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from . import common

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED = 150_000  # words in each of the two generations that a task keeps
PARTS = 50_000  # parts of words, likewise
WHOLE = 64  # letters of a word that is tried before it is cut

# Fixed values of the model format: field numbers and kinds.
PIECES, TRAINER, NORMALISER = 1, 2, 3
TRAINER_KIND, TRAINER_UNIGRAM, TRAINER_BPE = 3, 1, 2
CHARSMAP, DUMMY_PREFIX, SQUEEZE, ESCAPE = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, number()
            continue
        size = number() if wire == 2 else 8 if wire == 1 else 4
        yield tag >> 3, data[at:at + size]
        at += size


def _bytes(ids: Sequence[int]) -> bytes:
    return struct.pack(f"{len(ids)}i", *ids)


class Recent(dict):
    """What was used lately, in two generations: when the young one is full it becomes the old one, which is dropped.

    What is found in the old one is young again, so that frequent words are never encoded twice.  What neither has is made.
    """

    def __init__(self, make: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.make, self.most = make, most
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Transducer:
    """Compiled from the bytes of a model file."""

    def __init__(self, model: bytes) -> None:
        self.text: list[str] = []
        self.score: list[float] = []
        self.kind: list[int] = []
        trainer: dict = {}
        normaliser: dict = {}
        for field, value in _fields(model):
            if field == PIECES:
                piece = dict(_fields(value))
                self.text.append(piece.get(1, b"").decode("utf-8"))
                self.score.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kind.append(piece.get(3, NORMAL))
            elif field == TRAINER:
                trainer = dict(_fields(value))
            elif field == NORMALISER:
                normaliser = dict(_fields(value))
        kind = trainer.get(TRAINER_KIND, TRAINER_UNIGRAM)
        if kind not in (TRAINER_UNIGRAM, TRAINER_BPE) or normaliser.get(CHARSMAP) or USER in self.kind:
            raise ValueError("only unigram and BPE models with the identity normaliser are compiled")
        self.merges = kind == TRAINER_BPE
        self.prefix = bool(normaliser.get(DUMMY_PREFIX, 1))
        self.squeeze = bool(normaliser.get(SQUEEZE, 1))
        if not normaliser.get(ESCAPE, 1):
            raise ValueError("only models that escape spaces are compiled")
        self.arcs = {t: i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k == NORMAL}
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k == BYTE}
        self.unknown = self.kind.index(UNKNOWN)
        self.joints = {t[k - 1:k + 1] for t in self.arcs for k in range(1, len(t))}
        self.letters = set().union(*self.arcs)
        self.trie: dict = {}
        for t, i in self.arcs.items():
            node = self.trie
            for letter in t:
                node = node.setdefault(letter, {})
            node[None] = i
        self.pairs: list[dict[int, bool]] = [{} for _ in self.text]  # as many as neighbours occur
        self.longest = max(map(len, self.arcs), default=0)
        open_: list[tuple[dict, int, tuple]] = [(self.trie, 0, ())]
        while open_:  # each node holds the arcs on the way to it as well, longest first
            node, size, arcs = open_.pop()
            if None in node:
                arcs = ((size, node[None], self.pairs[node[None]]), *arcs)
            open_ += [(child, size + 1, arcs) for letter, child in node.items() if letter is not None]
            node[""] = arcs
        if any(SPACE in t.lstrip(SPACE) for t in self.arcs):
            raise ValueError("a piece runs over a word start")
        self.raw = np.array([bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else t.replace(SPACE, " ").encode()
                             for t, k in zip(self.text, self.kind, strict=True)], object)
        self.words = Recent(lambda word: self.path(SPACE + word), REMEMBERED)
        self.parts = Recent(lambda part: _bytes(self.shortest_path(part)), PARTS)
        self.origins: dict[str, tuple[float, str, str]] = {}

    def merged(self, symbols: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """Join the neighbours whose joint piece scores highest, the leftmost of equals, to the end.

        Also returns the two symbols of the last merge.
        """
        last = None
        while len(symbols) > 1:
            best, at = -math.inf, -1
            for i in range(len(symbols) - 1):
                piece = self.arcs.get(symbols[i] + symbols[i + 1])
                if piece is not None and self.score[piece] > best:
                    best, at = self.score[piece], i
            if at < 0:
                break
            last = (symbols[at], symbols[at + 1])
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2:]]
        return symbols, last

    def made(self, text: str) -> tuple[float, str, str]:
        """When merging makes this piece (later is greater; a letter: -1) and of which two symbols."""
        found = self.origins.get(text)
        if found is None:
            _, last = self.merged(list(text))
            found = (-self.score[self.arcs[text]], *last) if last else (-1.0, "", "")
            self.origins[text] = found
        return found

    def meets(self, a: str, b: str) -> bool:
        """Whether the weight between two neighbouring arcs is zero, not infinite.

        It is infinite if some merge over their border comes before the merges beside it; those are
        undone from the latest to the earliest.
        """
        if a[-1] == SPACE == b[0]:  # pieces of spaces alone share one score, so their order is the place's
            return self.merged(list(a + b))[0] == [a, b]
        before = math.inf
        while True:
            over = self.arcs.get(a + b)
            if over is not None and -self.score[over] < before:
                return False
            made_a, made_b = self.made(a), self.made(b)
            if made_a[0] > made_b[0]:
                before, a = made_a[0], made_a[2]
            elif made_b[0] < 0:
                return True
            else:  # an equal merge over the border lies further left, so it would come first
                before, b = made_b[0] + 0.5, made_b[1]

    def arcs_from(self, word: str, start: int) -> list[tuple[int, int]]:
        """(end, piece) of the arcs that leave a place of the lattice, shortest first."""
        out, node = [], self.trie
        for end in range(start, len(word)):
            node = node.get(word[end])
            if node is None:
                break
            if None in node:
                out.append((end + 1, node[None]))
        return out

    def least_sum(self, word: str) -> list[int] | None:
        """The least path where weights sit on arcs (unigram), by relaxation from left to right."""
        size = len(word)
        cost, back = [0.0] + [math.inf] * size, [(0, -1)] * (size + 1)
        for start in range(size):
            if cost[start] < math.inf:
                for end, piece in self.arcs_from(word, start):
                    new = cost[start] - self.score[piece]
                    if new < cost[end]:
                        cost[end], back[end] = new, (start, piece)
        if cost[size] == math.inf:
            return None
        out = []
        while size:
            size, piece = back[size]
            out.append(piece)
        return out[::-1]

    def finite(self, word: str) -> list[int] | None:
        """The only path of finite weight where weights sit on neighbours (BPE), depth first.

        One finite path at most leads to a place, so a place that was left for good is not tried again.
        """
        size, trie, longest = len(word), self.trie, self.longest
        start, path, row = 0, [], None  # row: what is known of the neighbours of the last arc
        untried: list[Iterator] = []  # of each place on the path, the arcs that were not tried yet
        left: set[int] = set()
        while start < size:
            node = trie
            for letter in word[start:start + longest]:
                further = node.get(letter)
                if further is None:
                    break
                node = further
            if node is trie and word[start] not in self.letters:
                return None
            arcs = iter(node[""])
            while True:
                for step, piece, after in arcs:
                    if left and start + step in left:
                        continue
                    if row is not None:
                        met = row.get(piece)
                        if met is None:
                            met = row[piece] = self.meets(self.text[path[-1]], self.text[piece])
                        if not met:
                            continue
                    untried.append(arcs)
                    path.append(piece)
                    start += step
                    row = after
                    break
                else:
                    if not path:
                        return None
                    left.add(start)
                    start -= len(self.text[path.pop()])
                    row = self.pairs[path[-1]] if path else None
                    arcs = untried.pop()
                    continue
                break
        return path

    def shortest_path(self, word: str) -> tuple[int, ...]:
        """Piece ids of the least path through one word's lattice."""
        found = (self.finite if self.merges else self.least_sum)(word)
        if found is not None:
            return tuple(found)
        if len(word) > 1:  # a letter that only longer pieces hold
            return tuple(i for c in word for i in self.shortest_path(c))
        raw = word.encode("utf-8", "replace")
        return tuple(self.bytes[b] for b in raw) if len(self.bytes) == 256 else (self.unknown,)

    def path(self, word: str) -> bytes:
        """Ids of a word with the spaces before it; parts between cuts are remembered."""
        if self.merges and len(word) <= WHOLE:
            found = self.finite(word)
            if found is not None:
                return _bytes(found)
        # no piece holds the two letters at such a border, so every path passes it
        cuts = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.joints]
        if not cuts:
            return _bytes(self.shortest_path(word))
        return b"".join([self.parts[word[a:b]] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)])

    def ids(self, text: str) -> np.ndarray:
        """Piece ids of a text; read only."""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return np.zeros(0, np.int32)
        text = text.replace(SPACE, " ")
        words, split = self.words, text.split(" ")
        if self.prefix and "" not in split:  # one space before each word
            return np.frombuffer(b"".join(map(words.__getitem__, split)), np.int32)
        out: list[bytes] = []
        spaces = int(self.prefix)
        for word in split:
            if not word:
                spaces += 1
                continue
            out.append(words[word] if spaces == 1 else self.path(SPACE * spaces + word))
            spaces = 1
        if spaces > 1:
            out.append(self.path(SPACE * (spaces - 1)))
        return np.frombuffer(b"".join(out), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()

    def decode(self, ids: np.ndarray) -> str:
        body = b"".join(self.raw[ids])
        return (body[1:] if self.prefix and body[:1] == b" " else body).decode("utf-8", "replace")


_COMPILED: dict[str, Transducer] = {}


def _compiled(name: str) -> Transducer:
    """The transducer of a model file that the session has sent out, kept by the Python worker."""
    if name not in _COMPILED:
        with open(SparkFiles.get(name), "rb") as file:
            _COMPILED[name] = Transducer(file.read())
    return _COMPILED[name]


def _sent(spark: SparkSession, model: str) -> str:
    """Send the model file (half a megabyte; the driver can read it) to every executor."""
    if model not in spark.sparkContext.listFiles:
        spark.sparkContext.addFile(model)
    return model.rsplit("/", 1)[-1]


def encode(df: DataFrame, text: str = "text", target: str = "token_ids", round_trip: str | None = None,
           model: str = MODEL) -> DataFrame:
    """All columns, and the token ids of a text column.

    ``round_trip`` names one more column, if given: whether decoding the ids gives the text.  Columns of
    these names are replaced.
    """
    name = _sent(df.sparkSession, model)
    new = [T.StructField(target, T.ArrayType(T.IntegerType()))]
    if round_trip:
        new.append(T.StructField(round_trip, T.BooleanType()))
    rest = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in (target, round_trip)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(name)
        for batch in batches:
            for part, texts in common.parts(batch, text):
                ids = [None if t is None else machine.ids(t) for t in texts]
                made = [pa.array(ids, pa.list_(pa.int32()))]
                if round_trip:
                    made.append(pa.array([None if t is None else machine.decode(i) == t for t, i in zip(texts, ids, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *[f.name for f in new]])
            common.give_back()

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, *new]))


def decode(df: DataFrame, ids: str = "token_ids", target: str = "decoded", model: str = MODEL) -> DataFrame:
    """All columns, and the text that a column of token ids stands for; a column of that name is replaced."""
    name = _sent(df.sparkSession, model)
    rest = df.select(*[F.col(f"`{c}`") for c in df.columns if c != target])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(name)
        for batch in batches:
            rows = (row.values.to_numpy() if row.is_valid else None for row in batch.column(ids))
            made = pa.array([None if row is None else machine.decode(row) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, target])

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(target, T.StringType())]))


def op9_sentencepiece_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of tokens, a digest of their ids, and whether decoding gives the text."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, round_trip="round_trip").select(
        "doc_id", F.greatest(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"), "round_trip")
