"""Language identification with a convolutional network over bytes.

A text is cut into windows of a fixed number of bytes, all of them, without
overlap. Filters of several widths run over the byte classes of a window, each
filter's highest response is kept, and a softmax over those gives the window's
languages. A text's prediction is the mean over its windows, weighted by the
bytes of letters they hold.

A filter on one-hot bytes is a sum of table rows. For scoring, the tables of
neighbouring bytes are added up beforehand, so a filter of four bytes takes two
lookups. Training is plain numpy (Adam on windows of a bounded sample) in
shards that start each round from the same parameters and are averaged after it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import pin
from .sampling import fold, one_per_id, train_shards
from .shipping import map_arrow
from .words import NOT_BLANK, Texts, pieces, row_sums, texts_of

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
MOST_LABELLED = 6_000
WINDOWS_PER_TEXT = 4
ROUNDS, EPOCHS, BATCH, RATE = 3, 2, 64, 0.02
SHARD_ROWS = 1_000
FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"
SEED = 5
PIECE = 1 << 20

# Byte classes: blanks, digits, other ASCII, letters, first bytes of longer
# characters, and each following byte for itself.
CLASSES = 128
_codes = np.arange(256)
CLASS = np.full(256, 2, np.int32)
CLASS[~NOT_BLANK] = 0
CLASS[48:58] = 1
CLASS[97:123] = CLASS[65:91] = 4 + np.arange(26)
CLASS[128:192] = 32 + np.arange(64)
CLASS[192:256] = 96 + np.arange(64) % 32
_LETTER = ((CLASS >= 4) & (CLASS < 30)) | (_codes >= 192)


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.rlike(F.col(text), F.lit(r"\p{L}")), F.lit(False))


@dataclass
class Network:
    """Parameters as views of one vector."""

    flat: np.ndarray
    languages: int

    @staticmethod
    def size(languages: int) -> int:
        return sum(WIDTHS) * CLASSES * FILTERS + len(WIDTHS) * FILTERS * (languages + 1) + languages

    def parts(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        at, tables = 0, []
        for width in WIDTHS:
            n = width * CLASSES * FILTERS
            tables.append(self.flat[at : at + n].reshape(width, CLASSES, FILTERS))
            at += n
        pooled = len(WIDTHS) * FILTERS
        offset = self.flat[at : at + pooled]
        out = self.flat[at + pooled : at + pooled * (self.languages + 1)].reshape(pooled, self.languages)
        return tables, offset, out, self.flat[at + pooled * (self.languages + 1) :]

    @classmethod
    def start(cls, languages: int) -> Network:
        random = np.random.default_rng(SEED)
        flat = random.normal(0, 0.3, cls.size(languages)).astype(np.float32)
        return cls(flat, languages)


def windows(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte classes (windows x WINDOW, blanks at a text's end), letters per window, and the rows' bounds."""
    length = np.diff(texts.offsets)
    count = -(-length // WINDOW)
    bounds = np.concatenate(([0], np.cumsum(count)))
    place = np.arange(len(texts.data)) + np.repeat(bounds[:-1] * WINDOW - texts.offsets[:-1], length)
    codes = np.zeros(int(bounds[-1]) * WINDOW, np.int32)
    codes[place] = CLASS[texts.data]
    letters = np.zeros(len(codes), bool)
    letters[place] = _LETTER[texts.data]
    return codes.reshape(-1, WINDOW), letters.reshape(-1, WINDOW).sum(1), bounds


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


class Scorer:
    """A trained network with the tables of neighbouring bytes added up."""

    def __init__(self, network: Network):
        tables, self.offset, self.out, self.bias = network.parts()
        self.runs = []
        for table in tables:
            steps = []
            for k in range(0, len(table), 2):
                pair = table[k] if k + 1 == len(table) else (table[k][:, None, :] + table[k + 1][None, :, :]).reshape(-1, FILTERS)
                steps.append((k, k + 1 < len(table), np.ascontiguousarray(pair)))
            self.runs.append((len(table), steps))

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        pairs = codes[:, :-1] * CLASSES + codes[:, 1:]
        out = []
        for width, steps in self.runs:
            n = WINDOW - width + 1
            total = None
            for k, double, table in steps:
                rows = table[(pairs if double else codes)[:, k : k + n]]
                total = rows if total is None else np.add(total, rows, out=total)
            out.append(total.max(1))
        return np.concatenate(out, 1)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros((0, self.out.shape[1]), np.float32)
        return _softmax(np.maximum(self.pooled(codes) + self.offset, 0) @ self.out + self.bias)


def _gradient(network: Network, codes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Gradient of the mean cross-entropy over some windows."""
    tables, offset, out, bias = network.parts()
    grad = Network(np.zeros_like(network.flat), network.languages)
    g_tables, g_offset, g_out, g_bias = grad.parts()
    best, where = [], []
    for width, table in zip(WIDTHS, tables, strict=True):
        n = WINDOW - width + 1
        response = sum(table[k][codes[:, k : k + n]] for k in range(width))
        at = response.argmax(1)
        where.append(at)
        best.append(np.take_along_axis(response, at[:, None, :], 1)[:, 0])
    raw = np.concatenate(best, 1) + offset
    hidden = np.maximum(raw, 0)
    error = _softmax(hidden @ out + bias)
    error[np.arange(len(labels)), labels] -= 1
    error /= len(labels)
    g_out += hidden.T @ error
    g_bias += error.sum(0)
    back = (error @ out.T) * (raw > 0)
    g_offset += back.sum(0)
    row, filters = np.arange(len(labels))[:, None], np.arange(FILTERS)[None, :]
    for i, width in enumerate(WIDTHS):
        share = back[:, i * FILTERS : (i + 1) * FILTERS]
        for k in range(width):
            np.add.at(g_tables[i][k], (codes[row, where[i] + k], filters), share)
    return grad.flat


def fit_windows(codes: np.ndarray, labels: np.ndarray, flat: np.ndarray, languages: int, turn: int) -> np.ndarray:
    """Adam over the windows in a seeded order."""
    network = Network(flat.astype(np.float32), languages)
    random = np.random.default_rng(SEED + turn)
    mean, square, step = np.zeros_like(network.flat), np.zeros_like(network.flat), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(codes))
        for begin in range(0, len(order), BATCH):
            some = order[begin : begin + BATCH]
            grad = _gradient(network, codes[some], labels[some])
            step += 1
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            rate = RATE / (1 + turn) / (1 - 0.9**step)
            network.flat -= rate * mean / (np.sqrt(square / (1 - 0.999**step)) + 1e-7)
    return network.flat


def _examples(rows: pd.DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Evenly spaced windows of each text, at most ``WINDOWS_PER_TEXT``, that hold letters; and their languages."""
    codes, letters, bounds = windows(texts_of(pa.array(rows["text"], pa.string())))
    label = rows["lang"].map({n: i for i, n in enumerate(names)}).to_numpy()
    picked, labels = [], []
    for i in range(len(rows)):
        own = np.arange(bounds[i], bounds[i + 1])
        own = own[letters[own] >= 8] if (letters[own] >= 8).any() else own[letters[own] > 0]
        if len(own):
            own = np.unique(own[np.linspace(0, len(own) - 1, WINDOWS_PER_TEXT).astype(int)])
            picked.append(own)
            labels.append(np.full(len(own), label[i]))
    if not picked:
        return codes[:0], np.zeros(0, int)
    return codes[np.concatenate(picked)], np.concatenate(labels)


def train(docs: DataFrame, most_labelled: int = MOST_LABELLED) -> tuple[list[str], np.ndarray]:
    """The languages of the sample in order, and parameters learned from it.

    Learns from rows of the training folds that have a language, an id and a
    letter; ``most_labelled`` of them at most, and as many of each language as of
    any other if there are enough. Of rows that share id and language one is
    learned from. A language outside the sample is not learned.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
    # lowest hashes of all languages together, a smaller hash for rare languages: their share of the sample evens out
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_labelled)
    weight = F.xxhash64(F.lit("language"), "doc_id") / 2.0**64 + 0.5
    narrow = known.select("doc_id", "lang").join(F.broadcast(counts), "lang").withColumn("at", weight * F.col("count"))
    sample = pin(narrow.orderBy("at", "doc_id").select("doc_id", "lang").limit(most_labelled), "language-sample")
    names = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not names:
        return [], np.zeros(0, np.float32)
    examples = docs.where(has_letter()).select("doc_id", "lang", "text").join(F.broadcast(sample.distinct()), ["doc_id", "lang"])

    def fit(rows, flat, turn):
        codes, labels = _examples(rows, names)
        return fit_windows(codes, labels, flat, len(names), turn)

    start = Network.start(len(names)).flat
    examples = one_per_id(examples, "lang")
    return names, train_shards(pin(examples, "language-examples"), "doc_id", fit, start, ROUNDS, SHARD_ROWS)


def predict(docs: DataFrame, names: list[str], flat: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (of the predicted language)."""
    given = docs.sparkSession.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Network(given.value, len(names))) if names else None
        for piece in pieces(batches, limit=PIECE):
            texts = texts_of(piece["text"])
            mean = np.ones((len(texts), 1))
            if scorer:
                codes, letters, bounds = windows(texts)
                # a long text is scored in parts of bounded size
                parts = [scorer.probabilities(codes[i : i + 2048]) for i in range(0, max(len(codes), 1), 2048)]
                weighted = np.concatenate(parts) * (letters[:, None] + 1e-3)
                mean = np.stack([row_sums(weighted[:, k], bounds) for k in range(len(names))], 1)
                mean /= np.maximum(mean.sum(1, keepdims=True), 1e-12)
            best = mean.argmax(1)
            label = np.array(names or [UNDETERMINED], object)[best]
            top = np.clip(mean[np.arange(len(best)), best], 0, 1) if scorer else np.zeros(len(best))
            known = np.asarray(piece["_letter"])
            columns = [piece[c] for c in piece.schema.names if c != "_letter"]
            columns.append(pa.array(np.where(known, label, UNDETERMINED), pa.string()))
            columns.append(pa.array(np.where(known, top, 0.0)))
            yield pa.RecordBatch.from_arrays(columns, [*[c for c in piece.schema.names if c != "_letter"], "lang_pred", "score"])

    clean = docs.drop("lang_pred", "score", "_letter")
    marked = clean.withColumn("_letter", has_letter())
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_arrow(marked, run, T.StructType([*clean.schema.fields, *added]))


def identify(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``, learned from ``docs`` itself.

    A text that is null or has no letter gets ``und`` and score 0. Where nothing
    can be learned every text does. Repeated rows and null ids are kept, columns
    that clash with the two added ones are replaced. An empty table gives an
    empty table.
    """
    return predict(docs, *train(docs))


def digest(docs: DataFrame) -> DataFrame:
    names, flat = train(docs)
    found = predict(docs.select("doc_id", "text"), names, flat)
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
