"""Quality classifier: logistic regression on hashed word n-grams.

Features are single words and pairs of neighbours, lower-cased, and the same
for the words' outlines (the set of kinds of characters a word is made of); a
pair of equal words is one feature of its own. A text's features share a fixed
total, so long and short texts weigh alike. Training is
follow-the-regularised-leader with adaptive rates per feature, on shards of a
bounded labelled sample, averaged. A score is a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import pin
from .sampling import bounded_sample, fold, one_per_id, train_shards
from .shipping import map_arrow
from .words import NOT_BLANK, Texts, find_words, hash_words, mix, ngram_hashes, pieces, row_sums, texts_of

BITS = 18
SCALE = 12.0
MOST_LABELLED = 20_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
FOLDS = 5
THRESHOLD = 0.3

_EQUAL = np.uint64(1)
_codes = np.arange(256)
_KINDS = np.full(256, 0, np.uint64)
_KINDS[NOT_BLANK] = np.uint64(1) << (np.uint64(4) + (_codes[NOT_BLANK] % 60).astype(np.uint64))
_KINDS[(_codes >= 97) & (_codes <= 122) | (_codes >= 128)] = 1
_KINDS[(_codes >= 65) & (_codes <= 90)] = 2
_KINDS[(_codes >= 48) & (_codes <= 57)] = 4


def features(texts: Texts, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Families of feature numbers, each with the rows' bounds in it."""
    words = find_words(texts)
    hashes = hash_words(texts.data, words)
    outline = np.bitwise_or.reduceat(_KINDS[texts.data], words.start) if len(words.start) else hashes
    shift = np.uint64(64 - bits)
    out = []
    for salt, base in enumerate((hashes, mix(outline))):
        pairs, bounds = ngram_hashes(base, words.bounds, 2)
        if salt == 0:
            first = np.repeat(words.bounds[:-1] - bounds[:-1], np.diff(bounds)) + np.arange(len(pairs))
            pairs[base[first] == base[first + 1]] = _EQUAL
        for n, (values, at) in enumerate(((base, words.bounds), (pairs, bounds))):
            out.append(((mix(values + np.uint64(2 * salt + n + 1)) >> shift).astype(np.int64), at))
    return out


def margins(texts: Texts, weights: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Dot product of each row's features and the weights; the last weight is the bias."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for numbers, bounds in features(texts, bits):
        total += row_sums(weights[numbers].astype(np.float64), bounds)
        n += np.diff(bounds)
    return weights[-1] + SCALE * total / np.maximum(n, 1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ftrl(texts: Texts, labels: np.ndarray, start: np.ndarray, epochs: int = EPOCHS, bits: int = BITS) -> np.ndarray:
    """Follow-the-regularised-leader over the rows in order. ``start`` gives the size of the result only."""
    z, n = np.zeros(len(start)), np.zeros(len(start))
    families = features(texts, bits)
    rows = []
    for i in range(len(texts)):
        numbers = np.concatenate([f[b[i] : b[i + 1]] for f, b in families])
        at, counts = np.unique(numbers, return_counts=True)
        rows.append((np.append(at, len(start) - 1), np.append(SCALE * counts / max(len(numbers), 1), 1.0)))

    def leader(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for (at, x), label in zip(rows, labels, strict=True):
            w = leader(at)
            gradient = (_sigmoid(w @ x) - label) * x
            squared = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squared
    return leader(np.arange(len(start)))


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, bits: int = BITS) -> np.ndarray:
    """Weights from labelled rows of the training folds, at most ``most_labelled`` of them.

    Rows without a quality label do not count; where a document has several
    labels, the lowest counts. Of rows that share an id one is learned from, so
    that a repeated row neither counts more nor makes the sample larger. Without any
    label all weights are 0.
    """
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != 0))
    sample = pin(bounded_sample(marked.groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id", most_labelled), "quality-sample")
    examples = pin(one_per_id(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "quality"), "quality-examples")

    def fit(rows, weights, turn):
        return fit_ftrl(texts_of(pa.array(rows["text"], pa.string())), rows["quality"].to_numpy(), weights, bits=bits)

    return train_shards(examples, "doc_id", fit, np.zeros(2**bits + 1), rounds=1)


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """``doc_id`` and ``score`` of every row; null and empty texts get the bias alone."""
    given = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = _sigmoid(margins(texts_of(piece["text"]), given.value, bits))
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(found)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    Repeated rows and null ids are kept as they are; ids only decide the fold. Of
    ``docs`` only ``doc_id`` and ``text`` are read, of ``labels`` only ``doc_id``
    and ``quality``. An empty table gives an empty table; without labels every
    score is one half.
    """
    return score(docs, train(docs, labels)).select(
        "doc_id",
        (fold("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
