"""Quality rules as weak supervision.

Each rule votes good or bad on a document, or abstains. The accuracies of the
rules and the share of good documents are estimated by expectation-maximisation
from the votes alone, and a document is kept by its posterior probability
instead of having to pass every rule. All that the estimate needs is how often
each pattern of votes occurs, at most 3^9 counts whatever the number of
documents; they are counted over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import pin
from .shipping import map_arrow
from .words import (
    NOT_BLANK, Texts, Words, find_words, hash_ranges, hash_words, mix, ngram_hashes, pieces, row_sums, texts_of,
)

# The symbols that are counted, window length, and the base test.
SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

ROUNDS = 50
KEEP_AT = 0.5

SIGNALS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_plain_words", "n_distinct_words",
)

_CODES = np.arange(256)
_IS_CHAR = NOT_BLANK & ((_CODES & 0xC0) != 0x80)
_IS_UPPER = (_CODES >= 65) & (_CODES <= 90)
_IS_LETTER = _IS_UPPER | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 0xC3)
_IS_SYMBOL = np.isin(_CODES, np.frombuffer(SYMBOLS.encode(), np.uint8))
_IS_BODY = _IS_LETTER | ((_CODES & 0xC0) == 0x80) | ((_CODES >= 48) & (_CODES <= 57))
_IS_STOP = np.isin(_CODES, np.frombuffer(b".,;:!?", np.uint8))


def _count(texts: Texts, kind: np.ndarray) -> np.ndarray:
    """Bytes of a kind in each row."""
    sums = np.concatenate(([0], np.cumsum(kind[texts.data], dtype=np.int64)))
    return np.diff(sums[texts.offsets])


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Marks the values that occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def _distinct_per_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    keys = np.unique(mix(values + mix(row.astype(np.uint64))), return_index=True)[1]
    return np.bincount(row[keys], minlength=rows)


def _repeated_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Words of each row that lie in a window found twice or more in that row."""
    windows, ahead = ngram_hashes(hashes, words.bounds, REPEAT_WORDS)
    row = np.repeat(np.arange(len(ahead) - 1), np.diff(ahead))
    twice = np.flatnonzero(_repeats(mix(windows + mix(row.astype(np.uint64)))))
    first = twice - ahead[row[twice]] + words.bounds[row[twice]]
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + REPEAT_WORDS, -1)
    return row_sums((np.cumsum(steps[:-1]) > 0).astype(np.int64), words.bounds)


def _lines(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each row, and how many of them equal an earlier one."""
    breaks = np.flatnonzero(texts.data == 10)
    per_row = np.diff(np.searchsorted(breaks, texts.offsets)) + 1
    row = np.repeat(np.arange(len(texts)), per_row)
    # a line starts at its row's start or after a break, and ends before the next start of its row
    head = np.cumsum(per_row) - per_row
    inner = np.ones(len(row), bool)
    inner[head] = False
    start, end = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
    start[head], start[inner] = texts.offsets[:-1], breaks + 1
    end[head + per_row - 1] = texts.offsets[1:]
    end[np.flatnonzero(inner) - 1] = breaks
    filled = np.concatenate(([0], np.cumsum(NOT_BLANK[texts.data], dtype=np.int64)))
    with_word = filled[end] > filled[start]
    start, end, row = start[with_word], end[with_word], row[with_word]
    lines = np.bincount(row, minlength=len(texts))
    return lines, lines - _distinct_per_row(hash_ranges(texts.data, start, end), row, len(texts))


def measure(texts: Texts) -> dict[str, np.ndarray]:
    """The signals of each row."""
    words = find_words(texts)
    hashes = hash_words(texts.data, words, lower=False)
    lines, dup_lines = _lines(texts)
    last, before = texts.data[words.end - 1], texts.data[np.maximum(words.end - 2, words.start)]
    plain = _IS_BODY[last] | (_IS_STOP[last] & _IS_BODY[before])
    return {
        "n_words": words.counts,
        "word_chars": _count(texts, _IS_CHAR),
        "n_symbols": _count(texts, _IS_SYMBOL),
        "n_dup_lines": dup_lines,
        "n_repeat_words": _repeated_words(words, hashes),
        "n_lines": lines,
        "n_letters": _count(texts, _IS_LETTER),
        "n_upper": _count(texts, _IS_UPPER),
        "n_plain_words": row_sums(plain.astype(np.int64), words.bounds),
        "n_distinct_words": _distinct_per_row(hashes, words.row, len(texts)),
    }


def signals(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the signals of each row's text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = measure(texts_of(piece["text"]))
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], *[pa.array(found[s].astype(np.int64)) for s in SIGNALS]], ["doc_id", *SIGNALS]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, " + ", ".join(f"{s} bigint" for s in SIGNALS))


def _vote(bad: Column, good: Column) -> Column:
    """0 bad, 2 good, 1 no vote."""
    return F.when(bad, 0).when(good, 2).otherwise(1)


def votes() -> list[Column]:
    n, chars = F.col("n_words"), F.col("word_chars")

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    mean_length, shape = ratio("word_chars", "n_words"), ratio("n_letters", "word_chars")
    return [
        _vote(n < 10, n >= 40),
        _vote((mean_length < 2) | (mean_length > 14), mean_length.between(3, 11)),
        _vote(ratio("n_symbols", "n_words") > 0.3, ratio("n_symbols", "n_words") < 0.05),
        _vote(ratio("n_dup_lines", "n_lines") > 0.3, (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2)),
        _vote(ratio("n_repeat_words", "n_words") > 0.3, (F.col("n_repeat_words") == 0) & (n >= 40)),
        _vote(ratio("n_upper", "n_letters") > 0.5, (ratio("n_upper", "n_letters") < 0.2) & (chars > 20)),
        _vote(shape < 0.6, shape > 0.75),
        _vote((n >= 5) & (ratio("n_plain_words", "n_words") < 0.7), ratio("n_plain_words", "n_words") > 0.9),
        _vote((n >= 60) & (ratio("n_distinct_words", "n_words") < 0.15) & (n < 2000), (n >= 40) & (ratio("n_distinct_words", "n_words") > 0.3)),
    ]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posterior probability of good for each pattern of votes (rows of 0, 1, 2).

    Each rule has two accuracies: how seldom it votes bad on a good document, and
    how often on a bad one. Rules are specific: the first rate stays below a
    twentieth and the second above it, so that good keeps its meaning. A rule that
    abstains says nothing. Every count carries a small prior.
    """
    bad, voted = patterns == 0, patterns != 1
    on_good, on_bad, share = np.full(patterns.shape[1], 0.02), np.full(patterns.shape[1], 0.4), 0.9
    for _ in range(rounds):
        blame = np.log(on_bad / on_good)
        praise = np.log((1 - on_bad) / (1 - on_good))
        odds = np.log((1 - share) / share) + bad @ blame + (voted & ~bad) @ praise
        belief = 1 / (1 + np.exp(odds))
        good_weight, bad_weight = counts * belief, counts * (1 - belief)
        on_good = np.clip((good_weight @ bad + 0.1) / (good_weight @ voted + 5), 0.0005, 0.05)
        on_bad = np.clip((bad_weight @ bad + 2) / (bad_weight @ voted + 5), 0.1, 0.95)
        share = float(np.clip((good_weight.sum() + 9) / (counts.sum() + 10), 0.5, 0.98))
    return belief


def judge(docs: DataFrame) -> DataFrame:
    """The signals of each row, its ``posterior``, and whether it is ``kept``.

    Rows are kept as they are, also repeated ones and those with a null id. A
    null or empty text has no words, fails the base test and is not kept. Of
    ``docs`` only ``doc_id`` and ``text`` are read, so clashing columns do no
    harm. An empty table gives an empty table.
    """
    rules = votes()
    code = sum((v * 3**i for i, v in enumerate(rules)), F.lit(0))
    measured = pin(signals(docs).withColumn("pattern", code), "rule-signals")
    seen = measured.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()  # at most 3^9 rows
    codes = np.array([r["pattern"] for r in seen], np.int64)
    digits = codes[:, None] // 3 ** np.arange(len(rules)) % 3
    belief = estimate(digits, np.array([r["n"] for r in seen], float)) if len(seen) else np.zeros(0)
    rows = [(int(c), float(b)) for c, b in zip(codes, belief, strict=True)]
    table = docs.sparkSession.createDataFrame(rows, "pattern int, posterior double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return (
        measured.join(F.broadcast(table), "pattern")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("posterior") >= KEEP_AT))
    )
