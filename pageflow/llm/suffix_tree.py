"""Language-model scores from a probabilistic suffix tree.

A text is the sequence of its words, lower-cased and each closed by a blank, and
one end. Symbols are the bytes of that sequence, so every text has a
probability. A node of the tree is a context of up to ``DEPTH`` bytes. It is
retained if it occurs ``LEAST_COUNT`` times or more in training and if its next
symbols diverge from those after its shorter suffix by more than their number
justifies; its shorter suffixes are retained with it. Next-symbol distributions
are smoothed with those of the suffix, down to the root. A symbol is scored at
the longest suffix of what precedes it that is a node.

The tree grows with the corpus. A context with its next symbol is a window. The
distinct windows of all texts, a small part of the text, are grouped by their
stem, the ``STEM`` newest symbols of the context. All nodes below a stem follow
from its windows alone, so a task grows, smooths and scores them there; only the
few levels above the stems, bounded by the alphabet, meet in the driver. Windows
travel as one row of arrays per stem and task, codes as steps from the one
before. The up to ``RANKED`` most frequent windows with their scores go to all
tasks, which look up every place of every text there; the others meet their
scores by stem. A frequent window is thus no hot key in that join.

The unigram base score counts words of all training texts, by the same division:
frequent words, at most ``1 / FREQUENT_SHARE`` of them, are looked up in the
tasks, and the others meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import dropping_pins, pin
from .sampling import fold
from .shipping import map_arrow
from .words import LOWER, NOT_BLANK, Texts, find_words, pieces, texts_of

DEPTH = 6
STEM = 2
LEAST_COUNT = 32
PRIOR = 8.0
FREQUENT_SHARE = 1e-6
FOLDS, HELD_OUT = 5, 1
MOST_HELD = 2_000_000
RANKED = 1 << 20
RECORD = 1 << 19
MOST_LEFT = 1 << 19
#: Bytes of text that are looked at together: the arrays of their windows take some eighty times as much.
COUNTED_BYTES, SCORED_BYTES = 1 << 20, 1 << 19
HOMES = 256

BLANK, END = 32, 10
_BITS = 7
OTHER = 127
#: How far a stem lies above the lowest bit of a code.
_STEM_AT = _BITS * (DEPTH - STEM + 1)


def symbol_bytes(texts: Texts, pad: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The byte sequence of each row, after ``pad`` ends, and the rows' bounds in it."""
    words = find_words(texts)
    length = words.end - words.start
    row = words.row
    first = np.cumsum(length + 1) - (length + 1) + row * (pad + 1) + pad
    ahead = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(ahead, length)
    size = np.bincount(row, length + 1, len(texts)).astype(np.int64) + pad + 1
    bounds = np.concatenate(([0], np.cumsum(size)))
    out = np.full(int(bounds[-1]), END, np.uint8)
    out[place + np.repeat(first, length)] = LOWER[texts.data[place + np.repeat(words.start, length)]]
    out[first + length] = BLANK
    return out, bounds


def alphabet(counts: np.ndarray) -> np.ndarray:
    """Symbol of each byte: the most frequent bytes have their own, the rest share ``OTHER``."""
    counts = counts.copy()
    counts[[BLANK, END]] += 1
    own = [b for b in np.lexsort((np.arange(256), -counts))[:OTHER] if counts[b] > 0]
    symbols = np.full(256, OTHER, np.uint8)
    symbols[own] = np.arange(len(own))
    return symbols


def count_bytes(texts: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for piece in pieces(batches):
            texts = texts_of(piece["text"])
            seen = np.where(NOT_BLANK, np.bincount(texts.data, minlength=256), 0)
            total += np.bincount(LOWER, seen, 256).astype(np.int64)
            total[[BLANK, END]] += len(find_words(texts).start), len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], ["byte", "n"])

    counts = np.zeros(256, np.int64)
    for row in map_arrow(texts, run, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        counts[row["byte"]] = row["n"]
    return counts


def windows(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each row symbol after the ``DEPTH`` before it, packed; the newest of these highest. ``bounds`` include the padding."""
    codes = np.zeros(len(symbols) - DEPTH, np.int64)
    for k in range(1, DEPTH + 1):
        codes |= symbols[DEPTH - k : len(symbols) - k]
        codes <<= _BITS
    codes |= symbols[DEPTH:]
    padding = np.zeros(len(symbols), bool)
    for k in range(DEPTH):
        padding[bounds[:-1] + k] = True
    return codes[~padding[DEPTH:]]


def _heads(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


def _runs(heads: np.ndarray, n: int) -> np.ndarray:
    """The run of each of ``n`` places."""
    return np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))


def _tally(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and how often each occurs."""
    if counts is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        counts = counts[order]
        del order
    head = _heads(codes)
    if counts is None:
        return codes[head], np.diff(np.append(head, len(codes)))
    return codes[head], np.add.reduceat(counts, head) if len(head) else counts


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """The arrays as one; the list is emptied, so that they need not be held beside it."""
    out = np.concatenate(parts)
    parts.clear()
    return out


class _Tallies:
    """Numbers by code, added up whenever ``MOST_HELD`` have come together."""

    def __init__(self):
        self.parts, self.waiting = [], 0

    def add(self, codes: np.ndarray, numbers: np.ndarray) -> bool:
        """Whether more than half of the room is taken by different codes."""
        self.parts.append((codes, numbers))
        self.waiting += len(codes)
        if self.waiting <= MOST_HELD:
            return False
        self.parts = [self.take()]
        self.waiting = len(self.parts[0][0])
        return self.waiting > MOST_HELD // 2

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        codes, numbers = ([p[k] for p in self.parts] for k in (0, 1))
        self.parts, self.waiting = [], 0
        if not codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _tally(_joined(codes), _joined(numbers))


def _steps(codes: np.ndarray, shift: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Ordered codes by stem: the stems, a list per stem of each code less the one before, and the lists' offsets."""
    stem = codes >> shift
    heads = _heads(stem)
    steps = np.diff(codes, prepend=0)
    steps[heads] = codes[heads] - (stem[heads] << shift)
    offsets = np.append(heads, len(codes)).astype(np.int32)
    return pa.array(stem[heads], pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(steps)), offsets


def _listed(values: np.ndarray, offsets: np.ndarray | None = None) -> pa.ListArray:
    offsets = np.array([0, len(values)]) if offsets is None else offsets
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _records(batches: Iterator[pa.RecordBatch], key: str, *names: str) -> Iterator[tuple]:
    """The key and, as arrays, the named lists of each row."""
    for batch in batches:
        columns = [(np.asarray(batch[name].values), batch[name].offsets.to_numpy()) for name in names]
        for k, one in enumerate(batch[key].to_pylist()):
            yield one, *(values[at[k] : at[k + 1]] for values, at in columns)


def _codes(stem: int, steps: np.ndarray, shift: int = _STEM_AT) -> np.ndarray:
    return np.cumsum(steps) + (stem << shift)


_COUNTS = "stem int, follow array<long>, steps array<long>, n array<long>, m array<long>"
_STEMS = f"{_COUNTS}, depth array<int>, context array<long>, held array<long>"


def _by_stem(df: DataFrame, *then) -> DataFrame:
    return df.repartition("stem").sortWithinPartitions("stem", *then)


def count_windows(texts: DataFrame, symbols: np.ndarray, record: int = RECORD, least: int | None = None) -> DataFrame:
    """How often each window occurs in training and in all rows (``text``, ``train``), added up within tasks first.

    A row has a ``stem``, its training counts by next symbol (``follow``), and of
    its windows the codes (``steps``), training counts ``n`` and all counts ``m``.
    A stem of more than ``record`` windows has several rows, cut where its next older symbol changes.
    With ``least``, the worker that adds up a stem finds its nodes too, and rows are those of :func:`find_nodes`:
    a second worker a task would hold memory beside it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Tallies()

        def flush():
            marked, k = held.take()
            stems, steps, offsets = _steps(marked, _STEM_AT + 1)
            return pa.RecordBatch.from_arrays([stems, steps, _listed(k, offsets)], ["stem", "steps", "k"])

        for piece in pieces(batches, limit=COUNTED_BYTES):
            data, bounds = symbol_bytes(texts_of(piece["text"]), DEPTH)
            train = np.repeat(np.asarray(piece["train"]).astype(np.int64), np.diff(bounds) - DEPTH)
            if held.add(*_tally(windows(symbols[data].astype(np.int64), bounds) << 1 | train)):
                yield flush()
        yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = _Tallies(), None

        def flush():
            marked, k = held.take()
            heads = _heads(marked >> 1)
            codes = marked[heads] >> 1
            n, m = np.add.reduceat(k * (marked & 1), heads), np.add.reduceat(k, heads)
            follow = _listed(np.bincount(codes & OTHER, n, OTHER + 1).astype(np.int64))
            cuts = _heads(codes >> _STEM_AT - _BITS)
            begin = 0
            while begin < len(codes):
                at = np.searchsorted(cuts, begin + record)
                end = int(cuts[at]) if at < len(cuts) else len(codes)
                stems, steps, _ = _steps(codes[begin:end], _STEM_AT)
                yield pa.RecordBatch.from_arrays(
                    [stems, follow, steps, _listed(n[begin:end]), _listed(m[begin:end])], ["stem", "follow", "steps", "n", "m"]
                )
                begin = end

        for stem, steps, k in _records(batches, "stem", "steps", "k"):
            if now is not None and stem != now:
                yield from flush()
            now = stem
            held.add(_codes(stem, steps, _STEM_AT + 1), k)
        if now is not None:
            yield from flush()

    found = _by_stem(map_arrow(texts, count, "stem int, steps array<long>, k array<long>"))
    if least is not None:
        return map_arrow(found, lambda batches: find_nodes(merge(batches), least), _STEMS)
    return map_arrow(found, merge, _COUNTS)


class Level(NamedTuple):
    """What follows the contexts of one length: ``keys`` are a context and a next symbol."""

    keys: np.ndarray
    n: np.ndarray
    of: np.ndarray
    contexts: np.ndarray
    held: np.ndarray
    #: Place of the shorter context with that symbol in the level above; below a stem, the symbol.
    up: np.ndarray


def levels(codes: np.ndarray, n: np.ndarray) -> list[Level]:
    """The levels below the stem of these ordered windows, longest contexts first; each adds up the one before it."""
    out, keys = [], codes
    for depth in range(DEPTH, STEM, -1):
        context = keys >> _BITS
        heads = _heads(context)
        level = [keys, n, _runs(heads, len(keys)), context[heads], np.add.reduceat(n, heads)]
        if depth == STEM + 1:
            out.append(Level(*level, keys & OTHER))
            break
        shorter = keys >> 2 * _BITS << _BITS | keys & OTHER
        order = np.argsort(shorter, kind="stable")
        shorter = shorter[order]
        heads = _heads(shorter)
        up = np.empty(len(keys), np.int64)
        up[order] = _runs(heads, len(keys))
        out.append(Level(*level, up))
        keys, n = shorter[heads], np.add.reduceat(n[order], heads)
    return out


def diverging(n: np.ndarray, of: np.ndarray, held: np.ndarray, shorter: np.ndarray, least: int) -> np.ndarray:
    """Which contexts are frequent and differ enough from their shorter suffix, where ``shorter`` is each symbol's share."""
    seen = n > 0
    n, of = n[seen], of[seen]
    divergence = np.bincount(of, n * np.log(n / held[of] / shorter[seen]), len(held))
    kinds = np.bincount(of, minlength=len(held))
    return (held >= least) & (divergence > 0.5 * kinds * np.log(np.maximum(held, 1)) + 4.0)


def _shares(n: np.ndarray) -> np.ndarray:
    return n / np.maximum(n.sum(-1, keepdims=True), 1)


class Upper(NamedTuple):
    """Contexts of one length down to the stems: what follows each, whether it is a node, and the place of its suffix above."""

    contexts: np.ndarray
    n: np.ndarray
    node: np.ndarray
    up: np.ndarray


class Tree(NamedTuple):
    nodes: DataFrame
    stems: DataFrame
    upper: list[Upper]


def _upper(stems: np.ndarray, follow: np.ndarray, deep: np.ndarray, least: int) -> list[Upper]:
    """The levels from the stems, of which ``deep`` have nodes below, to the root."""
    out, contexts, n, node = [], stems, follow, deep
    for _ in range(STEM):
        shorter, up = np.unique(contexts >> _BITS, return_inverse=True)
        total = np.zeros((len(shorter), n.shape[1]), np.int64)
        np.add.at(total, up, n)
        of = np.repeat(np.arange(len(n)), n.shape[1])
        node = node | diverging(n.ravel(), of, n.sum(1), _shares(total)[up].ravel(), least)
        out.append(Upper(contexts, n, node, up))
        contexts, n, node = shorter, total, np.bincount(up, node, len(shorter)) > 0
    return [*out, Upper(contexts, n, np.ones(len(contexts), bool), np.zeros(len(contexts), np.int64))]


def find_nodes(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Counted stems with the nodes below them: ``depth``, ``context`` and ``held`` of each."""
    names = ["stem", "follow", "steps", "n", "m", "depth", "context", "held"]
    for stem, follow, steps, n, m in _records(batches, *names[:5]):
        below = levels(_codes(stem, steps), n)
        shares = [level.n / np.maximum(level.held, 1)[level.of] for level in below[1:]] + [_shares(follow)]
        depths, contexts, helds, longer = [], [], [], np.zeros(0, np.int64)
        for depth, level, shorter in zip(range(DEPTH, STEM, -1), below, shares, strict=True):
            node = diverging(level.n, level.of, level.held, shorter[level.up], least)
            node[np.searchsorted(level.contexts, longer >> _BITS)] = True
            longer = level.contexts[node]
            depths.append(np.full(len(longer), depth, np.int32))
            contexts.append(longer)
            helds.append(level.held[node])
        del below, shares
        lists = [follow, steps, n, m, *(np.concatenate(x) for x in (depths, contexts, helds))]
        yield pa.RecordBatch.from_arrays([pa.array([stem], pa.int32()), *map(_listed, lists)], names)


def grow(counted: DataFrame, least: int = LEAST_COUNT) -> Tree:
    """From window counts, the nodes (``depth``, ``context``, ``held``), the stored stems with their nodes, and the levels above.

    A context's newest symbol is its highest. Stems that have their nodes already are taken as they are.
    """
    if "depth" not in counted.columns:
        counted = map_arrow(counted, lambda batches: find_nodes(batches, least), _STEMS)
    stems = pin(counted, "suffix-stems")
    # rows of one stem agree in what follows it; there are at most as many stems as pairs of symbols
    seen = stems.groupBy("stem").agg(F.first("follow").alias("follow"), F.max(F.size("depth") > 0).alias("deep")).orderBy("stem").toArrow()
    follow = np.array(seen["follow"].to_pylist(), np.int64).reshape(-1, OTHER + 1)
    upper = _upper(seen["stem"].to_numpy().astype(np.int64), follow, seen["deep"].to_numpy(), least)
    short = [
        (STEM - k, int(context), int(held))
        for k, level in enumerate(upper)
        for context, held, node in zip(level.contexts, level.n.sum(1), level.node, strict=True)
        if node and held
    ]
    nodes = stems.select(F.explode(F.arrays_zip("depth", "context", "held")).alias("node")).select("node.*")
    return Tree(nodes.unionByName(counted.sparkSession.createDataFrame(short, "depth int, context long, held long")), stems, upper)


def frequent_from(stems: DataFrame, ranked: int) -> float:
    """The least count from which on windows are frequent, so that up to ``ranked`` are; counts are told apart in steps of a tenth."""
    step = F.floor(8 * F.log2("m")).alias("step")
    seen = stems.select(F.explode("m").alias("m")).groupBy(step).agg(F.count("m").alias("k"), F.min("m").alias("m"))
    total, least = 0, np.inf
    for row in seen.orderBy(F.desc("step")).collect():
        total += row["k"]
        if total > ranked:
            break
        least = row["m"]
    return least


def score_windows(tree: Tree, symbols: np.ndarray, ranked: int) -> DataFrame:
    """By ``stem``, log10 of the probability of each window's newest symbol at its longest node (``steps``, ``value``), ``frequent`` windows apart.

    A symbol that never followed a context has there what the shorter ones leave to it.
    """
    # per stem: each symbol's share there, and at the longest node down to there
    share = best = np.full((1, OTHER + 1), 1 / len(np.unique(symbols)))
    for level in reversed(tree.upper):
        share = (level.n + PRIOR * share[level.up]) / (level.n.sum(1, keepdims=True) + PRIOR)
        best = np.where(level.node[:, None], share, best[level.up])
    given = tree.stems.sparkSession.sparkContext.broadcast((tree.upper[0].contexts, share, best))
    least = frequent_from(tree.stems, ranked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shares, bests = given.value
        for stem, steps, n, m, depths, contexts in _records(batches, "stem", "steps", "n", "m", "depth", "context"):
            codes, at = _codes(stem, steps), np.searchsorted(known, stem)
            share, best = shares[at], bests[at]
            for depth, level in zip(range(STEM + 1, DEPTH + 1), reversed(levels(codes, n)), strict=True):
                share = (level.n + PRIOR * share[level.up]) / (level.held[level.of] + PRIOR)
                node = np.isin(level.contexts, contexts[depths == depth])
                best = np.where(node[level.of], share, best[level.up])
            value = np.log10(best)
            frequent = m >= least
            for often in (True, False):
                some = frequent == often
                if some.any():
                    stems, own, _ = _steps(codes[some], _STEM_AT)
                    yield pa.RecordBatch.from_arrays([stems, pa.array([often]), own, _listed(value[some])], ["stem", "frequent", "steps", "value"])

    return map_arrow(tree.stems.drop("follow", "held"), run, "stem int, frequent boolean, steps array<long>, value array<double>")


class Lookup:
    """Values by code. In an open table, the number of each code lies at the first free place from its hash on. Sent without the table."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.bits = max(4, (2 * len(codes)).bit_length())
        #: An empty place is -1, the number of what is added here: no code, and no value.
        self.codes, self.values = np.append(codes, -1), np.append(values, np.nan)
        self.given = self.codes[:-1], self.values[:-1]
        self.table = np.full(1 << self.bits, -1, np.int32)
        place, left = self._place(codes), np.arange(len(codes))
        while len(left):
            free = np.flatnonzero(self.table[place[left]] < 0)
            _, first = np.unique(place[left[free]], return_index=True)
            put = left[free[first]]
            self.table[place[put]] = put
            left = np.setdiff1d(left, put, assume_unique=True)
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)

    def __reduce__(self):
        return Lookup, self.given

    def _place(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, codes: np.ndarray) -> np.ndarray:
        """The value of each code, nan for others."""
        place = self._place(codes)
        at = self.table[place]
        held = self.codes[at]
        out = np.where(held == codes, self.values[at], np.nan)
        left = np.flatnonzero((held != codes) & (at >= 0))
        place = place[left]
        while len(left):
            place = (place + 1) & ((1 << self.bits) - 1)
            at = self.table[place]
            held = self.codes[at]
            hit = held == codes[left]
            out[left[hit]] = self.values[at[hit]]
            on = ~hit & (at >= 0)
            left, place = left[on], place[on]
        return out


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``n`` over all texts, added up within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

        for piece in pieces(batches):
            texts = texts_of(piece["text"])
            for k in range(len(texts)):
                held.update(texts.data[texts.offsets[k] : texts.offsets[k + 1]].tobytes().lower().split())
                if len(held) > MOST_HELD // 4:
                    yield flush()
                    held.clear()
        yield flush()

    return map_arrow(texts, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def score_rows(docs: DataFrame, symbols: np.ndarray, scores: Lookup, frequent: dict[bytes, int]) -> DataFrame:
    """Per row what frequent windows and words add to the scores, and the other words with their numbers.

    The other windows come by ``stem`` in rows of their own: codes (``steps``), the rows that have them (``at``) and how often (``times``).
    """
    escape = -float(np.log10(max(int((symbols == OTHER).sum()), 1)))
    known = {w: (n, float(np.log10(n + 0.5))) for w, n in frequent.items()}
    given = docs.sparkSession.sparkContext.broadcast((symbols, scores, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, scores, known = given.value
        left: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            codes, at = ([x[k] for x in left] for k in (0, 1))
            left.clear()
            codes, at = _joined(codes), _joined(at)
            order = np.lexsort((at, codes))
            codes = codes[order]
            at = at[order]
            del order
            heads = np.flatnonzero(np.concatenate(([True], (np.diff(codes) != 0) | (np.diff(at) != 0))))
            stems, steps, offsets = _steps(codes[heads], _STEM_AT)
            times = np.diff(np.append(heads, len(codes))).astype(np.int32)
            own = {"stem": stems, "steps": steps, "at": _listed(at[heads], offsets), "times": _listed(times, offsets)}
            return pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(len(stems), f.type)) for f in fields], schema=fields)

        fields = None
        for piece in pieces(batches, limit=SCORED_BYTES):
            fields = fields or pa.schema([("row", pa.int64()), ("doc_id", piece["doc_id"].type), *output])
            texts = texts_of(piece["text"])
            data, bounds = symbol_bytes(texts, DEPTH)
            codes = windows(symbols[data].astype(np.int64), bounds)
            row = np.repeat(np.arange(len(texts)), np.diff(bounds) - DEPTH)
            value = scores.get(codes)
            missed = np.flatnonzero(np.isnan(value))
            value[missed] = 0.0
            value += np.where(codes & OTHER == OTHER, escape, 0.0)
            left.append((codes[missed], piece["row"].to_numpy()[row[missed]]))
            n_words, n_known, base, rare, numbers = [], [], [], [], []
            for k in range(len(texts)):
                seen = Counter(texts.data[texts.offsets[k] : texts.offsets[k + 1]].tobytes().lower().split())
                hits, total, others = 0, 0.0, {}
                for word, n in seen.items():
                    found = known.get(word)
                    if found is None:
                        others[word] = n
                    else:
                        hits += n
                        total += n * found[1]
                n_words.append(seen.total())
                n_known.append(hits)
                base.append(total)
                rare.append(list(others))
                numbers.append(list(others.values()))
            own = [
                piece["row"], piece["doc_id"], pa.array(np.bincount(row, value, len(texts))), pa.array(n_words, pa.int64()),
                pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(rare, pa.list_(pa.binary())),
                pa.array(numbers, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(len(texts), f.type) for f in list(fields)[len(own) :])], schema=fields)
            if sum(len(c) for c, _ in left) > MOST_LEFT:
                yield flush()
        if any(len(c) for c, _ in left):
            yield flush()

    output = [
        ("score", pa.float64()), ("n_words", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("rare", pa.list_(pa.binary())),
        ("numbers", pa.list_(pa.int32())), ("stem", pa.int32()), ("steps", pa.list_(pa.int64())), ("at", pa.list_(pa.int64())),
        ("times", pa.list_(pa.int32())),
    ]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row long, doc_id {kind}, score double, n_words long, n_known long, base double, rare array<binary>, numbers array<int>, "
        "stem int, steps array<long>, at array<long>, times array<int>"
    )
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return map_arrow(rows, run, schema)


def add_tails(scores: DataFrame, windows: DataFrame) -> DataFrame:
    """``row`` and ``tail``: what the windows of :func:`score_rows` add; scores of a stem come before its windows.

    A task adds up its windows by row and sends the sums as arrays to ``HOMES``
    groups of rows, where those of all tasks meet. A row has at most a sum per window.
    """

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, parts, codes, values = _Tallies(), None, [], None, None

        def flush():
            row, tail = held.take()
            home = (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % HOMES
            order = np.argsort(home, kind="stable")
            heads = _heads(home[order])
            lists = (_listed(x[order], np.append(heads, len(row))) for x in (row, tail))
            return pa.RecordBatch.from_arrays([pa.array(home[order][heads], pa.int32()), *lists], ["home", "at", "tail"])

        for stem, steps, value, at, times in _records(batches, "stem", "steps", "value", "at", "times"):
            if stem != now:
                now, parts, codes = stem, [], None
            own = _codes(stem, steps)
            if len(value):
                parts.append((own, value))
                continue
            if codes is None:
                codes, values = _tally(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            if held.add(at, times * values[np.searchsorted(codes, own)]):
                yield flush()
        if held.waiting:
            yield flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Tallies()
        for _, at, tail in _records(batches, "home", "at", "tail"):
            if held.add(at, tail):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.take()], ["row", "tail"])
        if held.waiting:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.take()], ["row", "tail"])

    both = scores.select("stem", "steps", "value").unionByName(windows.select("stem", "steps", "at", "times"), allowMissingColumns=True)
    sums = map_arrow(_by_stem(both, F.col("value").isNull()), look_up, "home int, at array<long>, tail array<double>")
    return map_arrow(sums.repartition("home"), add, "row long, tail double").groupBy("row").agg(F.sum("tail").alias("tail"))


def score_documents(docs: DataFrame, least: int = LEAST_COUNT, ranked: int = RANKED) -> DataFrame:
    """``doc_id``, ``held_out``, token counts, base score and tree score of every row of ``docs``.

    A null or empty text is its end alone. Repeated rows and null ids are kept;
    ids only decide the fold. Only ``doc_id`` and ``text`` are read. Where
    nothing can be learned, words are unknown and all bytes alike. Equally frequent
    windows and words are looked up or joined as they come, which changes no score.
    An empty table gives an empty table.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    texts = docs.where(fold("doc_id", FOLDS) != HELD_OUT).select(text)
    symbols = alphabet(count_bytes(texts))
    marked = docs.select(text, (fold("doc_id", FOLDS) != HELD_OUT).alias("train"))
    with dropping_pins(docs.sparkSession):
        tree = grow(count_windows(marked, symbols, least=least), least)
        scores = pin(score_windows(tree, symbols, ranked), "suffix-scores", keep=True)
    best = scores.where("frequent").select("stem", "steps", "value").toArrow()
    parts = [(_codes(stem, steps), value) for stem, steps, value in _records(best.to_batches(), "stem", "steps", "value")]
    lookup = Lookup(*(np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0)), *parts, strict=True)))
    del best, parts
    vocabulary = pin(count_words(texts), "suffix-words")
    sums = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = texts.count()
    tokens, distinct = (sums["n"] or 0) + ends, sums["v"] + (1 if ends else 0)
    least_words = max(FREQUENT_SHARE * tokens, 1)
    often = vocabulary.where(F.col("n") >= least_words).toArrow()  # at most 1 / FREQUENT_SHARE words
    frequent = dict(zip(often["word"].to_pylist(), often["n"].to_pylist(), strict=True))
    found = pin(score_rows(docs, symbols, lookup, frequent), "suffix-rows")
    rows = found.where("stem IS NULL").drop("stem", "steps", "at", "times")
    others = rows.select("row", F.explode(F.arrays_zip("rare", "numbers")).alias("r"))
    others = others.select("row", F.col("r.rare").alias("word"), F.col("r.numbers").alias("k"))
    n = F.coalesce(F.col("n"), F.lit(0))
    met = (
        others.join(vocabulary.where(F.col("n") < least_words), "word", "left")
        .groupBy("row")
        .agg(F.sum(F.col("k") * F.log10(n + 0.5)).alias("rest"), F.sum(F.when(n > 0, F.col("k"))).alias("met"))
    )
    tail = add_tails(scores.where("NOT frequent"), found.where("stem IS NOT NULL"))
    zero = F.lit(0)
    n_tokens = F.col("n_words") + 1
    end = float(np.log10(ends + 0.5))
    norm = float(np.log10(tokens + 0.5 * (distinct + 1)))
    return rows.drop("rare", "numbers").join(met, "row", "left").join(tail, "row", "left").select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("n_known") + F.coalesce("met", zero) + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0)) + end - n_tokens * norm).alias("base_score"),
        (F.col("score") + F.coalesce("tail", F.lit(0.0))).alias("score"),
    )
