"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into passages, passages become TF-IDF vectors over hashed
terms, and a randomised singular value decomposition over the passages of all
documents gives a small latent space: each task multiplies its passages with a
seeded random matrix and back, the products add up, and the (terms x ``RANK``)
sum is decomposed. Benchmark items are folded into that space. Windows of about
an item's length slide over every document by ``STEP_WORDS``; those whose cosine to the item is
high enough are candidates. Where the words of a stretch and its neighbours that
an item holds are too few for the subsequence asked for below, no window of it is
looked at; that rules out nothing else. A candidate counts if the longest common
subsequence of words covers enough of the item: most of it, or a good part if
the answer is there too. That also finds items with words changed, added or
left out.

The benchmark is a stated query set: it is read in blocks of ``ITEM_BLOCK``
items, each of bounded size and sent to all tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import fits_broadcast
from ..session import dropping_pins, pin
from .shipping import map_arrow
from .words import NOT_BLANK, Texts, find_words, hash_words, pieces, texts_of

TERM_BITS = 15
PASSAGE_WORDS = 32
RANK = 32
STEP_WORDS = 4
ITEM_BLOCK = 2_000
COSINE = 0.58
FULL_SHARE, PART_SHARE, ANSWER_SHARE = 0.8, 0.6, 0.5
SEED = 11

TERMS = 1 << TERM_BITS
#: Words are kept as 32-bit hashes, which verification compares; the first ``TERM_BITS`` bits number the term.
_SHIFT = np.uint32(32 - TERM_BITS)
BLOCK_STEPS = 16
COMMON_WEIGHT = 3.0
_PIECE_WORDS = 32_000
_codes = np.arange(256)
_ALNUM = (_codes >= 128) | ((_codes >= 48) & (_codes <= 57)) | ((_codes >= 65) & (_codes <= 90)) | ((_codes >= 97) & (_codes <= 122))
#: Everything but letters and digits separates terms.
_PLAIN = np.where(_ALNUM, _codes, 32).astype(np.uint8)


def terms_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the words of all rows, and the rows' bounds in them."""
    plain = Texts(_PLAIN[texts.data], texts.offsets)
    words = find_words(plain)
    return (hash_words(plain.data, words) >> np.uint64(32)).astype(np.uint32), words.bounds


def numbers(marks: np.ndarray) -> np.ndarray:
    """The term number of each word."""
    return (marks >> _SHIFT).astype(np.uint16)


def as_terms(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``text_hash`` and the words of each row, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            terms, bounds = terms_of(texts_of(piece["text"]))
            column = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(piece), [None, pa.py_buffer(4 * bounds.astype(np.int64)), pa.py_buffer(terms)]
            )
            yield pa.RecordBatch.from_arrays([piece["row"], piece["doc_id"], piece["text_hash"], column.cast(pa.binary())], ["row", "doc_id", "text_hash", "terms"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_arrow(rows, run, f"row long, doc_id {kind}, text_hash long, terms binary")


def term_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut to about ``_PIECE_WORDS`` words, with their terms and bounds."""
    for batch in batches:
        column = batch["terms"].cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 4
        begin = 0
        while begin < len(column):
            end = int(np.searchsorted(offsets, offsets[begin] + _PIECE_WORDS, "right")) - 1
            end = min(max(end, begin + 1), len(column))
            data = column.buffers()[2]
            held = np.frombuffer(data, np.uint32, int(offsets[end] - offsets[begin]), int(4 * offsets[begin])) if data is not None else np.zeros(0, np.uint32)
            yield batch.slice(begin, end - begin), held, offsets[begin : end + 1] - offsets[begin]
            begin = end


def _passages(bounds: np.ndarray) -> np.ndarray:
    """Number of the passage each word lies in; passages end with their row."""
    counts = np.diff(bounds)
    held = -(-counts // PASSAGE_WORDS)
    first = np.cumsum(held) - held
    place = np.arange(int(bounds[-1])) - np.repeat(bounds[:-1], counts)
    return np.repeat(first, counts) + place // PASSAGE_WORDS


def inverse_frequencies(terms: DataFrame) -> np.ndarray:
    """Weight of each term: log of passages over passages that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS + 1, np.int64)
        for _, marks, bounds in term_pieces(batches):
            held = numbers(marks)
            if len(held):
                passage = _passages(bounds)
                seen = np.sort(((passage << TERM_BITS) | held).astype(np.int32 if passage[-1] < 1 << 15 else np.int64))
                seen = seen[np.diff(seen, prepend=-1) > 0]
                total[:TERMS] += np.bincount(seen & (TERMS - 1), minlength=TERMS)
                total[TERMS] += passage[-1] + 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "n"])

    found = map_arrow(terms.select("terms"), run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(TERMS + 1)
    counts[found["term"].to_numpy()] = found["n"].to_numpy()
    return np.log((counts[TERMS] + 1) / (counts[:TERMS] + 0.5)).clip(0.1).astype(np.float32)


def latent_space(terms: DataFrame, weight: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Latent coordinates of each term (terms x rank), scaled by the inverse singular values.

    One pass: with ``A`` the passages and ``R`` random, ``Y = A'(A R)`` is summed
    up over tasks; ``Y (R'Y)^-1 Y'`` approximates ``A'A`` and is decomposed.
    """
    random = np.random.default_rng(SEED).normal(size=(TERMS, rank)).astype(np.float32)
    table = np.concatenate((random * weight[:, None], np.zeros((1, rank), np.float32)))
    given = terms.sparkSession.sparkContext.broadcast((table, weight))
    names = [f"y{i}" for i in range(rank)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weight = given.value
        total = np.zeros((TERMS, table.shape[1]))
        for _, marks, bounds in term_pieces(batches):
            held = numbers(marks)
            if not len(held):
                continue
            passage = _passages(bounds)
            first = np.flatnonzero(np.diff(passage, prepend=-1))
            squared = np.add.reduceat(weight[held] ** 2, first)
            # passages side by side, the rest of a short one filled with a term of no weight
            padded = np.full((int(passage[-1]) + 1) * PASSAGE_WORDS, TERMS, np.int64)
            padded[passage * PASSAGE_WORDS + np.arange(len(held)) - first[passage]] = held
            sums = np.matmul(np.ones((1, PASSAGE_WORDS), np.float32), table[padded].reshape(-1, PASSAGE_WORDS, table.shape[1]))[:, 0] / squared[:, None]
            order = np.argsort(held, kind="stable")
            ordered = held[order]
            head = np.flatnonzero(np.diff(ordered.astype(np.int32), prepend=-1))
            total[ordered[head]] += np.add.reduceat(sums[passage[order]], head, axis=0) * weight[ordered[head]][:, None]
        at = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *[pa.array(total[at, i].astype(np.float32)) for i in range(len(names))]], ["term", *names])

    schema = "term int, " + ", ".join(f"{y} float" for y in names)
    summed = map_arrow(terms.select("terms"), run, schema).groupBy("term").agg(*[F.sum(y).alias(y) for y in names]).toArrow()
    product = np.zeros((TERMS, rank))
    for i, y in enumerate(names):
        product[summed["term"].to_numpy(), i] = summed[y].to_numpy()
    core = random.T.astype(np.float64) @ product
    core = (core + core.T) / 2
    value, vector = np.linalg.eigh(core)
    good = value > max(value.max(), 0) * 1e-9
    half = product @ (vector[:, good] / np.sqrt(value[good]))
    left, singular, _ = np.linalg.svd(half, full_matrices=False) if half.size else (half, np.ones(0), None)
    # singular values of A are those of half; a term's coordinate is divided by them once
    return (left / np.maximum(singular, 1e-12) * weight[:, None]).astype(np.float32)


@dataclass
class Items:
    """A block of benchmark items, in classes of like length."""

    ids: list
    terms: list[np.ndarray]
    answers: list[np.ndarray]
    vectors: np.ndarray
    classes: dict[int, np.ndarray]


def _last_sentence(text: str) -> str:
    sentences = [s for s in text.replace("!", ".").replace("?", ".").split(".") if any(c.isalnum() for c in s)]
    return sentences[-1] if sentences else ""


def _items(rows: pa.Table, space: np.ndarray) -> Items | None:
    ids, held, answers = [], [], []
    given = rows["answer"].to_pylist() if "answer" in rows.column_names else [None] * len(rows)
    for item, text, answer in zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), given, strict=True):
        own = terms_of(texts_of(pa.array([text or ""])))[0]
        if len(own):
            ids.append(item)
            held.append(own)
            answers.append(terms_of(texts_of(pa.array([answer or _last_sentence(text)])))[0])
    if not ids:
        return None
    vectors = np.stack([space[numbers(t)].sum(0) for t in held])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    classes = defaultdict(list)
    for i, t in enumerate(held):
        steps = max(1, round(len(t) / STEP_WORDS))
        # windows differ from an item's length by an eighth at most
        classes[steps if steps <= 5 else round(1.25 ** round(np.log(steps) / np.log(1.25)))].append(i)
    return Items(ids, held, answers, vectors, {k: np.array(v) for k, v in classes.items()})


def common_length(pattern: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per place of ``pattern``."""
    masks: dict[int, int] = defaultdict(int)
    for i, t in enumerate(pattern.tolist()):
        masks[t] |= 1 << i
    every = row = (1 << len(pattern)) - 1
    for t in text.tolist():
        match = row & masks.get(t, 0)
        row = ((row + match) | (row - match)) & every
    return len(pattern) - row.bit_count()


class Search:
    def __init__(self, space: np.ndarray, weight: np.ndarray, items: Items):
        self.items = items
        common = np.append(weight < COMMON_WEIGHT, True)
        terms = [numbers(t) for t in items.terms]
        self.size = np.array([len(t) for t in terms])
        self.common = np.array([int(common[t].sum()) for t in terms])
        self.rare = ~common
        self.space = np.concatenate((space, np.zeros((1, space.shape[1]), np.float32)))
        self.holds = np.zeros((len(items.ids), TERMS + 1), bool)
        for i, t in enumerate(terms):
            self.holds[i, t] = True
        #: Places of rare terms that a stretch needs, if it has all common ones.
        self.need = np.ceil(PART_SHARE * self.size - self.common - 1e-9)
        # items by rare term
        owner, term = np.nonzero(self.holds & self.rare)
        order = np.argsort(term, kind="stable")
        self.owners, self.first = owner[order], np.searchsorted(term[order], np.arange(TERMS + 2))

    def hits_before(self, padded: np.ndarray) -> np.ndarray:
        """Up to each block of steps, the places that hold a rare term of each item."""
        width = BLOCK_STEPS * STEP_WORDS
        blocks = -(-len(padded) // width)
        counts = self.first[padded + 1] - self.first[padded]
        ahead = np.cumsum(counts) - counts
        at = np.arange(int(counts.sum())) - np.repeat(ahead - self.first[padded], counts)
        cell = np.repeat(np.arange(len(padded)) // width, counts) * len(self.size) + self.owners[at]
        hits = np.bincount(cell, minlength=blocks * len(self.size)).reshape(blocks, -1)
        return np.concatenate((np.zeros((1, len(self.size)), np.int64), np.cumsum(hits, 0)))

    def candidates(self, marks: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, first word, last word, item, cosine) of windows near an item, with half a window on either side."""
        held = numbers(marks)
        counts = np.diff(bounds)
        steps = -(-counts // STEP_WORDS)
        ahead = np.concatenate(([0], np.cumsum(steps)))
        if not ahead[-1]:
            return
        padded = np.full(int(ahead[-1]) * STEP_WORDS, TERMS, np.int64)
        padded[np.arange(len(held)) + np.repeat(ahead[:-1] * STEP_WORDS - bounds[:-1], counts)] = held
        before = self.hits_before(padded)
        blocks = np.arange(len(before) - 1)
        block = sum(self.space[padded[k::STEP_WORDS]] for k in range(STEP_WORDS))
        sums = np.concatenate((np.zeros((1, block.shape[1]), np.float32), np.cumsum(block, 0)))
        row = np.repeat(np.arange(len(counts)), steps)
        start, last = np.arange(len(row)), ahead[1:][row]
        for length, members in self.items.classes.items():
            beside = length // 2 + 1
            # what any window that starts in a block can see, and the items it can hold
            low = np.maximum(blocks * BLOCK_STEPS - beside, 0) // BLOCK_STEPS
            high = np.minimum((blocks * BLOCK_STEPS + BLOCK_STEPS - 1 + length + beside) // BLOCK_STEPS, len(blocks) - 1)
            able = before[high + 1][:, members] - before[low][:, members] >= self.need[members]
            end = np.minimum(start + length, last)
            # a window cut short by the end of its row counts only if it starts the row
            whole = np.flatnonzero(able.any(1)[start // BLOCK_STEPS] & ((end - start == length) | (start == ahead[:-1][row])))
            if not len(whole):
                continue
            window = sums[end[whole]] - sums[whole]
            window /= np.maximum(np.sqrt(np.einsum("ij,ij->i", window, window)), 1e-12)[:, None]
            near = window @ self.items.vectors[members].T
            at, which = np.nonzero((near >= COSINE) & able[whole // BLOCK_STEPS])
            if not len(at):
                continue
            item = members[which]
            # a window that does not hold enough of an item's terms cannot have the subsequence; common terms count
            # as often as the item has any
            first, stop = start[whole[at]], end[whole[at]]
            first, stop = np.maximum(first - beside, ahead[:-1][row[whole[at]]]), np.minimum(stop + beside, last[whole[at]])
            hits, rare = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for k in range(int((stop - first).max()) * STEP_WORDS):
                word = padded[np.minimum(first * STEP_WORDS + k, len(padded) - 1)]
                found = (first * STEP_WORDS + k < stop * STEP_WORDS) & self.holds[item, word]
                hits += found
                rare += found & self.rare[word]
            most = np.minimum(hits - rare, self.common[item]) + np.minimum(rare, (self.size - self.common)[item])
            for j in np.flatnonzero(most >= PART_SHARE * self.size[item]):
                r = row[whole[at[j]]]
                shift = bounds[r] - ahead[r] * STEP_WORDS
                yield r, first[j] * STEP_WORDS + shift, min(stop[j] * STEP_WORDS + shift, bounds[r + 1]), item[j], float(near[at[j], which[j]])

    def leaks(self, marks: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[float, float, float]]:
        """For each (row, item) found: cosine, shares of the item and of its answer in the best window."""
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        seen: dict[tuple[int, int], set[int]] = defaultdict(set)
        for r, first, stop, item, cosine in sorted(self.candidates(marks, bounds), key=lambda c: -c[4]):
            pattern, answer = self.items.terms[item], self.items.answers[item]
            # neighbours of a window that holds the item overlap it by half or more
            stretch = first // (len(pattern) // 2 + 1)
            if not seen[r, item].isdisjoint((stretch - 1, stretch, stretch + 1)):
                continue
            share = common_length(pattern, marks[first:stop]) / len(pattern)
            if share < PART_SHARE:
                continue
            answered = common_length(answer, marks[first:stop]) / len(answer)
            if share >= FULL_SHARE or answered >= ANSWER_SHARE:
                seen[r, item].add(stretch)
                found[r, item] = max(found.get((r, item), (0.0, 0.0, 0.0)), (cosine, share, answered), key=lambda x: (x[1], x[0]))
        return found


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``text_hash``, ``item_id``, ``cosine``, ``item_share``, ``answer_share``: documents that hold an item.

    One row per document and item. ``benchmark`` has ``item_id``, ``text`` and
    perhaps ``answer``; where that is missing or null, the last sentence counts as
    the answer. Items and documents without terms (null and empty texts) match
    nothing; repeated rows match each for itself. Other columns are not read. An
    empty table on either side gives an empty table.
    """
    spark = docs.sparkSession
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"row long, doc_id {kind}, text_hash long, item_id {item_kind}, cosine double, item_share double, answer_share double"
    terms = pin(as_terms(docs), "leak-terms")
    weight = inverse_frequencies(terms)
    space = latent_space(terms, weight)
    wanted = benchmark.select("item_id", "text", *[c for c in ("answer",) if c in benchmark.columns])
    blocks = -(-benchmark.count() // ITEM_BLOCK)
    out = spark.createDataFrame([], schema)
    for k in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        if not fits_broadcast(part):
            raise ValueError("a block of benchmark items is too large; lower ITEM_BLOCK")
        items = _items(part.toArrow(), space)
        if items:
            out = out.unionByName(_search(terms, space, weight, items, schema))
    return out


def _search(terms: DataFrame, space: np.ndarray, weight: np.ndarray, items: Items, schema: str) -> DataFrame:
    given = terms.sparkSession.sparkContext.broadcast((space, weight, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*given.value)
        for piece, held, bounds in term_pieces(batches):
            found = search.leaks(held, bounds)
            at = pa.array([r for r, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[piece[c].take(at) for c in ("row", "doc_id", "text_hash")], pa.array([search.items.ids[i] for _, i in found], kind),
                 *[pa.array([v[j] for v in found.values()], pa.float64()) for j in range(3)]],
                ["row", "doc_id", "text_hash", "item_id", "cosine", "item_share", "answer_share"],
            )

    kind = pa.array(items.ids).type
    return map_arrow(terms, run, schema)


def drop_leaking_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows are told apart by id and text.

    Columns named ``bad_id`` or ``bad_hash`` are not allowed. What the search has stored is deleted.
    """
    with dropping_pins(docs.sparkSession):
        found = find_leaks(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
        bad = pin(found.distinct(), "leaks", keep=True)
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.xxhash64("text") == F.col("bad_hash"))
    return docs.join(bad, same, "left_anti")
