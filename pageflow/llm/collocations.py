"""Phrases of two and three words that occur together more often than their parts do apart.

Words are numbered by how frequent they are. Two neighbouring words are then a
cell of a square of numbers, cut into tiles. The pairs of a chunk of texts are
counted tile by tile: a tile with many pairs as a dense array that the cell's
place addresses (``bincount``), all others as one sorted list of cells (COO).
Spark adds up the counts of all chunks. Frequent pairs are numbered by frequency
in turn, and a pair with the word after it is counted by the same method, so a
further word costs one more level.

Numbers go to the most frequent words and pairs only (``RANKED``); any other
counts under its own 63-bit hash. A word or pair below the least count can be in no
phrase, so a level counts only what a bit table of the frequent ones may hold.
Both have a fixed bound of what is broadcast (``RANKED`` keys, 2^``MOST_BITS``
bits); where more is frequent, more is counted, and all counts stay exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.joins import lookup_join
from ..session import pin
from .shipping import map_arrow
from .words import LOWER, PIECE_BYTES, Texts, hash_ranges, mix, pieces, texts_of

LEAST = 10
LONGEST_SHARE = 50
TOP = 2000
RANKED = 1 << 18
MOST_BITS = 27
TILE = 256
#: A tile with at least one pair per so many cells is counted as a dense array.
DENSE = 8
#: A task adds up the cells of its chunks until it holds so many different ones.
HELD_CELLS = 2_000_000
GROUPS = 64

_BYTES = np.arange(256)
_BREAK = np.isin(_BYTES, list(b".,;:!?")) | ((_BYTES >= 0x0A) & (_BYTES <= 0x0D))
_INSIDE = ~(_BREAK | (_BYTES == 0x20) | (_BYTES == 0x09))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Every key has this bit, which makes it negative as a signed number; a rank never is.
_KEY = np.uint64(1 << 63)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The key of a phrase made of two parts."""
    return mix(mix(left * _FACTOR + right) ^ _FACTOR) | _KEY


@dataclass
class Tokens:
    """Words of some rows: byte ranges, row, and whether the next word belongs to the same piece."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    goes_on: np.ndarray


def tokens(texts: Texts) -> Tokens:
    inside = _INSIDE[texts.data]
    inside = np.concatenate(([False], inside, [False]))
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    filled = texts.offsets[1:] > texts.offsets[:-1]
    heads, tails = texts.offsets[:-1][filled], texts.offsets[1:][filled] - 1
    first[heads], last[tails] = inside[1:-1][heads], inside[1:-1][tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(texts.offsets, start, "right") - 1
    goes_on = np.zeros(len(start), bool)
    if len(start) > 1:
        breaks = np.concatenate(([0], np.cumsum(_BREAK[texts.data], dtype=np.int64)))
        goes_on[:-1] = (row[1:] == row[:-1]) & (breaks[start[1:]] == breaks[end[:-1]])
    return Tokens(start, end, row, goes_on)


def keyed_words(piece: pa.RecordBatch) -> tuple[Texts, Tokens, np.ndarray]:
    """The words of a batch (``lang``, ``text``) and their keys: a word of two languages has two."""
    texts = texts_of(piece["text"])
    found = tokens(texts)
    lang = texts_of(piece["lang"])
    keys = np.zeros(len(lang), np.uint64)
    filled = np.flatnonzero(np.diff(lang.offsets))
    keys[filled] = hash_ranges(lang.data, lang.offsets[:-1][filled], lang.offsets[1:][filled])
    words = np.empty(len(found.start), np.uint64)
    for begin in range(0, len(words), 1 << 17):
        part = slice(begin, begin + (1 << 17))
        words[part] = hash_ranges(texts.data, found.start[part], found.end[part], lower=True)
    return texts, found, joined(keys[found.row], words)


@dataclass
class Ranks:
    """The most frequent keys numbered by frequency, and a bit table in which all frequent keys are marked twice."""

    keys: np.ndarray
    marks: np.ndarray
    bits: int

    def __post_init__(self):
        self.order = np.argsort(self.keys, kind="stable")
        self.sorted = self.keys[self.order]

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.sorted, keys), len(self.keys) - 1)
        return np.where(self.sorted[at] == keys, self.order[at], -1)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """False for keys that are not frequent; true for all that are, and for few others."""
        low = keys & np.uint64((1 << self.bits) - 1)
        high = (keys << np.uint64(1)) >> np.uint64(64 - self.bits)

        def marked(place: np.ndarray) -> np.ndarray:
            return (self.marks[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0

        return marked(low) & marked(high)

    def codes(self, keys: np.ndarray) -> np.ndarray:
        """What a key is counted as: its number, or itself as a negative number."""
        numbers = self.numbers(keys)
        return np.where(numbers < 0, keys.view(np.int64), numbers)

    def keys_of(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return codes.view(np.uint64)
        return np.where(codes < 0, codes.view(np.uint64), self.keys[np.maximum(codes, 0)])


def rank(counted: DataFrame, limit: int, most_bits: int = MOST_BITS) -> Ranks:
    """Number the ``limit`` most frequent keys of a stored table (``key``, ``n``) and mark all of them.

    To the driver come eight bytes for each of the first, and at most 2^``most_bits`` bits.
    """
    keys = counted.orderBy(F.desc("n"), "key").limit(limit).select("key").toArrow()["key"].to_numpy().astype(np.int64).view(np.uint64)
    bits = min(max(10, (16 * counted.count()).bit_length()), most_bits)
    low, high = F.col("key").bitwiseAND(F.lit((1 << bits) - 1)), F.shiftrightunsigned(F.shiftleft("key", 1), 64 - bits)
    places = counted.select(F.explode(F.array(low, high)).alias("place"))
    bit = F.expr("shiftleft(1L, int(place & 63))")
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("marks")).toArrow()
    marks = np.zeros(max(1, 1 << (bits - 6)), np.uint64)
    marks[words["word"].to_numpy()] = words["marks"].to_numpy().astype(np.int64).view(np.uint64)
    return Ranks(keys, marks, bits)


def count_cells(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells (``left``, ``right``) and how often each occurs, tile by tile. ``right`` is below ``width``."""
    across = -(-width // TILE)
    tile = (left // TILE) * across + right // TILE
    order = np.argsort(tile, kind="stable")
    left, right, tile = left[order], right[order], tile[order]
    edges = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1], [True]))) if len(tile) else np.zeros(1, int)
    sizes = np.diff(edges)
    found, sparse = [], np.ones(len(tile), bool)
    for k in np.flatnonzero(sizes * DENSE >= TILE * TILE):
        part = slice(edges[k], edges[k + 1])
        cells = np.bincount((left[part] % TILE) * TILE + right[part] % TILE, minlength=TILE * TILE)
        held = np.flatnonzero(cells)
        found.append((tile[edges[k]] // across * TILE + held // TILE, tile[edges[k]] % across * TILE + held % TILE, cells[held]))
        sparse[part] = False
    cells, counts = np.unique(left[sparse] * width + right[sparse], return_counts=True)
    found.append((cells // width, cells % width, counts))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _counted(left: np.ndarray, right: np.ndarray, first: Ranks, last: Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of codes with their counts: numbered ones by tiles, a chunk's other codes numbered after them."""

    def local(codes: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
        other = codes < 0
        further, places = np.unique(codes[other], return_inverse=True)
        numbers = codes.copy()
        numbers[other] = len(ranks.keys) + places
        return numbers, further

    x, further_x = local(left, first)
    y, further_y = local(right, last)
    x, y, counts = count_cells(x, y, max(1, len(last.keys) + len(further_y)))

    def code(numbers: np.ndarray, further: np.ndarray, ranks: Ranks) -> np.ndarray:
        out, other = numbers.copy(), numbers >= len(ranks.keys)
        out[other] = further[numbers[other] - len(ranks.keys)]
        return out

    return code(x, further_x, first), code(y, further_y, last), counts


def _added(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of cells added up to one sorted list."""
    left, right, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((right, left))
    left, right, counts = left[order], right[order], counts[order]
    heads = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
    return left[heads], right[heads], np.add.reduceat(counts, heads)


def count_words(docs: DataFrame) -> DataFrame:
    """``key``, ``lang``, ``word`` and ``n`` for every word of every language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            texts, found, keys = keyed_words(piece)
            different, at, counts = np.unique(keys, return_index=True, return_counts=True)
            lowered = LOWER[texts.data]
            words = [lowered[s:e].tobytes() for s, e in zip(found.start[at].tolist(), found.end[at].tolist(), strict=True)]
            lang = piece["lang"].take(pa.array(found.row[at]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(different.view(np.int64)), lang, pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts)],
                ["key", "lang", "word", "n"],
            )

    return map_arrow(docs, run, "key long, lang string, word string, n long").groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))


def _count_neighbours(docs: DataFrame, least: int, cells, first: Ranks, last: Ranks) -> DataFrame:
    """Frequent pairs of codes (``left``, ``right``, ``n``). ``cells`` gives those of a chunk from its words' keys."""
    given = docs.sparkSession.sparkContext.broadcast((first, last))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        first, last = given.value

        def out(columns: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["left", "right", "n"])

        for piece in pieces(batches):
            _, found, keys = keyed_words(piece)
            held.append(_counted(*cells(keys, found.goes_on, first, last), first, last))
            size += len(held[-1][0])
            if size > HELD_CELLS:
                held = [_added(held)]
                size = len(held[0][0])
                if 2 * size > HELD_CELLS:
                    yield out(held[0])
                    held, size = [], 0
        if held:
            yield out(_added(held) if len(held) > 1 else held[0])

    counted = map_arrow(docs, run, "left long, right long, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def _with_keys(counted: DataFrame, first: Ranks, last: Ranks, names: tuple[str, str]) -> DataFrame:
    """Codes turned back into keys."""
    given = counted.sparkSession.sparkContext.broadcast((first, last))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = given.value
        for batch in batches:
            left, right = first.keys_of(batch["left"].to_numpy()), last.keys_of(batch["right"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k.view(np.int64)) for k in (joined(left, right), left, right)), batch["n"]], ["key", *names, "n"]
            )

    return map_arrow(counted, run, f"key long, {names[0]} long, {names[1]} long, n long")


def count_pairs(docs: DataFrame, words: Ranks, least: int) -> DataFrame:
    """``key``, ``left``, ``right`` (keys of the words) and ``n`` of the frequent pairs of neighbouring words."""

    def cells(keys: np.ndarray, goes_on: np.ndarray, words: Ranks, _: Ranks):
        at = np.flatnonzero(goes_on)
        known = words.may_hold(keys)
        at = at[known[at] & known[at + 1]]
        return words.codes(keys[at]), words.codes(keys[at + 1])

    counted = pin(_count_neighbours(docs, least, cells, words, words), "phrase-pair-codes")
    return _with_keys(counted, words, words, ("left", "right"))


def count_triples(docs: DataFrame, words: Ranks, pairs: Ranks, least: int) -> DataFrame:
    """``first`` (key of the pair it begins with), ``last`` (of its third word) and ``n`` of the frequent triples."""

    def cells(keys: np.ndarray, goes_on: np.ndarray, pairs: Ranks, words: Ranks):
        two = np.flatnonzero(goes_on)
        both = np.zeros(len(keys), np.uint64)
        both[two] = joined(keys[two], keys[two + 1])
        known = np.zeros(len(keys), bool)
        known[two] = pairs.may_hold(both[two])
        at = two[goes_on[two + 1]] if len(two) else two
        at = at[known[at] & known[at + 1]]
        return pairs.codes(both[at]), words.codes(keys[at + 2])

    counted = pin(_count_neighbours(docs, least, cells, pairs, words), "phrase-triple-codes")
    return _with_keys(counted, pairs, words, ("first", "last")).drop("key")


def _second_pairs(triples: DataFrame) -> DataFrame:
    """Add ``second``, the key of the pair that a triple ends with, from ``w2`` and ``last``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w2, last = (batch[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("w2", "last"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(joined(w2, last).view(np.int64))], [*batch.schema.names, "second"])

    return map_arrow(triples, run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in triples.schema.fields) + ", second long")


def _scored(a: str, cuts: list[tuple[str, str]]) -> list:
    """SQL for ``l``, ``r`` and ``score`` of the cut with the lowest score, the earliest of equal ones. All numbers are whole."""
    tried = ", ".join(
        f"struct(CAST(1000000 AS DECIMAL(7,0)) * (CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0))) "
        f"div (CAST({x} AS DECIMAL(15,0)) * CAST({y} AS DECIMAL(15,0))) AS score, {k} AS k, {x} AS l, {y} AS r)"
        for k, (x, y) in enumerate(cuts)
    )
    return [F.expr(f"array_min(array({tried}))").alias("best")]


def top_phrases(
    docs: DataFrame, least: int = LEAST, longest_share: int = LONGEST_SHARE, top: int = TOP, ranked: int = RANKED, most_bits: int = MOST_BITS
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A null language is ``und``, a null text is empty; repeated rows count each.
    Order among equal scores is by count, then by the phrase's UTF-8 bytes, so
    ranks are unique. Only ``lang`` and ``text`` are read. An empty table, or one
    without frequent phrases, gives an empty table. Counts may reach 10^15.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    every = pin(count_words(rows), "phrase-words")
    totals = every.groupBy("lang").agg(F.sum("n").alias("n"))
    words = pin(every.where(F.col("n") >= least), "phrase-frequent-words")
    word_ranks = rank(words, ranked, most_bits)
    pairs = pin(count_pairs(rows, word_ranks, least), "phrase-pairs")
    counted = count_triples(rows, word_ranks, rank(pairs, ranked, most_bits), least)

    def counts(table: DataFrame, key: str, name: str) -> DataFrame:
        return table.select(F.col("key").alias(key), F.col("n").alias(name))

    met = pairs.select(F.col("key").alias("first"), F.col("left").alias("w1"), F.col("right").alias("w2"), F.col("n").alias("xy"))
    triples = pin(_second_pairs(lookup_join(counted, met, "first")), "phrase-triples")
    # a pair goes if a triple that holds it has at least half of its count
    longer = triples.select(F.explode(F.array("first", "second")).alias("key"), F.col("n").alias("_longer"))
    longer = longer.groupBy("key").agg(F.max("_longer").alias("_longer"))
    alone = pairs.join(longer, "key", "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < longest_share * F.col("n"))
    )
    two = lookup_join(lookup_join(alone, counts(words, "left", "x"), "left"), counts(words, "right", "y"), "right").select(
        F.array("left", "right").alias("parts"), F.col("n").alias("a"), *_scored("n", [("x", "y")])
    )
    three = lookup_join(triples, counts(pairs, "second", "yz"), "second")
    three = lookup_join(lookup_join(three, counts(words, "w1", "x"), "w1"), counts(words, "last", "z"), "last").select(
        F.array("w1", "w2", "last").alias("parts"), F.col("n").alias("a"), *_scored("n", [("x", "yz"), ("xy", "z")])
    )
    found = two.unionByName(three).select(
        "parts", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score")
    )
    # the language comes with the first word; what cannot rank needs no other words
    langs = words.select(F.col("key").alias("_first"), "lang")
    in_lang = lookup_join(found.withColumn("_first", F.col("parts")[0]), langs, "_first").drop("_first")
    # in two rounds, so that what the tasks of a large input hold of one language does not meet in one task
    ahead = in_lang.withColumn("_group", F.pmod(F.xxhash64("parts"), F.lit(GROUPS)))
    for group in (["lang", "_group"], ["lang"]):
        best = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"))
        ahead = ahead.withColumn("_place", F.rank().over(best)).where(F.col("_place") <= top).drop("_place")
    ahead = pin(ahead.drop("_group"), "phrase-ahead")
    spelled = lookup_join(
        ahead.withColumn("_id", F.monotonically_increasing_id()).select("*", F.posexplode("parts").alias("_at", "key")),
        words.select("key", "word"), "key",
    )
    named = spelled.groupBy("_id", "lang", "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_words"))
    named = named.withColumn("phrase", F.array_join(F.transform("_words", lambda w: w["word"]), " ")).drop("_id", "_words")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranks = named.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranks.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
