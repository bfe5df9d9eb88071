"""Set-similarity join on word n-grams, down to the groups that its links form.

Texts with equal sets fold into one first. Of each remaining set, sorted rarest
first, a prefix is posted: two sets that reach the similarity share a posted
n-gram. Pairs that meet on one pass the length and position filters, a filter on
how both sets spread over parts of the hash range (the suffix filter), and one
exact comparison.

Groups of copies would make pairs of all their members, although a few links
hold them together. So each posted n-gram first leads its sets to one of them
only, the one whose rarest n-gram is the most common (what copies were made
from has nothing of its own), and each set is compared with the one it is led
to most often. The links found make components, and then only pairs of
different components are left to compare. No pair is compared twice
and none that could join two components is left out, so the components are
those of all links.

Of a pair, the n-gram that comes first in both must lie within the first few of
the set with fewer n-grams: as that set sees it, the other is no smaller, which
asks for a larger intersection. So a posted n-gram counts as shared only if one
of its sets holds it that far in front, pairs are made of such a row and one of
a set no smaller, in like size classes, and an n-gram that is hot among both is
cut into slices. N-grams that are not shared are dropped before the postings
move, by a bit table of those that are (of fixed size: what it lets through
besides costs a little, and changes nothing).

Rarity is the number of documents for the n-grams that occur in several
documents of one piece of the input, the ``KNOWN`` most frequent of them, whatever the size of
the input. It only orders the n-grams; any order gives the same result.
N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import fits_broadcast, split_join
from ..session import dropping_pins, pin
from .components import connected_components
from .shipping import map_arrow
from .words import PIECE_BYTES, Texts, find_words, hash_sequences, hash_words, mix, ngram_hashes, pieces, texts_of

PERCENT = 85
NGRAM = 4
KNOWN = 1 << 20
MARK_BITS = 28
SPREAD_BITS = 5
#: Rows of an n-gram that one task pairs with those of the other side.
PAIR_ROWS = 20_000


def shingles(texts: Texts, n: int = NGRAM) -> list[np.ndarray]:
    """The distinct n-gram hashes of each row in order; of a shorter text its whole word sequence."""
    words = find_words(texts)
    hashes = hash_words(texts.data, words)
    grams, bounds = ngram_hashes(hashes, words.bounds, n)
    whole = hash_sequences(hashes, words.bounds)
    out = []
    for k, count in enumerate(words.counts):
        out.append(np.unique(grams[bounds[k] : bounds[k + 1]]) if count >= n else whole[k : k + min(count, 1)])
    return out


def _part(values: np.ndarray, bits: int) -> np.ndarray:
    return (values >> np.uint64(64 - bits)).astype(np.int64)


class Rarity:
    """How many documents hold an n-gram, for frequent ones; 0 for all others."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.counts = grams[order], counts[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[_part(grams, 22)] = True

    def of(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.int64)
        likely = np.flatnonzero(self.seen[_part(values, 22)])
        if len(likely):
            at = np.minimum(np.searchsorted(self.grams, values[likely]), len(self.grams) - 1)
            out[likely] = np.where(self.grams[at] == values[likely], self.counts[at], 0)
        return out


def count_frequent(docs: DataFrame, n: int) -> Rarity:
    """The n-grams that several documents of a piece share, added up over pieces; ``KNOWN`` of them come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=2 * PIECE_BYTES):
            grams, counts = np.unique(np.concatenate(shingles(texts_of(piece["text"]), n)), return_counts=True)
            several = counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(grams[several].view(np.int64)), pa.array(counts[several])], ["gram", "n"])

    summed = map_arrow(docs.select("text"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = summed.orderBy(F.desc("n"), "gram").limit(KNOWN).toArrow()
    return Rarity(table["gram"].to_numpy().astype(np.int64).view(np.uint64), table["n"].to_numpy().astype(np.int64))


def reach(size: str, percent: int) -> Column:
    """How far in front an n-gram must be to be the first common one with a set that is no smaller."""
    return F.expr(f"{size} - ({2 * percent} * {size} + {99 + percent}) div {100 + percent} + 1")


def posted_sets(docs: DataFrame, rarity: Rarity, n: int, percent: int) -> DataFrame:
    """One row per document: id, hash of the text, size and fingerprint of its set, posted prefix, spread."""
    given = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = given.value
        for piece in pieces(batches):
            size, one, two, prefix, common, spread = [], [], [], [], [], []
            for values in shingles(texts_of(piece["text"]), n):
                m = len(values)
                rare = rarity.of(values)
                order = np.lexsort((values, rare))[: m - -(-percent * m // 100) + 1] if m else np.zeros(0, int)
                size.append(m)
                one.append(mix(values).sum(dtype=np.uint64).astype(np.int64))
                two.append(mix(values ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64).astype(np.int64))
                prefix.append(values[order].astype(np.int64))
                common.append(int(rare[order[0]]) if m else 0)
                spread.append(np.bincount(_part(values, SPREAD_BITS), minlength=1 << SPREAD_BITS).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    piece["row"], piece["doc_id"], piece["text_hash"], pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                    pa.array(prefix, pa.list_(pa.int64())), pa.array(common, pa.int64()), pa.array(spread, pa.list_(pa.int32())),
                ],
                ["row", "doc_id", "text_hash", "size", "one", "two", "prefix", "common", "spread"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = f"row long, doc_id {kind}, text_hash long, size long, one long, two long, prefix array<long>, common long, spread array<int>"
    return map_arrow(rows, run, schema)


def mark_shared(nodes: DataFrame, percent: int, most_bits: int = MARK_BITS) -> tuple[np.ndarray, int]:
    """A bit table of the posted n-grams that several sets share and that one of them holds in its reach.

    At most 2^``most_bits`` bits come to the driver, a row per eight bytes.
    """
    fore = F.col("at") < reach("size", percent)
    each = nodes.select("size", F.posexplode("prefix").alias("at", "gram")).select("gram", fore.cast("int").alias("fore"))
    shared = pin(
        each.groupBy("gram").agg(F.count(F.lit(1)).alias("_n"), F.max("fore").alias("_fore")).where("_n > 1 AND _fore = 1").select("gram"),
        "jaccard-shared",
    )
    bits = min(max(10, (16 * shared.count()).bit_length()), most_bits)
    places = shared.select(F.shiftrightunsigned("gram", 64 - bits).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("marks")).toArrow()
    marks = np.zeros(1 << (bits - 6), np.uint64)
    marks[words["word"].to_numpy()] = words["marks"].to_numpy().astype(np.int64).view(np.uint64)
    return marks, bits


def shared_postings(nodes: DataFrame, percent: int) -> DataFrame:
    """``gram``, ``node`` and ``packed`` of the marked n-grams of each set: size, place, and how common its rarest n-gram is."""
    given = nodes.sparkSession.sparkContext.broadcast(mark_shared(nodes, percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, bits = given.value
        for batch in batches:
            prefix = batch["prefix"]
            counts = np.diff(prefix.offsets.to_numpy()).astype(np.int64)
            grams = prefix.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            at = np.arange(len(grams)) - np.repeat(np.cumsum(counts) - counts, counts)
            place = grams.view(np.uint64) >> np.uint64(64 - bits)
            held = np.flatnonzero((marks[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))
            size, common = batch["size"].to_numpy()[row[held]], batch["common"].to_numpy()[row[held]]
            # a text has less than 2^30 words; five bits tell how common the rarest n-gram is
            level = np.minimum(np.log2(common + 1), 31).astype(np.int64)
            packed = (size << 33) | (at[held] << 5) | level
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[held]), pa.array(batch["node"].to_numpy()[row[held]]), pa.array(packed)], ["gram", "node", "packed"]
            )

    return map_arrow(nodes.select("node", "size", "common", "prefix"), run, "gram long, node long, packed long")


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def _positions_allow(a: str, b: str, percent: int) -> Column:
    """Length and position filters for columns ``size_*`` and ``at_*`` (place of the met n-gram)."""
    size_a, size_b, at_a, at_b = (F.col(f"{c}_{s}") for c in ("size", "at") for s in (a, b))
    long = F.greatest(size_a, size_b) * percent <= F.least(size_a, size_b) * 100
    rest = F.least(size_a - at_a, size_b - at_b)
    return long & (rest * (100 + percent) >= (size_a + size_b) * percent)


def _unpacked(pairs: DataFrame, *sides: str) -> DataFrame:
    for s in sides:
        packed = F.col(f"packed_{s}")
        at = F.shiftright(packed, 5).bitwiseAND(F.lit((1 << 28) - 1))
        pairs = pairs.withColumn(f"size_{s}", F.shiftright(packed, 33)).withColumn(f"at_{s}", at)
    return pairs


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (``a``, ``b``) whose sets reach the similarity.

    ``nodes`` (``node``, ``doc_id``, ``text_hash``, ``size``, ``spread``) are the sets' documents. Pairs
    that the spread rules out go first; the texts of the rest are read again.
    """
    def side(s: str) -> DataFrame:
        return nodes.select(F.col("node").alias(s), F.col("size").alias(f"size_{s}"), F.col("spread").alias(f"spread_{s}"))

    apart = F.aggregate(F.zip_with("spread_a", "spread_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda t, x: t + x)
    # |a - b| + |b - a| <= a + b - 2 * least overlap
    near = (F.col("size_a") + F.col("size_b") - apart) * (100 + percent) >= 2 * percent * (F.col("size_a") + F.col("size_b"))
    likely = pin(pairs.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b"), "jaccard-likely")
    needed = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
    wanted = pin(needed.join(nodes, "node").select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "jaccard-wanted")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    texts = docs.select("doc_id", "text").join(_maybe_broadcast(wanted), same).select("node", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            held = [s.tobytes() for s in shingles(texts_of(piece["text"]), n)]
            yield pa.RecordBatch.from_arrays([piece["node"], pa.array(held, pa.binary())], ["node", "held"])

    sets = pin(map_arrow(texts, cut, "node long, held binary"), "jaccard-sets").dropDuplicates(["node"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch["held_a"], batch["held_b"], strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = likely.join(sets.select(F.col("node").alias("a"), F.col("held").alias("held_a")), "a")
    met = met.join(sets.select(F.col("node").alias("b"), F.col("held").alias("held_b")), "b")
    return pin(map_arrow(met.select("a", "b", "held_a", "held_b"), compare, "a long, b long"), "jaccard-links")


def meeting_rows(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of postings (``gram``, ``node``, ``component``, ``size``, ``at``) that one n-gram can make similar.

    Side ``a`` has its n-gram in reach, side ``b`` is of its size class or the next.
    """

    def side(s: str, rows: DataFrame) -> DataFrame:
        return rows.select("gram", "class", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "size", "at")])

    # sizes that can be similar lie in one class or in neighbouring ones
    width = max(log(100 / percent), 1e-3) * 1.000001
    size_class = F.floor(F.log(F.col("size").cast("double")) / F.lit(width)).cast("int")
    fewer = side("a", rows.where(F.col("at") < reach("size", percent)).withColumn("class", size_class))
    more = side("b", rows.withColumn("class", F.explode(F.array(size_class - 1, size_class))))
    return split_join(more, fewer, ["gram", "class"], PAIR_ROWS, spread=["node_b"])


def similar_groups(docs: DataFrame, percent: int = PERCENT, n: int = NGRAM) -> DataFrame:
    """``row``, ``doc_id``, ``text_hash``, ``n_shingles`` and ``component_id`` of every row, and ``first``: it stands for its component.

    ``component_id`` is the least id of the component, null if it has none but
    null ids. A null or empty text, or one without words, has an empty set and is
    linked with nothing. Repeated rows are rows of one component. Of ``docs``
    only ``doc_id`` and ``text`` are read. An empty table gives an empty table.
    """
    held = pin(posted_sets(docs, count_frequent(docs, n), n, percent), "jaccard-posted")
    same = ["one", "two", "size"]
    folded = held.where("size > 0").groupBy(*same).agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("_n"))
    repeats = pin(folded.where("_n > 1").drop("_n"), "jaccard-equal")
    members = pin(
        held.select("row", "doc_id", "text_hash", "size", "one", "two").join(_maybe_broadcast(repeats), same, "left").select(
            "row", "doc_id", "text_hash", "size", F.coalesce("node", "row").alias("node")
        ),
        "jaccard-members",
    )
    extra = members.where(F.col("node") != F.col("row")).select("row")
    nodes = pin(held.where("size > 0").join(_maybe_broadcast(extra), "row", "left_anti").withColumnRenamed("row", "node"), "jaccard-nodes")
    met = pin(shared_postings(nodes, percent), "jaccard-met")
    best = F.max(F.struct(F.col("packed").bitwiseAND(F.lit(31)), (-F.col("node")).alias("last"), "packed")).alias("head")
    heads = met.groupBy("gram").agg(best).select("gram", (-F.col("head.last")).alias("head"), F.col("head.packed").alias("packed_head"))
    near = (
        _unpacked(met.join(heads, "gram").withColumnRenamed("packed", "packed_own"), "own", "head")
        .where((F.col("node") != F.col("head")) & _positions_allow("own", "head", percent))
        .groupBy("node", "head")
        .agg(F.count(F.lit(1)).alias("_met"))
    )
    # of the sets it was led to, each is compared with the one it meets most often
    first = pin(
        near.groupBy("node")
        .agg(F.max(F.struct("_met", (-F.col("head")).alias("head"))).alias("best"))
        .select("node", (-F.col("best.head")).alias("head"))
        .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
        .distinct(),
        "jaccard-first",
    )
    links = verify(first, nodes, docs, n, percent)
    labels = connected_components(links)
    placed = pin(
        met.join(_maybe_broadcast(labels), "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "jaccard-placed",
    )
    several = placed.groupBy("gram").agg(F.min("component").alias("_least"), F.max("component").alias("_most"))
    open_ = _unpacked(placed.join(several.where("_least < _most"), "gram").drop("_least", "_most").withColumnRenamed("packed", "packed_x"), "x")
    open_ = pin(open_.select("gram", "node", "component", F.col("size_x").alias("size"), F.col("at_x").alias("at")), "jaccard-open")

    larger = (F.col("size_b") > F.col("size_a")) | ((F.col("size_b") == F.col("size_a")) & (F.col("node_b") != F.col("node_a")))
    rest = (
        meeting_rows(open_, percent)
        .where(larger & (F.col("component_a") != F.col("component_b")) & _positions_allow("a", "b", percent))
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    further = verify(pin(rest, "jaccard-rest"), nodes, docs, n, percent)
    final = connected_components(links.union(further)) if further.limit(1).count() else labels
    named = members.join(_maybe_broadcast(final), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = pin(named.select("row", "doc_id", "text_hash", "size", "component"), "jaccard-named")
    # only components of several rows need a look at their other rows
    joint = named.where((F.col("size") > 0)).groupBy("component").agg(
        F.min("doc_id").alias("_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("_first"), F.count(F.lit(1)).alias("_n")
    ).where("_n > 1").select("component", "_id", F.col("_first.row").alias("_row"), F.lit(True).alias("_joint"))
    joint = pin(joint, "jaccard-joint")
    return named.join(_maybe_broadcast(joint), "component", "left").select(
        "row",
        "doc_id",
        "text_hash",
        F.col("size").alias("n_shingles"),
        F.when(F.col("_joint"), F.col("_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (F.coalesce("_row", "row") == F.col("row")).alias("first"),
    )


def keep_first(docs: DataFrame, percent: int = PERCENT, n: int = NGRAM) -> DataFrame:
    """``docs`` with one row of each group of similar texts: the one with the least id.

    Rows are told apart by id and text. Of repeated rows, equal in both, one
    stays if they stand for their group. Texts without words are in no group and
    all stay. Columns named ``_id`` or ``_hash`` are not allowed. What the join has
    stored is deleted.
    """
    with dropping_pins(docs.sparkSession):
        groups = similar_groups(docs, percent, n)
        keys = groups.groupBy("doc_id", "text_hash").agg(F.count_if("first").alias("_first"), F.count(F.lit(1)).alias("_n"))
        gone = keys.where(F.col("_first") < F.col("_n")).select(
            F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), (F.col("_first") > 0).alias("_again")
        )
        keys = pin(gone, "jaccard-gone", keep=True)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    kept = docs.join(_maybe_broadcast(keys), same, "left_anti")
    again = keys.where("_again")
    if not again.limit(1).count():
        return kept
    once = docs.join(_maybe_broadcast(again), same).dropDuplicates(["_id", "_hash"])
    return kept.unionByName(once.select(*docs.columns))
