"""Remove what occurs twice: every byte covered by a long string that also starts at another place.

Equal strings must meet, but a suffix for every byte of a corpus is too much to
move. So each window of ``LENGTH`` bytes names an anchor: of all ``GRAM``-byte
strings in it the one with the least hash, the first of equal ones. Equal windows
name equal anchors at equal places. Neighbouring windows mostly share theirs, so
a document is a sequence of stretches, each with one anchor, of some 170 windows.

* Stretches with equal bytes fold into one; all their windows occur twice. This
  takes exact copies and shared passages, whatever their number.
* An anchor found in one stretch only can be in no repeated window.
* What is left are different stretches round one anchor, as near copies make
  them. One of each kind goes to a shard by its anchor. A shard sorts the
  suffixes of its stretches (Larsson-Sadakane refinement: ranks by a few bytes,
  then by twice as many, where several places still share one), and takes the
  common prefixes of neighbours by Kasai's bound. Windows that share ``LENGTH``
  bytes with a neighbour occur twice.
* Stretches of one anchor beyond ``SHARD_BYTES`` fill several shards. Each
  such shard then sends the windows it holds as sorted lists of fingerprints,
  cut into ranges, and the lists of a range are merged by binary search.

Fingerprints and stretch digests have 64 bits or more and are compared together
with the anchor's 64 bits; two different strings pass for equal with a chance of about 2^-128
in the first case and 2^-64 for the few windows that are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import fits_broadcast
from ..session import pin
from .shipping import map_arrow
from .words import mix, pieces, texts_of

LENGTH = 400
GRAM = 64
SHARD_BYTES = 1 << 20
#: Texts are looked at in blocks of this many windows; a block overlaps the next by what a window needs.
BLOCK = 4 << 20
#: A lot holds the fingerprints of about this many windows.
RANGE_WINDOWS = 1 << 20

_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15
_PLACE_BITS = 23
_INDEX_BITS = 21


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the string of ``length`` bytes (a power of two) at each place, by doubling."""
    hashes, step, factor = _BYTE_HASH[data], 1, _BASE
    while step < length:
        hashes = hashes[:-step] * np.uint64(factor) + hashes[step:]
        step, factor = 2 * step, factor * factor % (1 << 64)
    return mix(hashes)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def stretches(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, last window, and the anchor's hash. For up to 2^23 bytes."""
    hashes = string_hashes(data, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    # the place breaks ties, so the least is the first of equal strings
    least = _sliding_min((hashes & ~low) | place, length - gram + 1) & low
    edges = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]))
    return edges[:-1], edges[1:] - 1, hashes[least[edges[:-1]].astype(np.int64)]


def _union(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges from ``low`` to before ``high`` merged where they touch."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    heads = np.concatenate(([True], low[1:] > reach[:-1]))
    return low[heads], reach[np.concatenate((heads[1:], [True]))]


def _merged(owner, low, high) -> Iterator[tuple[int, int, int]]:
    """The same for ranges of several owners. Texts have less than 2^40 bytes."""
    owners, number = np.unique(np.asarray(owner, np.int64), return_inverse=True)
    shift = number.astype(np.int64) << 40
    low, high = _union(np.asarray(low) + shift, np.asarray(high) + shift)
    mask = (1 << 40) - 1
    return zip(owners[low >> 40].tolist(), (low & mask).tolist(), (high & mask).tolist(), strict=True)


_STRETCH = "row long, low long, high long, anchor long, digest long, again boolean"
_REPEATED = "node long, low long, high long, lot int, prints binary, places binary"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)], [name for name, _ in fields]
    )


def find_stretches(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """What the texts of ``rows`` (``row``, ``doc_id``, ``text_hash``, ``text``) consist of.

    One row per stretch: its windows ``low`` to ``high``, ``anchor``, and ``digest`` of its bytes. Of equal
    stretches in a piece of texts one is given, marked ``again``; for the others there are rows
    without an anchor: their bytes from ``low`` to before ``high`` are repeated. One row with
    ``doc_id`` and ``text_hash`` tells which text has the number ``row``.
    """

    def cut(row: int, data: np.ndarray, raw: memoryview, found: dict, gone: list) -> None:
        for begin in range(0, len(data) - length + 1, BLOCK):
            lows, highs, anchors = stretches(data[begin : begin + BLOCK + length - 1], length, gram)
            lows, ends = (begin + lows).tolist(), (begin + highs + length).tolist()
            for low, end, anchor in zip(lows, ends, anchors.view(np.int64).tolist(), strict=True):
                digest = int.from_bytes(hashlib.blake2b(raw[low:end], digest_size=8).digest(), "little", signed=True)
                first = found.setdefault((anchor, digest), [row, low, end - length, False])
                if first[0] != row or first[1] != low:
                    first[3] = True
                    gone.append((row, low, end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            texts = texts_of(piece["text"])
            raw, at = memoryview(texts.data.tobytes()), texts.offsets.tolist()
            long = np.flatnonzero(np.diff(texts.offsets) >= length)
            if not len(long):
                continue
            found, gone = {}, []
            named = piece.select(["row", "doc_id", "text_hash"]).take(pa.array(long))
            for k, row in zip(long.tolist(), named["row"].to_pylist(), strict=True):
                cut(row, texts.data[at[k] : at[k + 1]], raw[at[k] : at[k + 1]], found, gone)
            out = [(*first[:3], *key, first[3]) for key, first in found.items()]
            if gone:
                out += [(row, low, high, None, None, True) for row, low, high in _merged(*zip(*gone, strict=True))]
            batch, none = _batch(out, _STRETCH), len(out)
            names = [*batch.schema.names, "doc_id", "text_hash"]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.nulls(none, named["doc_id"].type), pa.nulls(none, pa.int64())], names
            )
            empty = [pa.nulls(len(long), c.type) for c in batch.columns[1:]]
            yield pa.RecordBatch.from_arrays([named["row"], *empty, named["doc_id"], named["text_hash"]], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"{_STRETCH}, doc_id {kind}, text_hash long")


# --- suffix arrays


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places of ``data`` (up to 2^21 bytes) in the order of the strings that start there and go to its end.

    The order is whole, not only as deep as windows are long: Kasai's bound holds for no other.
    """
    n, index = len(data), np.uint64((1 << _INDEX_BITS) - 1)
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(5):
        key = (key << np.uint64(8)) | padded[k : k + n]
    ordered = np.sort((key << np.uint64(_INDEX_BITS)) | np.arange(n, dtype=np.uint64))
    order, key = (ordered & index).astype(np.int64), ordered >> np.uint64(_INDEX_BITS)
    heads = np.concatenate(([True], key[1:] != key[:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    reach = 5
    while reach < n:
        # only groups of several places need another look: by the rank of what follows
        single = heads & np.concatenate((heads[1:], [True]))
        open_ = np.flatnonzero(~single)
        if not len(open_):
            break
        places = order[open_]
        follower = np.minimum(places + reach, n - 1)
        behind = np.where(places + reach < n, rank[follower] + 1, 0).astype(np.uint64)
        group = rank[places].astype(np.uint64)
        slot = np.arange(len(open_), dtype=np.uint64)
        both = np.sort((group << np.uint64(2 * _INDEX_BITS)) | (behind << np.uint64(_INDEX_BITS)) | slot)
        order[open_] = places[(both & index).astype(np.int64)]
        key = both >> np.uint64(_INDEX_BITS)
        heads[open_] = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order[open_]] = np.maximum.accumulate(np.where(heads[open_], open_, 0))
        reach *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place of the order, the bytes shared with the one before, up to ``most``.

    Kasai's bound: a string shares at most one byte less than the string one place
    to the left. Places are done in rounds, each halfway between those of the round
    before, from where the bound lets them start; eight bytes are compared at a time.
    """
    n = len(data)
    padded = np.concatenate((data, np.zeros(most + 16, np.uint8)))
    eight = np.zeros(n + most + 8, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + n + most + 8]
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)

    def extend(at: np.ndarray, known: np.ndarray) -> None:
        at, known = at[before[at] >= 0], known[before[at] >= 0]
        shared[at] = known
        while len(at):
            apart = eight[at + known] ^ eight[before[at] + known]
            ends = apart != 0
            rest = apart[ends]
            same = np.zeros(len(rest), np.int64)
            for k in range(1, 8):
                same += rest < np.uint64(1 << (64 - 8 * k))
            shared[at[ends]] = np.minimum(known[ends] + same, most)
            goes_on = ~ends & (known + 8 < most)
            full = ~ends & ~goes_on
            shared[at[full]] = most
            at, known = at[goes_on], known[goes_on] + 8

    step = 256
    first = np.arange(0, n, step)
    extend(first, np.zeros(len(first), np.int64))
    while step > 1:
        half = step // 2
        at = np.arange(half, n, step)
        extend(at, np.maximum(shared[at - half] - half, 0))
        step = half
    return shared[order]


def repeated_windows(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of some stretches, by suffix array: their places, a class of equal windows for each, and the class sizes.

    A place counts bytes of the stretches one after the other.
    """
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    whole = np.arange(len(data)) + length <= np.repeat(ends, sizes)
    order = suffix_array(data)
    shared = common_prefixes(data, order, length)
    groups = np.cumsum(shared < length)
    inside = whole[order]
    place, group = order[inside], groups[inside]
    if not len(place):
        return place, group, group
    group = np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))
    return place, group, np.bincount(group)


# --- from stretches to removed bytes


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def _print(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little")


def compare_shards(parts: DataFrame, length: int, shard_bytes: int, lots: int) -> DataFrame:
    """Repeated ranges among the stretches of each anchor, and what split anchors send to be merged.

    ``parts``: ``anchor``, ``split``, ``node``, ``low``, ``bytes``; rows of an anchor that is not split
    follow one another in one task. The windows of a shard of a split anchor are sent as
    ``lots`` sorted lists of fingerprints, with the place of those that it holds once.
    """

    def compare(held: list[tuple], split: bool) -> Iterator[tuple]:
        nodes, lows = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
        data = [h[2] for h in held]
        starts = np.cumsum([0, *map(len, data)])[:-1]
        place, group, count = repeated_windows(data, length)
        owner = np.searchsorted(starts, place, "right") - 1
        at = lows[owner] + place - starts[owner]
        twice = count[group] > 1
        if twice.any():
            found = _merged(nodes[owner[twice]], at[twice], at[twice] + length)
            yield from ((*f, None, None, None) for f in found)
        if split:
            heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            offsets = place[heads] - starts[owner[heads]]
            prints = np.array(
                [_print(data[o][p : p + length]) for o, p in zip(owner[heads].tolist(), offsets.tolist(), strict=True)], np.uint64
            )
            where = np.stack((np.where(twice[heads], -1, nodes[owner[heads]]), at[heads]), axis=1)
            order = np.argsort(prints, kind="stable")
            prints, where = prints[order], where[order]
            edges = np.array([(1 << 64) * k // lots for k in range(1, lots)], np.uint64)
            cuts = [0, *np.searchsorted(prints, edges).tolist(), len(prints)]
            for lot, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if a < b:
                    yield None, None, None, lot, prints[a:b].tobytes(), where[a:b].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None

        def shard() -> Iterator[pa.RecordBatch]:
            out = list(compare(held, now[1]))
            if out:
                yield _batch(out, _REPEATED)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("anchor", "split", "node", "low", "bytes")]
            for anchor, split, node, low, data in zip(*columns, strict=True):
                if held:
                    other = anchor != now[0]
                    full = size + len(data) > shard_bytes if now[1] else other and size > shard_bytes // 2
                    if full or (other and (split or now[1])):
                        yield from shard()
                        held, size = [], 0
                held.append((node, low, data))
                size, now = size + len(data), (anchor, split)
        if held:
            yield from shard()

    return map_arrow(parts, run, _REPEATED)


def merge_shards(lists: DataFrame, length: int, lots: int) -> DataFrame:
    """Ranges of the windows that several shards of an anchor hold: sorted lists of a lot, searched for what recurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for prints, places in zip(batch["prints"].to_pylist(), batch["places"].to_pylist(), strict=True):
                held.append((np.frombuffer(prints, np.uint64), np.frombuffer(places, np.int64).reshape(-1, 2)))
        if not held:
            return
        every = np.sort(np.concatenate([prints for prints, _ in held]))
        several = np.unique(every[1:][every[1:] == every[:-1]])
        for prints, places in held if len(several) else []:
            at = np.minimum(np.searchsorted(several, prints), len(several) - 1)
            hit = places[(several[at] == prints) & (places[:, 0] >= 0)]
            if len(hit):
                found = _merged(hit[:, 0], hit[:, 1], hit[:, 1] + length)
                yield _batch([(*f, None, None, None) for f in found], _REPEATED)

    return map_arrow(lists.repartitionById(lots, "lot").select("prints", "places"), run, _REPEATED)


_RANGES = "array<struct<low:bigint,high:bigint>>"


def _merge_lists(rows: DataFrame) -> DataFrame:
    """``row`` and its ``ranges``, merged where they touch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ranges in batch["ranges"].to_pylist():
                low, high = (np.array([r[k] for r in ranges], np.int64) for k in ("low", "high"))
                out.append([{"low": a, "high": b} for a, b in zip(*(c.tolist() for c in _union(low, high)), strict=True)])
            kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(out, kind)], ["row", "ranges"])

    listed = rows.groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))  # at most a few per stretch of a text
    return map_arrow(listed, run, f"row long, ranges {_RANGES}")


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut_out(rows: DataFrame, text_too: bool) -> DataFrame:
    """Results for rows of ``doc_id``, ``text`` and ``ranges`` (null: none)."""
    shape = _RESULT + (", kept string" if text_too else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            out = []
            for text, ranges in zip(piece["text"].to_pylist(), piece["ranges"].to_pylist(), strict=True):
                data, ranges = text.encode(), ranges or []
                cuts = [0, *(x for r in ranges for x in (r["low"], r["high"])), len(data)]
                left = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                result = (len(data), len(data) - len(left), len(ranges), hashlib.sha256(left).hexdigest())
                out.append((*result, left.decode(errors="replace")) if text_too else result)
            batch = _batch(out, shape)
            yield pa.RecordBatch.from_arrays([piece["doc_id"], *batch.columns], ["doc_id", *batch.schema.names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows.select("doc_id", "text", "ranges"), run, f"doc_id {kind}, {shape}")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, text_too: bool = False
) -> DataFrame:
    """Every row's ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept_sha256``.

    With ``text_too`` also ``kept``, the remaining bytes as text (a character cut
    in two shows as the replacement character). ``gram`` is a power of two, at most
    ``length``; ``shard_bytes`` is at most 2^20. A null text is empty. Repeated rows are
    places of their own: each repeats the other. Texts shorter than ``length`` stay
    whole. Only ``doc_id`` and ``text`` are read. An empty table gives an empty table.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = pin(find_stretches(rows, length, gram), "suffix-stretches")
    ids = found.where(F.col("text_hash").isNotNull()).select("row", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    known = found.where(F.col("anchor").isNotNull())

    # equal stretches fold into one
    first = F.min(F.struct("row", "low", "high")).alias("first")
    folded = known.groupBy("anchor", "digest").agg(((F.count(F.lit(1)) > 1) | F.max("again")).alias("twice"), first)
    kinds = pin(folded.select("anchor", "digest", "twice", "first.*"), "suffix-kinds")
    twice = kinds.where("twice").select("anchor", "digest")
    end = (F.col("high") + length).alias("high")
    gone = known.join(_maybe_broadcast(twice), ["anchor", "digest"]).select("row", "low", end)
    gone = gone.unionByName(found.where("anchor IS NULL AND low IS NOT NULL").select("row", "low", "high"))

    # different stretches round one anchor meet in shards
    size = F.sum(F.col("high") - F.col("low") + length).alias("size")
    several = pin(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), size).where("n > 1").drop("n"), "suffix-anchors")
    split_bytes = several.where(F.col("size") > shard_bytes).agg(F.sum("size")).first()[0] or 0
    lots = max(1, -(-split_bytes // RANGE_WINDOWS))
    wanted = kinds.join(_maybe_broadcast(several), "anchor").select(
        "row", F.struct("row", "anchor", (F.col("size") > shard_bytes).alias("split"), F.ceil(F.col("size") / shard_bytes).alias("shards"), "low", end).alias("part")
    )
    by_text = wanted.join(ids, "row").groupBy("_id", "_hash").agg(F.collect_list("part").alias("parts"))  # of one text
    by_text = pin(by_text, "suffix-wanted")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    parts = texts.join(_maybe_broadcast(by_text), same).select(F.col("text").cast("binary").alias("_data"), F.inline("parts")).select(
        "anchor", "split", F.col("row").alias("node"), "low", F.expr("substring(_data, int(low) + 1, int(high - low))").alias("bytes"),
        F.when(F.col("split"), F.pmod(F.xxhash64("row", "low"), "shards")).otherwise(0).alias("shard"),
    )
    dealt = parts.repartition("anchor", "shard").sortWithinPartitions("split", "anchor", "shard", "node", "low").drop("shard")
    met = pin(compare_shards(dealt, length, shard_bytes, lots), "suffix-met")
    ranges = gone.unionByName(met.where(F.col("node").isNotNull()).select(F.col("node").alias("row"), "low", "high"))
    if split_bytes:
        merged = merge_shards(met.where(F.col("lot").isNotNull()), length, lots)
        ranges = ranges.unionByName(merged.select(F.col("node").alias("row"), "low", "high"))

    # equal rows have equal ranges: all of their text
    removed = pin(_merge_lists(ranges).join(ids, "row").dropDuplicates(["_id", "_hash"]).select("_id", "_hash", "ranges"), "suffix-ranges")
    return _cut_out(texts.join(_maybe_broadcast(removed), same, "left"), text_too)
