"""How quality filters overlap: what each of five filters removes, in every order they can run in.

Four filters look at one text; the fifth asks whether another document has the
same text. For that, texts are dealt to tasks by ranges whose bounds are
prefixes just long enough to tell neighbours apart, and each task inserts its
texts into a radix trie: edges hold runs of bytes, terminals the least id. A
document repeats a smaller one if its id is above the least at its terminal.

A task first builds tries over its own rows and sends each different text once,
with its least id, so a text that a third of all rows hold leaves a task as one
row. What filters do then depends on a document's five flags alone: rows are
counted by part and flags, and every figure follows from how many documents
fail none of a set of filters.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations
from math import factorial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shipping import map_arrow
from .words import PIECE_BYTES, Texts, find_words, hash_words, pieces, row_sums, texts_of

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
SPECIAL = b"#$%&*|"
REPEATED = 16
ALL = (1 << len(FILTERS)) - 1

RANGE_BYTES = 128 << 20
#: Texts looked at per range to place its bounds. Bounds balance tasks; results don't depend on them.
SAMPLES = 8
TRIE_BYTES = 8 * PIECE_BYTES

_BYTES = np.arange(256)
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_SPECIAL = np.isin(_BYTES, list(SPECIAL))


def _shared(a: bytes, at: int, b: bytes) -> int:
    """How many bytes ``b`` shares with ``a`` from ``at`` on."""
    if a.startswith(b, at):
        return len(b)
    low, high = 0, min(len(a) - at, len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a.startswith(b[:middle], at) else (low, middle - 1)
    return low


class Trie:
    """A radix trie over whole texts; terminals are numbered from 0 and hold the least id given for their text."""

    def __init__(self):
        self.root: dict[int, list] = {}
        self.least: list = []
        self.top: int | None = None  # terminal of the empty text

    def insert(self, text: bytes, key) -> int:
        at, children = 0, self.root
        if not text:
            if self.top is None:
                self.top = self._terminal()
            return self._lower(self.top, key)
        while True:
            node = children.get(text[at])
            if node is None:
                number = self._terminal()
                children[text[at]] = [text[at:], number, {}]
                return self._lower(number, key)
            label = node[0]
            same = _shared(text, at, label)
            if same < len(label):
                # the edge parts here: its rest hangs below a new node
                node[:] = [label[:same], None, {label[same]: [label[same:], node[1], node[2]]}]
            at += same
            if at == len(text):
                if node[1] is None:
                    node[1] = self._terminal()
                return self._lower(node[1], key)
            children = node[2]

    def _terminal(self) -> int:
        self.least.append(None)
        return len(self.least) - 1

    def _lower(self, number: int, key) -> int:
        if key is not None and (self.least[number] is None or key < self.least[number]):
            self.least[number] = key
        return number


def text_flags(texts: Texts) -> np.ndarray:
    """For each row a bit per filter that looks at the text alone: A is 1, B 2, C 4, D 8."""
    words = find_words(texts)
    hashes, bounds, counts = hash_words(texts.data, words, lower=False), words.bounds, words.counts
    distinct = np.array([len(np.unique(hashes[bounds[k] : bounds[k + 1]])) for k in range(len(texts))], np.int64)

    def number(mask: np.ndarray) -> np.ndarray:
        return row_sums(mask.astype(np.int32), texts.offsets).astype(np.int64)

    points = number((texts.data & 0xC0) != 0x80)
    fails = [
        counts < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * counts,
        100 * number(_CAPITAL[texts.data]) > MOST_CAPITALS * points,
        number(_SPECIAL[texts.data]) > 0,
    ]
    return sum(f.astype(np.int64) << k for k, f in enumerate(fails))


def range_bounds(texts: DataFrame, ranges: int, total: int) -> list[bytes]:
    """Up to ``ranges`` - 1 prefixes that cut the distinct texts into ranges of about equal size.

    Some ``SAMPLES`` different texts a range are looked at, long ones more likely. Each bound
    is the shortest prefix that its text does not share with the text before it.
    """
    gap = max(1, total // (ranges * SAMPLES))
    chance = F.shiftrightunsigned(F.xxhash64("text"), 1) / F.lit(float(1 << 63))
    seen = texts.where(chance < F.octet_length("text") / F.lit(float(gap))).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before = None, None
        for batch in batches:
            found = []
            for text in batch["text"]:
                text = text.as_py().encode()
                # a task with few texts gives a bound as often as its share of them asks for
                number = crc32(text) % SAMPLES if number is None else number
                if number % SAMPLES == 0 and before is not None:
                    found.append(text[: _shared(text, 0, before) + 1])
                number, before = number + 1, text
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["bound"])

    laid_out = seen.repartitionByRange("text").sortWithinPartitions("text")
    # one short prefix per range of RANGE_BYTES comes to the driver
    return sorted({bytes(r["bound"]) for r in map_arrow(laid_out, cut, "bound binary").collect()})


def flag_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``flags`` and ``n``: how many rows of an id and part have these flags, E's bit included."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    given = spark.sparkContext.broadcast(range_bounds(rows.select("text"), ranges, total))
    shape = pa.schema([*zip(("place", "part", "flags", "n", "text"), (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = given.value
        trie, held, size, turn = Trie(), [], 0, 0

        def flush() -> pa.RecordBatch:
            """Of each text's least id, one row per part with the text; other rows are repeats already."""
            nonlocal turn
            ids, out, unsure = [], [], {}
            for number, key, part, flags, text in held:
                if key is not None and key == trie.least[number]:
                    first = unsure.setdefault((number, part), [key, flags, text, 0])
                    first[3] += 1
                else:
                    ids.append(key)
                    out.append((turn % ranges, part, flags if key is None else flags | REPEATED, 1, None))
                    turn += 1
            for (_, part), (key, flags, text, n) in unsure.items():
                ids.append(key)
                out.append((bisect_right(bounds, text), part, flags, n, text))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), shape.types, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], ["doc_id", *shape.names])

        for piece in pieces(batches):
            id_type, texts = piece["doc_id"].type, texts_of(piece["text"])
            raw, at = texts.data.tobytes(), texts.offsets.tolist()
            marks = text_flags(texts).tolist()
            for k, (key, part) in enumerate(zip(piece["doc_id"].to_pylist(), piece["part"].to_pylist(), strict=True)):
                text = raw[at[k] : at[k + 1]]
                held.append((trie.insert(text, key), key, part, marks[k], text))
            size += len(raw)
            if size > TRIE_BYTES:
                yield flush()
                trie, held, size = Trie(), [], 0
        if held:
            yield flush()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, names = Trie(), [], ["doc_id", "part", "flags", "n"]
        for batch in batches:
            sure = batch["text"].is_null()
            yield batch.filter(sure).select(names)
            rest = batch.filter(pa.compute.invert(sure))
            keys = rest["doc_id"].to_pylist()
            numbers = [trie.insert(t.as_py(), k) for t, k in zip(rest["text"], keys, strict=True)]
            held.append((rest.select(names), keys, numbers))
        for rest, keys, numbers in held:
            again = np.array([k > trie.least[t] for k, t in zip(keys, numbers, strict=True)], np.int32)
            flags = rest["flags"].to_numpy() | (again * REPEATED)
            yield pa.RecordBatch.from_arrays([rest["doc_id"], rest["part"], pa.array(flags, pa.int32()), rest["n"]], names)

    sent = map_arrow(rows, send, f"doc_id {kind}, place int, part string, flags int, n long, text binary")
    return map_arrow(
        sent.repartitionById(ranges, "place"), settle, f"doc_id {kind}, part string, flags int, n long"
    )


def _steps() -> str:
    """Every order of the filters and step of it: letter's bit, and the filters before and after the step."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            out.append({"filter_order": "".join(FILTERS[j] for j in order), "step": step, "bit": 1 << k, "before": before, "after": before | 1 << k})
            before |= 1 << k
    return json.dumps(out)


def _removed_in_all_orders(k: int) -> str:
    """SQL: what filter ``k`` removes, summed over all orders, from ``kept`` (documents that fail none of a set)."""
    last, bit = len(FILTERS) - 1, 1 << k
    terms = [
        f"{factorial(s.bit_count()) * factorial(last - s.bit_count())} * (kept[{s}] - kept[{s | bit}])"
        for s in range(ALL + 1) if not s & bit
    ]
    return " + ".join(terms)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with what the step's filter removes.

    ``part`` is the source; a null source is the empty string. A null text is
    empty. A null ``doc_id`` is no smaller than any, so E neither removes it nor
    anything for it, and it has no label. Repeated rows count each; an id is good
    or toxic if any of its labels says so. Other columns are not read. An empty
    table gives an empty table.
    """
    flagged = flag_documents(docs).groupBy("doc_id", "part", "flags").agg(F.sum("n").alias("n"))
    judged = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )

    def marked(column: str) -> Column:
        return F.sum(F.col("n") * F.coalesce(column, F.lit(0))).alias(column)

    counted = flagged.join(judged, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "flags").agg(
        F.sum("n").alias("n"), marked("good"), marked("toxic")
    )
    sets = counted.withColumn("s", F.explode(F.expr(f"filter(sequence(0, {ALL}), s -> (s & flags) = 0)")))
    sums = sets.groupBy("part", "s").agg(F.sum("n").alias("kept"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    # at most 32 sets of filters a part
    by_part = sums.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("s", F.struct("kept", "good", "toxic")))).alias("m"))
    lists = by_part.selectExpr(
        "part", *[f"transform(sequence(0, {ALL}), s -> coalesce(m[s].{c}, 0L)) AS {c}" for c in ("kept", "good", "toxic")]
    )
    with_shares = lists.selectExpr(
        "*", "map(" + ", ".join(f"{1 << k}, {_removed_in_all_orders(k)}" for k in range(len(FILTERS))) + ") AS shapley"
    )
    shape = "array<struct<filter_order:string,step:int,bit:int,before:int,after:int>>"
    return with_shares.select("*", F.inline(F.from_json(F.lit(_steps()), shape))).selectExpr(
        "part",
        "filter_order",
        "step",
        "kept[after] AS kept",
        "kept[before] - kept[after] AS removed",
        f"kept[0] - kept[bit] - (kept[before] - kept[after]) AS redundant",
        f"kept[{ALL} - bit] - kept[{ALL}] AS unique_fails",
        "good[before] - good[after] AS good_lost",
        "toxic[before] - toxic[after] AS toxic_lost",
        "shapley[bit] AS shapley",
    )
