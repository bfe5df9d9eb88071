"""Words of Arrow text columns as arrays: boundaries and 64-bit hashes.

A word is a run of bytes that are not blanks (0x20 and 0x09 to 0x0D), so words
of the UTF-8 bytes are words of the text. All work is done on whole Arrow
buffers with numpy; no Python object is made per word.

Two different words share a hash with a chance of about 2^-64. Operators that
compare hashes instead of words rely on this.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 4 << 20
_HASH_BYTES = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
NOT_BLANK = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Lower-cases A to Z and nothing else.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

# Odd 64-bit multipliers of the splitmix finaliser, and the base
# of the polynomial word hash.
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Texts:
    """The bytes of some rows, and where each row starts (one more offset than rows)."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of some rows: byte ranges, and per row the first word (one more than rows)."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES):
    """Cut batches at rows so that the texts of a piece have about ``limit`` bytes.

    A longer text is a piece of its own: texts are never cut.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = texts_of(batch[column]).offsets
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def texts_of(column: pa.Array) -> Texts:
    """The buffers of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def find_words(texts: Texts) -> Words:
    inside = NOT_BLANK[texts.data]
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(texts.offsets), np.int64))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # a row's first and last byte bound a word whatever the neighbour row has
    filled = texts.offsets[1:] > texts.offsets[:-1]
    heads, tails = texts.offsets[:-1][filled], texts.offsets[1:][filled] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(start, texts.offsets))


def hash_words(data: np.ndarray, words: Words, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes, after lower-casing A to Z if asked for."""
    out = np.empty(len(words.start), np.uint64)
    begin, total = 0, len(words.start)
    while begin < total:
        end = int(np.searchsorted(words.start, words.start[begin] + _HASH_BYTES, "left"))
        out[begin:end] = hash_ranges(data, words.start[begin:end], words.end[begin:end], lower)
        begin = end
    return out


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each range of bytes. No range may be empty."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    ahead = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(ahead, length)
    raw = data[place + np.repeat(start, length)]
    value = (LOWER[raw] if lower else raw).astype(np.uint64)
    value += np.uint64(1)
    value *= _powers(int(length.max()))[place]
    return mix(np.add.reduceat(value, ahead))


def ngram_hashes(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``n`` words inside each row, and the rows' bounds in them."""
    counts = np.diff(bounds)
    held = np.maximum(counts - n + 1, 0)
    ahead = np.concatenate(([0], np.cumsum(held)))
    at = np.arange(int(ahead[-1])) + np.repeat(bounds[:-1] - ahead[:-1], held)
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = mix(out * _BASE + hashes[at + k])
    return out, ahead


def hash_sequences(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per row of its whole word sequence; 0 for rows without words."""
    counts = np.diff(bounds)
    place = np.arange(len(hashes)) - np.repeat(bounds[:-1], counts)
    value = mix(hashes + mix(place.astype(np.uint64) + _BASE))
    return mix(row_sums(value, bounds))


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values of each row; 0 for rows without any."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    filled = bounds[1:] > bounds[:-1]
    if filled.any():
        out[filled] = np.add.reduceat(values, bounds[:-1][filled])
    return out
