"""Array kernels over the UTF-8 buffers of Arrow string columns.

Python operators of this subpackage see their rows as Arrow batches.  These
helpers turn a string column into blocks of bytes and compute words, hashes of
words and hashes of word shingles for a whole block with numpy, so that no
per-word Python object is made and memory is bounded by the block and not by
the batch.  A row is never cut: a row longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are worked on at once.
BLOCK_BYTES = 1 << 20

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

#: ASCII white space: space, and tab to carriage return.
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
#: Maps A-Z to a-z and every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche 64-bit values (the finaliser of the splitmix64 generator)."""
    x = (x ^ (x >> _U(30))) * _U(_M1)
    x = (x ^ (x >> _U(27))) * _U(_M2)
    return x ^ (x >> _U(31))


#: Spans longer than this many bytes are hashed one by one.
_LONG_SPAN = 1024
#: Masks that keep the first 0 to 8 bytes of a little-endian word.
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def _words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place of data on as one number, with zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends], which depend on their bytes alone.

    Up to 7 bytes are hashed one to one.  Longer spans go through two lanes of
    different mixing, 8 bytes a step for all of them at once, that are folded at
    the end, so that no step can be undone within one lane.  Two given spans
    agree by chance once in 2**64; where a result must not hang on that, compare
    bytes with equal_spans.
    """
    size = ends - starts
    at = _words_at(data)
    out = mix((at[starts] & _KEEP[np.minimum(size, 7)]) | (np.minimum(size, 7).astype(np.uint64) << _U(56)))
    index = np.flatnonzero((size > 7) & (size <= _LONG_SPAN))
    a = size[index].astype(np.uint64) * _U(_STEP) + _U(_M2)
    b = a ^ _U(_M1)
    place, left = starts[index], size[index]
    while len(index):
        c = at[place] & _KEEP[np.minimum(left, 8)]
        a = mix(a ^ c)
        b = ((b << _U(29)) | (b >> _U(35))) * _U(_STEP) + c * _U(_M2 | 1)
        b ^= b >> _U(31)
        left = left - 8
        done = left <= 0
        if done.any():
            out[index[done]] = mix(a[done] + mix(b[done] ^ _U(_STEP)))
            index, place, left, a, b = (x[~done] for x in (index, place, left, a, b))
        place = place + 8
    for i in np.flatnonzero(size > _LONG_SPAN).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), 1)
    return out


def equal_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether each span of data has the bytes of the span of other at the same index."""
    size = ends - starts
    same = size == other_ends - other_starts
    x, y = _words_at(data), _words_at(other)
    index = np.flatnonzero(same & (starts != other_starts)) if data is other else np.flatnonzero(same)
    p, q, left = starts[index], other_starts[index], size[index]
    while len(index):
        alike = ((x[p] ^ y[q]) & _KEEP[np.minimum(left, 8)]) == 0
        same[index[~alike]] = False
        go = alike & (left > 8)
        index, p, q, left = index[go], p[go] + 8, q[go] + 8, left[go] - 8
    return same


@dataclass
class Block:
    """Rows first .. first+len(rows)-2 of a batch; row i is data[rows[i]:rows[i+1]]."""

    first: int
    data: np.ndarray
    rows: np.ndarray

    @property
    def n(self) -> int:
        return len(self.rows) - 1


def blocks(column: pa.Array | pa.ChunkedArray, limit: int | None = None) -> Iterator[Block]:
    """Blocks of whole rows with about ``limit`` bytes; a null counts as the empty text."""
    limit = limit or BLOCK_BYTES
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "")
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, len(column))
        yield Block(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def word_spans(data: np.ndarray, rows: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the number of its first word (one more at the end)."""
    gap = separator[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = gap[:-1] | gap[1:]
    edge[rows] = True
    # an edge lies before byte i; a word starts at an edge before a byte that is not a separator
    starts = np.flatnonzero(edge[:-1] & ~gap)
    ends = np.flatnonzero(edge[1:] & ~gap) + 1
    return starts, ends, np.searchsorted(starts, rows)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every k-word shingle; a row of 1 to k-1 words has its whole sequence as one shingle."""
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1], n)
    long = counts[row] >= k
    out = np.zeros(len(row), np.uint64)
    factor = _STEP
    for j in range(k):
        inside = long | (j < counts[row])
        part = words[np.minimum(at + j, max(len(words) - 1, 0))] if len(words) else out
        out += np.where(inside, part * _U(factor | 1), _U(0))
        factor = factor * _M1 % (1 << 64)
    out += np.where(long, _U(k), counts[row].astype(np.uint64))
    return row, mix(out)


def distinct_in_rows(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, value) pairs, sorted by row and then value."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[keep], value[keep]


def binary_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary per row: the bytes of its share of values."""
    width = values.dtype.itemsize
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * width
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), data]).cast(pa.binary())
