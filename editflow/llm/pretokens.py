"""Splitting text into the pre-tokens of byte-level BPE, a block at a time.

The public pattern of byte-level BPE tokenizers is

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Its matches follow from the classes of neighbouring characters, so that they
can be found for all characters of a block at once: a pre-token begins where
the class changes; the last blank of a run that other characters follow leaves
its run, and joins them if it is a space; an apostrophe takes the letters of a
contraction.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from .text import BLOCK_BYTES, equal_spans, span_hashes

OTHER, LETTER, NUMBER, BLANK = range(4)
_classes: np.ndarray | None = None


def character_classes() -> np.ndarray:
    """The class of every code point."""
    global _classes
    if _classes is None:
        everything = "".join(map(chr, range(0x110000)))
        table = np.zeros(0x110000, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, everything):
                table[m.start() : m.end()] = kind
        _classes = table
    return _classes


def pretoken_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens in bytes, and for each row the number of its first (one more at the end)."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    row_start = np.zeros(n + 3, bool)
    row_start[np.searchsorted(place, rows)] = True
    row_start[n:] = True
    kind = character_classes()[points]
    start = row_start[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = kind == BLANK
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~row_start[1:n])
    start[last] = True
    start[last[points[last] == 32] + 1] = False

    quote = np.flatnonzero((points == 39) & start & ~row_start[1 : n + 1])
    padded = np.concatenate([points, np.zeros(3, np.uint32)])
    one, two = padded[quote + 1], padded[quote + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & ~row_start[quote + 2]
    start[quote[short | long] + 1] = False
    after = np.concatenate([quote[short] + 2, quote[long] + 3])
    start[after[after < n]] = True

    starts = place[np.flatnonzero(start)]
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, rows)


class PieceIds:
    """The ids of pre-tokens, kept by their hash in sorted arrays between blocks.

    A hash only says where to look: every pre-token is compared byte by byte
    with the kept one, and one that differs is encoded by itself, so ids never
    hang on a hash.  At most ``limit`` pre-tokens are kept, about 50 bytes each;
    then it starts anew, which bounds memory and never changes a result.
    """

    def __init__(self, encode: Callable[[list[bytes], np.ndarray], list], limit: int = 1 << 19):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.begin, self.end, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(pieces, all their ids, number of ids of each)."""
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        found = self.encode(pieces, keys)
        size = np.fromiter(map(len, found), np.int32, len(found))
        return pieces, np.fromiter((i for x in found for i in x), np.uint32, int(size.sum())), size

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens in a row, number of ids of each)."""
        hashes = span_hashes(data, starts, ends)
        key, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(key) > self.limit:
            self._clear()
        place = np.searchsorted(self.keys, key)
        known = np.zeros(len(key), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == key[inside]
        new = np.flatnonzero(~known)
        if len(new):
            pieces, ids, size = self._encode(data, starts[sample[new]], ends[sample[new]], key[new])
            at = np.cumsum(size, dtype=np.int64) - size + len(self.ids)
            self.ids = np.concatenate([self.ids, ids])
            width = ends[sample[new]] - starts[sample[new]]
            end = np.cumsum(width) + len(self.bytes)
            self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(pieces), np.uint8)])
            to = np.searchsorted(self.keys, key[new])
            grown = ((self.keys, key[new]), (self.at, at), (self.size, size), (self.begin, end - width), (self.end, end))
            self.keys, self.at, self.size, self.begin, self.end = (np.insert(a, to, b) for a, b in grown)
            place = np.searchsorted(self.keys, key)
        # pieces of a block equal their sample, and the sample the kept piece, or they are encoded by themselves
        sound = equal_spans(data, starts[sample], ends[sample], self.bytes, self.begin[place], self.end[place])
        alike = equal_spans(data, starts, ends, data, starts[sample][which], ends[sample][which]) & sound[which]
        at, size, pool = self.at[place][which], self.size[place][which].astype(np.int64), self.ids
        apart = np.flatnonzero(~alike)
        if len(apart):
            _, ids, own = self._encode(data, starts[apart], ends[apart], hashes[apart])
            at[apart], size[apart] = np.cumsum(own) - own + len(pool), own
            pool = np.concatenate([pool, ids])
        total = int(size.sum())
        flat = np.arange(total) + np.repeat(at - (np.cumsum(size) - size), size)
        return pool[flat], size


def row_chunks(data: np.ndarray, limit: int = 4 * BLOCK_BYTES):
    """Cut the bytes of one long row where a pre-token must begin: before a space or line end that follows an ASCII letter or digit."""
    if len(data) <= limit:
        yield data
        return
    word = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 48) & (data <= 57)
    safe = np.flatnonzero(((data[1:] == 32) | (data[1:] == 10)) & word[:-1]) + 1
    at = 0
    while at < len(data):
        k = np.searchsorted(safe, at + limit)
        to = int(safe[k]) if k < len(safe) else len(data)
        yield data[at:to]
        at = to


def encode_block(block, ids_of: PieceIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows of a block, number of ids of each row)."""
    if block.n == 1 and len(block.data) > 4 * BLOCK_BYTES:
        parts = []
        for part in row_chunks(block.data):
            starts, ends, _ = pretoken_spans(part, np.array([0, len(part)]))
            parts.append(ids_of(part, starts, ends)[0])
        ids = np.concatenate(parts)
        return ids, np.array([len(ids)])
    starts, ends, first = pretoken_spans(block.data, block.rows)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(block.n, np.int64)
    ids, size = ids_of(block.data, starts, ends)
    upto = np.concatenate([[0], np.cumsum(size)])
    return ids, np.diff(upto[first])
