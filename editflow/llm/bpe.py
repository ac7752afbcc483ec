"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is a word of the vocabulary is resolved by a minimal perfect
hash over all words (hash and displace), for all pre-tokens of a block at once.
A miss is merged by a heap of ranked pairs over a linked list of its bytes.
The vocabulary is a bounded table; it is read on the driver and broadcast.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import PieceIds, encode_block
from .text import binary_column, blocks, mix, span_hashes

_U = np.uint64


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of lines `base64 rank`."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: slot_of maps the n keys one to one to 0..n-1.

    Buckets of about four keys are placed largest first; each takes the first
    displacement that sends its keys to free slots.
    """

    def __init__(self, keys: np.ndarray, per_bucket: int = 4):
        n = len(keys)
        if len(np.unique(keys)) != n:
            raise ValueError("keys must be distinct")
        self.n, self.buckets = n, max(1, n // per_bucket)
        self.displacement = np.zeros(self.buckets, np.uint32)
        bucket = (keys % _U(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=self.buckets)
        begin = np.cumsum(size) - size
        free = np.ones(n, bool)
        for b in np.argsort(-size, kind="stable"):
            mine = keys[order[begin[b] : begin[b] + size[b]]]
            if not len(mine):
                break
            at, width = 0, 64
            while True:
                tries = np.arange(at, at + width, dtype=np.uint64)
                slots = self._slots(mine[None, :], tries[:, None])
                good = free[slots].all(1)
                if len(mine) > 1:
                    s = np.sort(slots, 1)
                    good &= (s[:, 1:] != s[:, :-1]).all(1)
                if good.any():
                    k = int(good.argmax())
                    self.displacement[b] = at + k
                    free[slots[k]] = False
                    break
                at, width = at + width, min(width * 4, 1 << 16)

    def _slots(self, keys: np.ndarray, displacement: np.ndarray) -> np.ndarray:
        return (mix(keys ^ mix(displacement + _U(0x9E3779B97F4A7C15))) % _U(self.n)).astype(np.int64)

    def slot_of(self, keys: np.ndarray) -> np.ndarray:
        return self._slots(keys, self.displacement[(keys % _U(self.buckets)).astype(np.int64)].astype(np.uint64))


class Vocabulary:
    """Words by id, and ids by the two tiers."""

    def __init__(self, ranks: dict[bytes, int]):
        words = sorted(ranks, key=ranks.__getitem__)
        self.ranks = ranks
        self.ids = np.array([ranks[w] for w in words], np.uint32)
        size = np.array([len(w) for w in words], np.int64)
        self.blob = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(size)
        keys = span_hashes(self.blob, ends - size, ends)
        self.hash = PerfectHash(keys)
        slot = self.hash.slot_of(keys)
        self.key_at, self.id_at = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint32)
        self.key_at[slot], self.id_at[slot] = keys, self.ids
        self.begin, self.size = np.zeros(int(self.ids.max()) + 1, np.int64), np.zeros(int(self.ids.max()) + 1, np.int64)
        self.begin[self.ids], self.size[self.ids] = ends - size, size

    def encode_pieces(self, pieces: list[bytes], keys: np.ndarray) -> list:
        """The ids of each piece; keys are the pieces' hashes."""
        slot = self.hash.slot_of(keys)
        hit = self.key_at[slot] == keys
        ids = self.id_at[slot]
        return [(i,) if h and self.ranks.get(p) == i else merge_bytes(p, self.ranks) for p, h, i in zip(pieces, hit.tolist(), ids.tolist())]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all rows, number of bytes of each)."""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.arange(int(size.sum())) + np.repeat(self.begin[ids] - (ends - size), size)
        upto = np.concatenate([[0], ends])
        return self.blob[at], np.diff(upto[np.concatenate([[0], np.cumsum(counts)])])


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE of one piece: the pair of lowest rank, leftmost first, is merged until none is in the vocabulary."""
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    get = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = after[i] if end[i] else n
        if j >= n or end[j] != to:
            continue  # one of the two has been merged since
        end[i], end[j] = to, 0
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if (h := before[i]) >= 0 and (r := get(piece[h:to])) is not None:
            heapq.heappush(heap, (r, h, to))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


_kept: dict[int, PieceIds] = {}


def bpe_encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_tokens, ids): ids as little-endian unsigned 32-bit integers in one binary.

    Every whole text is encoded, without special tokens; null and empty texts
    have no ids.  Repeated rows are encoded each; extra columns are not read.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(ranks_path)))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        ids_of = _kept.get(id(words)) or _kept.setdefault(id(words), PieceIds(words.encode_pieces))
        for batch in batches:
            for block in blocks(batch.column(1)):
                ids, counts = encode_block(block, ids_of)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), pa.array(counts.astype(np.int64)), binary_column(ids.astype("<u4"), counts)], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(encode, schema)


def bpe_decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """The rows of encoded with a binary column `decoded`; null ids decode to no bytes.  The inverse of bpe_encode."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(ranks_path)))
    place = encoded.columns.index(ids_col)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        for batch in batches:
            at = 0
            raw = [x.as_py() or b"" for x in batch.column(place)]
            while at < len(raw):
                to, size = at, 0
                while to < len(raw) and (to == at or size < 1 << 22):
                    size += len(raw[to])
                    to += 1
                counts = np.array([len(x) // 4 for x in raw[at:to]], np.int64)
                data, sizes = words.decode(np.frombuffer(b"".join(raw[at:to]), "<u4"), counts)
                yield pa.RecordBatch.from_arrays([*(c.slice(at, to - at) for c in batch.columns), binary_column(data, sizes)], names=schema.names)
                at = to

    return encoded.mapInArrow(decode, schema)
