"""Order-preserving packing: documents keep their order, and windows over their tokens are cut where it costs least.

The documents of a task, in the order in which their table gives them, are a
stream of tokens.  A sequence is a window of it.  Windows may end where a
document ends, for nothing, and where a sentence does, for a penalty; inside
long sentences there are places too, at a higher one.  With f(j) the least cost
of a packing that cuts at place j,

    f(j) = penalty(j) + min over i of f(i) + padding(j - i)

where a window of n tokens is padded to the capacity, and not at all if n is a
power of two.  The first part is f(i) + i, less j, over a window of i that
moves on with j: its minimum is the head of a monotone queue.  For the second
there is one i for each power of two.  A run takes constant time a place, and
ties go to the plan with fewer sequences.

The stream is planned in runs of some million tokens that end with a document,
so that a task's memory is bounded by a run, or by its longest document.
Nothing is shuffled; what a task returns depends on its own rows alone.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packing import byte_characters
from .pretokens import PieceIds
from .text import BLOCK_BYTES, WHITE, blocks, word_spans

_encoders: dict[str, PieceIds] = {}


@dataclass(frozen=True)
class Cuts:
    """What cuts cost, in tokens of padding, and where they may lie.

    A document's end costs nothing.  A sentence of more than ``long_sentence``
    tokens may be cut every ``grain`` tokens, and the last ``capacity`` tokens of a
    run anywhere, so that what is left can be dealt to powers of two.
    """

    sentence: int = 32
    inside: int = 256
    long_sentence: int = 256
    grain: int = 64
    run_tokens: int = 1 << 21


def _by_ranks(path: str) -> Callable[[str], list[int]] | None:
    """Ids of a pre-token by the ranks library, or None where the file's merges aren't in the order of the ids they make.

    A pre-token's end is written as a byte that no text has.  Its vocabulary's
    smallest ids are bytes, and then bytes with that end, so the end joins the last
    byte before anything else is merged, as it should.
    """
    with open(path) as f:
        model = json.load(f)["model"]
    end, vocab, byte_of = model.get("end_of_word_suffix") or "", model["vocab"], byte_characters()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab["".join(m)] for m in merges]
    single = {vocab.get(c + e) for c in byte_of for e in ("", end)}
    if not end or made != list(range(512, 512 + len(made))) or single != set(range(512)) or any(vocab[c] > 255 for c in byte_of):
        return None
    import tiktoken

    ranks = {}
    for t, i in vocab.items():
        body = t.removesuffix(end)
        if i > made[-1] or any(c not in byte_of for c in body):
            return None
        ranks[bytes(byte_of[c] for c in body) + b"\xff" * (body != t)] = i
    if len(ranks) != len(vocab):
        return None
    one = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    return lambda piece: one(piece.encode() + b"\xff")


#: What the fast way splits words by: the pattern of tokenizers that lower-case and drop white space.
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def word_encoder(path: str) -> PieceIds:
    """The ids of words between ASCII white space by a tokenizer that drops white space, made once in each worker.

    Such a tokenizer's normalisation and its splits never reach across white
    space, so a text's ids are those of its words in a row.  The strings of
    special tokens are ordinary text.  Words of code points below U+0250, none of
    which NFC changes and all but U+0130 with a lower case of one code point, go
    through the faster ranks library if the file is of that kind; others, and all
    words of other files, go to the tokenizer's own.
    """
    if path not in _encoders:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.encode_special_tokens = True
        with open(path) as f:
            parts = json.load(f)
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        usual = (parts.get("normalizer") or {}).get("normalizers") == _NORMAL and split[0].get("pattern") == {"Regex": _PRETOKEN.pattern} and len(split) == 2
        ranked = _by_ranks(path) if usual else None

        def encode(words: list[bytes], _: np.ndarray) -> list[list[int]]:
            out: list[list[int] | None] = []
            for word in words:
                text = word.decode()
                if ranked is None or not text.isascii() and (max(text) >= "\u0250" or "\u0130" in text) or not text.isprintable():
                    out.append(None)
                    continue
                text = text.lower()
                if text.isalpha():
                    out.append(ranked(text))
                else:
                    out.append([i for piece in _PRETOKEN.findall(text) for i in ranked(piece)])
            left = [i for i, ids in enumerate(out) if ids is None]
            for i, found in zip(left, whole.encode_batch_fast([words[i].decode() for i in left], add_special_tokens=False) if left else ()):
                out[i] = found.ids
            return out

        _encoders[path] = PieceIds(encode, 1 << 20)
    return _encoders[path]


_ALNUM, _SIGN = np.zeros(256, bool), np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_SIGN[[c for c in range(33, 127) if not _ALNUM[c] and c != 39]] = True


def _units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words cut before a sign, other than an apostrophe, that follows an ASCII letter or digit: a pre-token begins there, and there are fewer different units."""
    cut = np.flatnonzero(_ALNUM[data[:-1]] & _SIGN[data[1:]]) + 1
    return np.sort(np.concatenate([starts, cut]), kind="stable"), np.sort(np.concatenate([ends, cut]), kind="stable")


def _word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, encode: PieceIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in a row, how many there are up to the end of each)."""
    frm, to = _units(data, starts, ends)
    ids, size = encode(data, frm, to)
    return ids, np.cumsum(size)[np.searchsorted(to, ends)]


def _ends_sentence(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a word ends with . ! or ?, closing quotes and brackets aside, or is its line's last."""
    stop, closer = np.zeros(256, bool), np.zeros(256, bool)
    stop[[ord(c) for c in ".!?"]] = True
    closer[[ord(c) for c in "\"')]}"]] = True
    last = data[ends - 1]
    before = data[np.maximum(ends - 2, starts)]
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    following = np.append(starts[1:], len(data))
    return stop[last] | closer[last] & stop[before] | (lines[following] > lines[ends])


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut behind runs of white space, a block at a time; a word is never cut."""
    at = 0
    while at < len(data):
        to = min(at + BLOCK_BYTES, len(data))
        for white in (True, False):  # on to the next white space, and past it
            while to < len(data):
                hit = np.flatnonzero(WHITE[data[to : to + BLOCK_BYTES]] == white)
                to += int(hit[0]) if len(hit) else min(BLOCK_BYTES, len(data) - to)
                if len(hit):
                    break
        yield data[at:to]
        at = to


def _row_tokens(block, encode: PieceIds) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all rows, tokens of each row, row and place in it of sentence ends)."""
    if block.n == 1 and len(block.data) > 2 * BLOCK_BYTES:
        ids, places, done = [], [], 0
        for part in _parts(block.data):
            starts, ends, _ = word_spans(part, np.array([0, len(part)]))
            if not len(starts):
                continue
            some, upto = _word_ids(part, starts, ends, encode)
            ids.append(some)
            places.append(done + upto[_ends_sentence(part, starts, ends)])
            done += len(some)
        places = np.concatenate([*places, np.zeros(0, np.int64)])
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.array([done]), np.zeros(len(places), np.int64), places
    starts, ends, first = word_spans(block.data, block.rows)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint32), np.zeros(block.n, np.int64), none, none
    ids, upto = _word_ids(block.data, starts, ends, encode)
    upto = np.concatenate([[0], upto])
    row = np.repeat(np.arange(block.n), np.diff(first))
    stop = np.flatnonzero(_ends_sentence(block.data, starts, ends))
    return ids, np.diff(upto[first]), row[stop], upto[stop + 1] - upto[first][row[stop]]


def candidate_cuts(lengths: np.ndarray, doc: np.ndarray, place: np.ndarray, capacity: int, cuts: Cuts = Cuts()) -> tuple[np.ndarray, np.ndarray]:
    """(places in the run, their penalties): 0, every document's end, and all others where a cut is allowed.

    lengths are tokens of documents, their end tokens included; doc and place say
    where sentences end within them.
    """
    ends = np.cumsum(lengths)
    inner = place + (ends - lengths)[doc]
    inner = inner[(place > 0) & (place < lengths[doc] - 1)]  # the end token stays with the last sentence
    at = np.unique(np.concatenate([[0], ends, inner]))
    gap = np.diff(at)
    wide = np.flatnonzero(gap > min(cuts.long_sentence, capacity))
    grain = min(cuts.grain, capacity)
    n = (gap[wide] - 1) // grain
    more = np.repeat(at[wide], n) + grain * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1)
    tail = np.arange(max(0, int(ends[-1]) - capacity), int(ends[-1]))
    places = np.unique(np.concatenate([at, more, tail]))
    penalty = np.full(len(places), cuts.inside, np.int64)
    penalty[np.searchsorted(places, inner)] = cuts.sentence
    penalty[np.searchsorted(places, np.concatenate([[0], ends]))] = 0
    return places, penalty


def plan_cuts(places: np.ndarray, penalty: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """(indices of the places cut at, first and last among them, and the cost): the cheapest windows of at most capacity tokens."""
    last = len(places) - 1
    # place by place, the earlier ones at a distance that needs no padding
    distances = [1 << k for k in range(capacity.bit_length()) if 1 << k <= capacity]
    frm, to = [], []
    for d in distances:
        i = np.minimum(np.searchsorted(places, places - d), last)
        hit = np.flatnonzero(places[i] == places - d)
        frm.append(i[hit])
        to.append(hit)
    frm, to = np.concatenate(frm), np.concatenate(to)
    order = np.argsort(to, kind="stable")
    frm = frm[order].tolist()
    first = np.searchsorted(to[order], np.arange(last + 2)).tolist()

    scale = 1 << 24  # costs come first; the sequences of a run, fewer than this, settle ties
    at, price = places.tolist(), (penalty * scale + 1).tolist()
    cost, parent = [0] * (last + 1), [0] * (last + 1)
    heads, keys = deque([0]), deque([at[0] * scale])  # keys grow from head to tail
    for j in range(1, last + 1):
        oldest = at[j] - capacity
        while at[heads[0]] < oldest:
            heads.popleft()
            keys.popleft()
        i = heads[0]
        best = keys[0] - oldest * scale
        for k in frm[first[j] : first[j + 1]]:
            if cost[k] < best:
                best, i = cost[k], k
        best += price[j]
        cost[j], parent[j] = best, i
        key = best + at[j] * scale
        while keys and keys[-1] >= key:
            heads.pop()
            keys.pop()
        heads.append(j)
        keys.append(key)
    chosen = [last]
    while chosen[-1]:
        chosen.append(parent[chosen[-1]])
    return np.array(chosen[::-1]), cost[last] // scale


def window_packing(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", cuts: Cuts = Cuts(), order_by: tuple[str, ...] = (), with_ids: bool = False
) -> DataFrame:
    """Rows (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, padding[, ids]): the pieces of the cheapest windows.

    ``start`` is how many of the document's ids come before the piece, ``offset``
    where it lies in its sequence, ``padding`` what its sequence is filled up with.
    Documents keep the order of the table's files; ``order_by`` sorts them by
    ranges of these columns instead.  Null and empty texts are one piece, end_id;
    so are texts of white space.  Null ids stay null, and rows with one id, or
    equal in all, are documents each of their own: what tells them apart is
    their place.  Of ties, the plan with fewer sequences is taken, and then the
    longer window.  Extra columns, whatever their names, aren't read.  An empty
    table gives no rows.  A text is encoded a block at a time, but its ids, 4
    bytes each, and its run's are held together.
    """
    if not 0 < capacity < 1 << 30 or cuts.sentence < 0 or cuts.inside < 0 or min(cuts.grain, cuts.long_sentence, cuts.run_tokens) < 1:
        raise ValueError("capacity, grain, long_sentence and run_tokens must be positive, and penalties not negative")
    fields = [T.StructField(id_col, docs.schema[id_col].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding")]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids)

    def flush(keys: list[pa.Array], ids: list[np.ndarray], counts: list[np.ndarray], stops: list[tuple[np.ndarray, np.ndarray]], sequence: int) -> tuple[pa.RecordBatch, int]:
        key, flat, lengths = pa.concat_arrays(keys), np.concatenate(ids), np.concatenate(counts)
        places, penalty = candidate_cuts(lengths, np.concatenate([d for d, _ in stops]), np.concatenate([p for _, p in stops]), capacity, cuts)
        windows = places[plan_cuts(places, penalty, capacity)[0]]
        bounds = np.union1d(windows, np.cumsum(lengths))
        begin, end = np.union1d([0], bounds)[:-1], bounds[bounds > 0]
        doc_first = np.cumsum(lengths) - lengths
        doc = np.searchsorted(doc_first, begin, "right") - 1
        window = np.searchsorted(windows, begin, "right") - 1
        width = np.diff(windows)
        padding = np.where(width & (width - 1), capacity - width, 0)
        view = memoryview(flat.tobytes())
        crc = np.fromiter((zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist())), np.int64, len(begin))
        columns = [begin - doc_first[doc], end - begin, crc, lengths[doc], sequence + window, begin - windows[window], padding[window]]
        arrays = [key.take(pa.array(doc)), *map(pa.array, columns)]
        if with_ids:
            arrays.append(pa.ListArray.from_arrays(pa.array(np.append(begin, end[-1]).astype(np.int32)), pa.array(flat.astype(np.int64))))
        return pa.RecordBatch.from_arrays(arrays, names=schema.names), sequence + len(width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer)
        sequence, held, run, docs_held = None, 0, ([], [], [], []), 0
        for batch in batches:
            for block in blocks(batch.column(1)):
                if sequence is None:
                    sequence = batch.column(2)[0].as_py() << 32
                ids, counts, doc, place = _row_tokens(block, encode)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                for parts, part in zip(run, (batch.column(0).slice(block.first, block.n), ids, counts + 1, (doc + docs_held, place))):
                    parts.append(part)
                held, docs_held = held + len(ids), docs_held + block.n
                if held >= cuts.run_tokens:
                    out, sequence = flush(*run, sequence)
                    yield out
                    held, run, docs_held = 0, ([], [], [], []), 0
        if docs_held:
            yield flush(*run, sequence)[0]

    if order_by:
        docs = docs.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return docs.select(F.col(id_col), F.col(text_col), F.spark_partition_id().alias("__task")).mapInArrow(pack, schema)
