"""A page's edits of one bucket as one row: sums and packed columns, made before the edits meet at their page.

Most of the work on an edit is then done where it is read, however few pages
there are, and a page's task sees a row for each block instead of each edit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Marks of an edit: it has a revision; it undoes one of a known editor's own account.
REVISION, UNDOES = 1, 2
#: Sums, the distinct editors and the newest edit; then columns with a value for each edit, where an author is a place among the editors or -1.
FIELDS = (
    "page_id long, n long, bots long, reverts long, delta long, losses long, editors array<string>, last_time long, last_id {0}, last_revision long, provenance string, "
    "times binary, ids array<{0}>, marks binary, revisions binary, authors binary, targets binary"
)
#: What an edit has, in the order that `pack` reads it.
EDIT = ("wiki", "page_title", "us", "event_id", "page_id", "user", "is_bot", "is_revert", "revision_id", "revert_target_revision_id", "byte_length_delta", "provenance_id")
_SUMS, _EDITORS, _NEWEST, _TIMES, _IDS, _MARKS, _REVISIONS, _AUTHORS, _TARGETS = slice(1, 6), 6, slice(7, 11), 11, 12, 13, 14, 15, 16


def pack(edits: DataFrame, slide_us: int, offset_us: int, id_type: str) -> DataFrame:
    """Rows (wiki, page_title, start, *FIELDS): the edits that an Arrow batch has of a page and a bucket of ``slide_us``, in the order they have there.  ``us`` is never null."""
    schema = f"wiki string, page_title string, start long, {FIELDS.format(id_type)}"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _blocks(batch, slide_us, offset_us)

    return edits.select(*EDIT).mapInArrow(packed, schema)


def _numbers(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    """The column's values, 0 for null."""
    return column.fill_null(False if pa.types.is_boolean(column.type) else 0).to_numpy(zero_copy_only=False).astype(kind)


def _places(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each row's place among the distinct values, null among them, and these."""
    coded = column.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _cut(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each block the bytes of its values."""
    ends = np.append(first, len(values)) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _blocks(batch: pa.RecordBatch, slide_us: int, offset_us: int) -> pa.RecordBatch:
    start = (_numbers(batch.column(2)) - offset_us) // slide_us * slide_us + offset_us
    (wiki, wikis), (page, pages), (starts, at) = _places(batch.column(0)), _places(batch.column(1)), np.unique(start, return_inverse=True)
    group = (wiki * len(pages) + page) * len(starts) + at
    order = np.argsort(group, kind="stable")
    rows, group = batch.take(pa.array(order)), group[order]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    block = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group))))
    _, _, us, ids, page_id, user, bot, revert, revision, target, delta, provenance = rows.columns

    code, names = _places(user)
    named = ~np.isin(code, [i for i, name in enumerate(names.to_pylist()) if not name])
    editors, place = np.unique(block[named] * len(names) + code[named], return_inverse=True)
    editors_first = np.searchsorted(editors // max(len(names), 1), np.arange(len(first) + 1))
    author = np.full(len(code), -1, np.int32)
    author[named] = place - editors_first[block[named]]

    times, changed, undone = _numbers(us), _numbers(delta), _numbers(revert, bool)
    # by time and id, so that the last one of a block is its newest; of equal ones the first
    by_age = pc.sort_indices(pa.table({"block": block, "us": times, "id": ids, "i": -np.arange(len(block))}), [(c, "ascending") for c in ("block", "us", "id", "i")], null_placement="at_start").to_numpy()
    newest = pa.array(by_age[np.append(first[1:], len(block)) - 1])
    with_page = np.flatnonzero(page_id.is_valid().to_numpy(zero_copy_only=False))
    known, where = np.unique(block[with_page], return_index=True)
    page_at = np.full(len(first), -1)
    page_at[known] = with_page[where]
    marks = REVISION * revision.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8) | UNDOES * (undone & named & target.is_valid().to_numpy(zero_copy_only=False)).astype(np.uint8)
    total = lambda values: pa.array(np.add.reduceat(values.astype(np.int64), first))
    lists = lambda values, offsets: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    columns = [
        rows.column(0).take(pa.array(first)), rows.column(1).take(pa.array(first)), pa.array(start[order][first]),
        page_id.take(pa.array(page_at, mask=page_at < 0)), total(np.ones(len(block))), total(_numbers(bot, bool)), total(undone), total(changed), total(changed < 0),
        lists(names.take(pa.array(editors % max(len(names), 1))), editors_first), us.take(newest), ids.take(newest), revision.take(newest), provenance.take(newest),
        _cut(times, first), lists(ids, np.append(first, len(block))), _cut(marks, first), _cut(_numbers(revision), first), _cut(author, first), _cut(_numbers(target), first),
    ]
    names_ = ["wiki", "page_title", "start", *(f.split()[0] for f in FIELDS.split(", "))]
    return pa.RecordBatch.from_arrays(columns, names=names_)


def _among(parts: Sequence[Sequence[Any]]) -> tuple[list[str], np.ndarray]:
    """The parts' editors, and for each edit its author's place among them."""
    names: dict[str, int] = {}
    authors = []
    for p in parts:
        places = np.array([names.setdefault(e, len(names)) for e in p[_EDITORS]] + [-1], np.int32)  # the last one is for -1
        authors.append(places[np.frombuffer(p[_AUTHORS], np.int32)])
    return list(names), np.concatenate(authors)


def joined(parts: Sequence[Sequence[Any]]) -> tuple:
    """One block of several of the same bucket, the earlier first."""
    if len(parts) == 1:
        return tuple(parts[0])
    editors, authors = _among(parts)
    newest = max(parts, key=lambda p: (p[_NEWEST][0], p[_NEWEST][1]))[_NEWEST]
    bytes_of = lambda i: b"".join(p[i] for p in parts)
    page = next((p[0] for p in parts if p[0] is not None), None)
    sums = [sum(values) for values in zip(*(p[_SUMS] for p in parts))]
    return page, *sums, editors, *newest, bytes_of(_TIMES), [i for p in parts for i in p[_IDS]], bytes_of(_MARKS), bytes_of(_REVISIONS), authors.tobytes(), bytes_of(_TARGETS)


def edits_of(block: Sequence[Any]) -> Iterator[tuple[Any, int]]:
    """(id, time) of each edit."""
    return zip(block[_IDS], np.frombuffer(block[_TIMES], np.int64).tolist())


def edges(parts: Sequence[Sequence[Any]]) -> Counter:
    """How often (editor, editor) the first undid the second, by edits of the parts alone; a revision's author is that of its newest edit."""
    editors, author = _among(parts)
    column = lambda i, kind: np.concatenate([np.frombuffer(p[i], kind) for p in parts])
    marks, revisions, times = column(_MARKS, np.uint8), column(_REVISIONS, np.int64), column(_TIMES, np.int64)
    undoing, written = np.flatnonzero(marks & UNDOES), np.flatnonzero(marks & REVISION)
    if not len(undoing) or not len(written):
        return Counter()
    written = written[np.lexsort((times[written], revisions[written]))]
    revision, time = revisions[written], times[written]
    last = np.flatnonzero(np.append(revision[1:] != revision[:-1], True))
    newest = written[last]
    tied = np.append(False, (revision[1:] == revision[:-1]) & (time[1:] == time[:-1]))
    if tied[last].any():
        ids = [i for p in parts for i in p[_IDS]]
        for k in np.flatnonzero(tied[last]).tolist():
            begin = end = int(last[k])
            while tied[begin]:
                begin -= 1
            newest[k] = max(written[begin : end + 1].tolist(), key=ids.__getitem__)
    targets = column(_TARGETS, np.int64)[undoing]
    at = np.minimum(np.searchsorted(revision[last], targets), len(last) - 1)
    src, dst = author[undoing], author[newest[at]]
    real = (revision[last][at] == targets) & (dst >= 0) & (src != dst)
    pairs, n = np.unique(src[real].astype(np.int64) * len(editors) + dst[real], return_counts=True)
    return Counter({(editors[p // len(editors)], editors[p % len(editors)]): k for p, k in zip(pairs.tolist(), n.tolist())})
