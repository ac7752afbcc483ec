"""Counts of each text that quality rules and classifiers read, found for a block of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import WHITE, Block, blocks, mix, shingle_hashes, span_hashes, word_spans

#: Words of a window that is looked for again in its text.
WINDOW = 8
#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_bytes",
    "n_upper",
    "n_digits",
    "n_other",
    "n_distinct_words",
    "n_same_as_previous",
    "n_bare_words",
    "n_sentence_ends",
    "n_long_words",
)

_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True
_upper = np.zeros(256, bool)
_upper[65:91] = True
_digit = np.zeros(256, bool)
_digit[48:58] = True
_letter = np.zeros(256, bool)
_letter[97:123] = _letter[65:91] = True
_letter[128:] = True


def _by_row(flags: np.ndarray, rows: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return upto[rows[1:]] - upto[rows[:-1]]


def _again(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is all but one of those equal in its row, is any other of its row equal), for each value."""
    key = mix(value + row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    later, any_other = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    any_other[order[1:]] |= same
    any_other[order[:-1]] |= same
    return later, any_other


def block_counts(block: Block) -> dict[str, np.ndarray]:
    """COUNTS of each row of a block.

    Words are runs of bytes other than ASCII white space.  n_repeat_words are
    the words in windows of WINDOW words found twice or more in the text;
    n_dup_lines the lines with a word that equal an earlier one.
    """
    data, rows = block.data, block.rows
    out = {"n_bytes": np.diff(rows)}
    white = WHITE[data]
    starts, ends, first = word_spans(data, rows)
    n = np.diff(first)
    row = np.repeat(np.arange(block.n), n)
    out["n_words"] = n
    out["word_chars"] = _by_row(~white & ((data & 0xC0) != 0x80), rows)
    out["n_symbols"] = _by_row(_symbol[data], rows)
    out["n_upper"] = _by_row(_upper[data], rows)
    out["n_digits"] = _by_row(_digit[data], rows)
    out["n_other"] = _by_row(~white & ~_letter[data] & ~_digit[data], rows)
    word_end = np.zeros(len(data), bool)
    word_end[ends - 1] = True
    stops = (data == 46) | (data == 33) | (data == 63)
    out["n_sentence_ends"] = _by_row(word_end & stops, rows)
    words = span_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    letters = np.concatenate([[0], np.cumsum(_letter[data] | _digit[data])])
    bare = np.bincount(row[letters[ends] == letters[starts]], minlength=block.n) if len(starts) else np.zeros(block.n, np.int64)
    out["n_bare_words"] = bare
    out["n_long_words"] = np.bincount(row[ends - starts > 30], minlength=block.n)

    later, _ = _again(row, words)
    out["n_distinct_words"] = n - np.bincount(row[later], minlength=block.n)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    out["n_same_as_previous"] = np.bincount(row[same], minlength=block.n)

    out["n_repeat_words"] = np.zeros(block.n, np.int64)
    long = n >= WINDOW
    if long.any():
        place = np.flatnonzero(np.arange(len(words)) + WINDOW <= first[1:][row])
        at, hashes = shingle_hashes(words, first, WINDOW)
        full = long[at]
        _, twice = _again(at[full], hashes[full])
        begin = place[twice]
        cover = np.bincount(begin, minlength=len(words) + 1) - np.bincount(begin + WINDOW, minlength=len(words) + 1)
        out["n_repeat_words"] = np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=block.n)

    # lines: begin at a row's begin and after each line end
    line_begin = np.sort(np.concatenate([rows[:-1][np.diff(rows) > 0], np.flatnonzero(data[:-1] == 10) + 1])) if len(data) else np.zeros(0, np.int64)
    line_begin = np.unique(line_begin)
    line_end = np.append(line_begin[1:], len(data)) if len(line_begin) else line_begin
    trimmed = line_end - ((line_end > line_begin) & (data[np.maximum(line_end - 1, 0)] == 10)) if len(line_begin) else line_end
    line_row = np.searchsorted(rows, line_begin, "right") - 1
    word_count = np.searchsorted(starts, trimmed) - np.searchsorted(starts, line_begin)
    real = word_count > 0
    out["n_lines"] = np.bincount(line_row[real], minlength=block.n)
    hashes = span_hashes(data, line_begin[real], trimmed[real]) if real.any() else np.zeros(0, np.uint64)
    later, _ = _again(line_row[real], hashes)
    out["n_dup_lines"] = np.bincount(line_row[real][later], minlength=block.n)
    return out


def text_statistics(docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, *COUNTS) for every row of docs, each from its whole text; null and empty texts have zeros.

    Without an id_col the rows keep all their columns, and the counts follow as
    one struct named __counts, which clashes with no name of theirs.
    """
    counts = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    kept = docs.select(id_col) if id_col else docs
    extra = counts.fields if id_col else [T.StructField("__counts", counts)]
    schema = T.StructType([*kept.schema.fields, *extra])
    width = len(kept.columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(width)):
                found = block_counts(block)
                arrays = [pa.array(found[c].astype(np.int64)) for c in COUNTS]
                if not id_col:
                    arrays = [pa.StructArray.from_arrays(arrays, names=list(COUNTS))]
                rows = batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays([*rows.columns[:width], *arrays], names=schema.names)

    return docs.select(*kept.columns, F.col(text_col).alias("__text")).mapInArrow(count, schema)


def shares(prefix: str = "") -> dict[str, Column]:
    """Columns made of COUNTS that do not grow with the text's length; 0 for texts without words."""
    n = lambda name: F.col(prefix + name)
    words = F.greatest(n("n_words"), F.lit(1))
    size = F.greatest(n("n_bytes"), F.lit(1))
    lines = F.greatest(n("n_lines"), F.lit(1))
    return {
        "log_words": F.log1p(n("n_words").cast("double")),
        "symbols_per_word": n("n_symbols") / words,
        "upper_share": n("n_upper") / size,
        "digit_share": n("n_digits") / size,
        "mark_share": n("n_other") / size,
        "mean_word_chars": n("word_chars") / words,
        "repeat_share": n("n_repeat_words") / words,
        "dup_line_share": n("n_dup_lines") / lines,
        "distinct_share": n("n_distinct_words") / words,
        "stutter_share": n("n_same_as_previous") / words,
        "bare_share": n("n_bare_words") / words,
        "sentence_share": n("n_sentence_ends") / words,
        "log_words_per_line": F.log1p(n("n_words") / lines),
        "long_share": n("n_long_words") / words,
    }
