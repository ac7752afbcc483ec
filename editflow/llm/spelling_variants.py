"""Spelling variants: pairs of words one edit apart, by finite-state composition.

Words that share their first three code points form a partition.  Its words
behind that initial state are accepted by a minimal acceptor A; A composed with
a transducer of exactly one edit and with A again accepts the pairs that are
sought.  States of the composition before the edit are pairs (q, q); after it
they are pairs (p, q), from which both sides must accept the same rest, so that
pairs without a common length are left out, and equal states need no walk.
Counts of accepted words at each state turn an accepted path into the number
of a word.

Pairs that differ within the first three code points share their last three
(words have seven at least): the same composition over reversed words,
partitioned by these, with edits only where at most two symbols are left.

A partition with more words than ``PARTITION_WORDS`` is divided by the next
symbol.  What differs in that very symbol shares all the rest, and meets in
groups by it, which the alphabet bounds.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import forget, settle
from .text import LOWER, Block, blocks

#: Words of a partition that is composed in one piece; larger ones are divided.
PARTITION_WORDS = 1 << 14
#: Code points that a partition's words share, at their beginnings or their ends.
SHARED = 3
#: Words that a task counts at once.
_COUNTED = 1 << 21
#: Bytes of a run up to which its checksum is computed together with those of others.
_SHORT = 48

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of data[starts:ends], each continued from a checksum before it."""
    out = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    index = np.flatnonzero(ends - starts <= _SHORT)
    index = index[np.argsort(starts[index] - ends[index], kind="stable")]  # long ones first
    size, state, at = (ends - starts)[index], out[index], starts[index]
    for t in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -t, "left"))  # those of more than t bytes
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + t]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    out[index] = state
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(ends - starts > _SHORT).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    return out


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    flat = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)]
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())])


def _block_words(block: Block, names: list[bytes], shortest: int, every: int) -> Iterator[pa.Array]:
    """The words of a block of rows called names."""
    lead = block.data == 0xC3
    letter = _LETTER[block.data] | lead
    letter[1:] |= lead[:-1]
    edge = np.ones(len(letter) + 1, bool)
    edge[1:-1] = letter[:-1] != letter[1:]
    edge[block.rows] = True
    starts, ends = np.flatnonzero(edge[:-1] & letter), np.flatnonzero(edge[1:] & letter) + 1
    two = np.concatenate([[0], np.cumsum(lead)])
    points = ends - starts - (two[ends] - two[starts])
    long = points >= shortest
    starts, ends, points = starts[long], ends[long], points[long]
    if not len(starts):
        return
    data = LOWER[block.data]
    row = np.searchsorted(block.rows, starts, "right") - 1
    before = np.fromiter((zlib.crc32(name) for name in names), np.uint32, len(names))
    h = _checksums(data, starts, ends, before[row])
    cut = h % np.uint32(every) == 0
    yield _strings(data, starts[~cut], ends[~cut])
    some = []
    for a, b, at in zip(starts[cut].tolist(), ends[cut].tolist(), (h[cut] % points[cut]).tolist()):
        if b - a > shortest:
            word = data[a:b].tobytes().decode()
            if len(word) > shortest:
                some.append(word[:at] + word[at + 1 :])
    yield pa.array(some, pa.large_string())


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """Rows (word, n): lower-cased runs of letters A-Z, a-z and U+00C0 to U+00FF, of at least ``shortest`` code points and ``least`` occurrences.

    A run whose crc32 with its document's id is divisible by ``every`` loses a code
    point first, at the place that the checksum names (a fixed noise that makes
    variants; a null id counts as an empty one).  Only A-Z are lower-cased.
    """
    if shortest <= 2 * SHARED:
        raise ValueError(f"words need more than {2 * SHARED} code points")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            found = pc.value_counts(pa.chunked_array(held, pa.large_string()))
            return pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=["word", "n"])

        for batch in batches:
            names = [f"{x}:".encode() for x in pc.fill_null(batch.column(0), "").to_pylist()]
            for block in blocks(batch.column(1)):
                for words in _block_words(block, names[block.first : block.first + block.n], shortest, every):
                    held.append(words)
                    size += len(words)
                if size > _COUNTED:
                    yield counted()
                    held, size = [], 0
        yield counted()

    runs = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(count, "word string, n long")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Acceptor:
    """The minimal acceptor of sorted distinct words, with the number of accepted words and their least and greatest length at each state."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, tuple[int, int]]] = []  # symbol -> (state, words before it)
        self.final: list[bool] = []
        self.count: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]  # the states of the last word: final, finished arcs
        last = ""
        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            self._finish(path, last, same)
            path.extend([False, []] for _ in range(len(word) - same))
            path[-1][0] = True
            last = word
        self._finish(path, last, 0)
        self.start = self._state(path[0])

    def _finish(self, path: list[list], word: str, keep: int) -> None:
        for i in range(len(path) - 1, keep, -1):
            path[i - 1][1].append((word[i - 1], self._state(path.pop())))

    def _state(self, node: list) -> int:
        key = (node[0], *node[1])
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.arcs)
            n, arcs, low, high = int(node[0]), {}, 0 if node[0] else 1 << 60, 0
            for symbol, to in node[1]:
                arcs[symbol] = (to, n)
                n += self.count[to]
                low, high = min(low, self.low[to] + 1), max(high, self.high[to] + 1)
            self.arcs.append(arcs)
            self.final.append(node[0])
            self.count.append(n)
            self.low.append(low)
            self.high.append(high)
        return found


class Composition:
    """A composed with exactly one edit and A: pairs of numbers of accepted words; a pair comes once, of two lengths the shorter first.

    The edit stands where the words first differ.  ``left`` bounds the symbols behind it.
    """

    def __init__(self, acceptor: Acceptor, left: int | None = None):
        self.a, self.left = acceptor, left
        self.rests: dict[tuple[int, int, int | None], list[tuple[int, int]]] = {}
        self.inner: dict[int, list[tuple[int, int]]] = {}

    def same_rest(self, p: int, q: int, left: int | None) -> list[tuple[int, int]]:
        """Numbers, at p and at q, of the words that both accept, of at most ``left`` symbols."""
        a = self.a
        low = max(a.low[p], a.low[q])
        if low > min(a.high[p], a.high[q]) or left is not None and low > left:
            return []
        if p == q and (left is None or a.high[p] <= left):
            return [(i, i) for i in range(a.count[p])]
        found = self.rests.get((p, q, left))
        if found is None:
            found = [(0, 0)] if a.final[p] and a.final[q] else []
            if left != 0:
                less = None if left is None else left - 1
                ps, qs = a.arcs[p], a.arcs[q]
                for symbol in ps.keys() & qs.keys():
                    (x, i), (y, j) = ps[symbol], qs[symbol]
                    found += [(i + u, j + v) for u, v in self.same_rest(x, y, less)]
            self.rests[p, q, left] = found
        return found

    def at(self, q: int) -> list[tuple[int, int]]:
        """Pairs of words from q whose first symbols differ."""
        a, left = self.a, self.left
        arcs, out = list(a.arcs[q].items()), []
        for n, (_, (x, i)) in enumerate(arcs):
            for _, (y, j) in arcs[n + 1 :]:
                out += [(i + u, j + v) for u, v in self.same_rest(x, y, left)]
        less = None if left is None else left - 1
        for symbol, (x, i) in arcs:  # one side has a symbol more
            if a.final[q] and a.final[x]:
                out.append((0, i))
            if left != 0:
                for other, (y, j) in arcs:
                    if other != symbol and other in a.arcs[x]:
                        z, k = a.arcs[x][other]
                        out += [(j + u, i + k + v) for u, v in self.same_rest(y, z, less)]
        return out

    def within(self, q: int) -> list[tuple[int, int]]:
        """All pairs of words from q."""
        found = self.inner.get(q)
        if found is None:
            # where more symbols are left than an edit may have behind it, nothing differs here
            found = self.at(q) if self.left is None or self.a.low[q] <= self.left + 1 else []
            for to, i in self.a.arcs[q].values():
                if self.a.count[to] > 1:
                    found += [(i + u, i + v) for u, v in self.within(to)]
            self.inner[q] = found
        return found


def _compose(kind: str, words: list[str], depth: int) -> list[tuple[int, int]]:
    """Pairs of places in words, all of one partition of that kind, that are to be reported there."""
    backward = kind in "bs"
    read = [w[::-1][depth:] for w in words] if backward else [w[depth:] for w in words]
    order = sorted(range(len(words)), key=read.__getitem__)
    acceptor = Acceptor([read[i] for i in order])
    machine = Composition(acceptor, SHARED - 1 if backward else None)
    found = machine.at(acceptor.start) if kind in "rs" else machine.within(acceptor.start)
    pairs = [(order[i], order[j]) for i, j in found]
    if backward:  # the others share their beginnings and are found by these
        pairs = [(i, j) for i, j in pairs if words[i][:SHARED] != words[j][:SHARED]]
    return pairs


def _partitions(words: DataFrame, limit: int) -> DataFrame:
    """Rows (kind, key, depth, word, n): every word in each partition that it takes part in."""
    ends = [("f", F.substring("word", 1, SHARED)), ("b", F.reverse(F.substring("word", -SHARED, SHARED)))]
    each = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.lit(SHARED).alias("depth")) for kind, key in ends]))
    open_ = words.select(each.alias("x"), "word", "n").select("x.*", "word", "n")
    out, used = None, []
    while True:
        counts = open_.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit).drop("__n")
        large = settle(counts, "large-partitions")
        used.append(large)
        done = large.isEmpty()
        fit = open_ if done else open_.join(large, ["kind", "key"], "left_anti")
        out = fit if out is None else out.unionByName(fit)
        if done:
            return out
        rows = settle(open_.join(large, ["kind", "key"], "left_semi"), "divided")
        read = F.when(F.col("kind") == "b", F.reverse("word")).otherwise(F.col("word"))
        text, depth, size = F.col("__text"), F.col("depth"), F.length("__text")
        rows = rows.withColumn("__text", read)
        few = F.when(F.col("kind") == "b", F.lit(SHARED - 1)).otherwise(F.lit(1 << 30))

        def met(rest: Column, when: Column) -> DataFrame:
            """Groups by all that comes behind the next symbol."""
            kind = F.when(F.col("kind") == "b", "s").otherwise("r")
            return rows.where(when).select(kind.alias("kind"), F.concat("key", F.lit("\0"), rest).alias("key"), "depth", "word", "n")  # noqa: B023

        behind = F.substr(text, depth + 2)
        out = out.unionByName(met(behind, (size > depth) & (size - depth - 1 <= few))).unionByName(met(F.substr(text, depth + 1), size - depth <= few))
        following = F.concat("key", F.substr(text, depth + 1, F.lit(1)))
        open_ = rows.where(size > depth).select("kind", following.alias("key"), (depth + 1).alias("depth"), "word", "n")


def near_pairs(words: DataFrame, limit: int = PARTITION_WORDS, best_only: bool = False) -> DataFrame:
    """Rows (word, other, other_n) for words one edit apart, in both directions, from distinct words and their n.

    With ``best_only`` rows (word, n_near, other, other_n), several a word: how many
    of its near words a task has found, and of these the one with the largest n.
    Words have more than twice ``SHARED`` code points.  What a task holds is one
    partition of at most ``limit`` words, some half a kilobyte for each of their
    code points.
    """

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(1 << 24)  # an acceptor is as deep as its longest word
        words, counts, left, right = [], [], [], []

        def report() -> pa.RecordBatch:
            n, names = np.array(counts, np.int64), pa.array(words, pa.string())
            a, b = np.array(left + right, np.int64), np.array(right + left, np.int64)
            if not best_only:
                return pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(n[b])], names=["word", "other", "other_n"])
            order = np.lexsort((-n[b], a))
            a, b = a[order], b[order]
            first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
            size = np.diff(np.append(first, len(a)))
            best = b[first]
            ties = np.flatnonzero((size > 1) & (n[b[np.minimum(first + 1, max(len(b) - 1, 0))]] == n[best]))
            for t in ties.tolist():
                some = b[first[t] : first[t] + size[t]].tolist()
                best[t] = min((i for i in some if counts[i] == counts[some[0]]), key=words.__getitem__)
            columns = [names.take(pa.array(a[first])), pa.array(size), names.take(pa.array(best)), pa.array(n[best])]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "other", "other_n"])

        def close(group: tuple, frm: int) -> None:
            if len(words) - frm < 2:
                del words[frm:], counts[frm:]
                return
            for i, j in _compose(group[0], words[frm:], group[2]):
                left.append(frm + i)
                right.append(frm + j)

        group, frm = None, 0
        for batch in batches:
            for kind, key, depth, word, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if group is None or key != group[1] or kind != group[0]:
                    if group is not None:
                        close(group, frm)
                    if len(words) > limit or len(left) > 1 << 18:
                        yield report()
                        words, counts, left, right = [], [], [], []
                    group, frm = (kind, key, depth), len(words)
                words.append(word)
                counts.append(n)
        if group is not None:
            close(group, frm)
            yield report()

    schema = "word string, n_near long, other string, other_n long" if best_only else "word string, other string, other_n long"
    rows = _partitions(words, limit).select("kind", "key", "depth", "word", "n")
    return rows.repartition("kind", "key").sortWithinPartitions("kind", "key").mapInArrow(compose, schema)


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) from rows (word, form) without cycles: each round doubles how many forms are followed."""
    now = settle(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        above = now.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        joined = now.join(above, F.col("root") == F.col("__word"), "left")
        after = settle(joined.select("word", F.coalesce("__root", "root").alias("root"), F.col("__root").isNotNull().alias("moved")), "forms")
        forget(now)
        now = after
        if after.where("moved").isEmpty():
            return now.drop("moved")


def variant_groups(words: DataFrame, ratio: int = 10, limit: int = PARTITION_WORDS) -> DataFrame:
    """words (word, n) with n_near, form, form_n and root.

    n_near is how many words are near, one inserted, deleted or replaced code
    point apart; ``form`` the near word of largest n, of equal ones the smallest in
    the order of code points, if its n is at least ``ratio`` times the word's, else
    null; ``root`` where following forms ends, the word itself if it has none.  A
    form has a larger n than its word, so chains end.
    """
    if ratio < 2:
        raise ValueError("a form's n must be a multiple of its word's")
    near = near_pairs(words, limit, best_only=True)
    best = F.min(F.struct((-F.col("other_n")).alias("k"), "other"))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    both = words.join(near, "word", "left")
    fits = -F.col("b.k") >= ratio * F.col("n")
    found = both.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("b.other")).alias("form"), F.when(fits, -F.col("b.k")).alias("form_n"))
    found = settle(found, "variants")
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 10, limit: int = PARTITION_WORDS) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n): variant_groups of word_counts, for every word of a table of texts.

    Null and empty texts have no words; repeated rows count each; null ids, ids
    that rows share and extra columns, whatever their names, change nothing but the
    checksums that ids are part of.  An empty table gives no rows.  Long texts are
    worked through row by row, with some twenty bytes of memory a byte of text.
    """
    return variant_groups(settle(word_counts(docs, id_col, text_col), "words"), ratio, limit)
