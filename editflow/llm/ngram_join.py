"""Near-duplicates by word n-gram Jaccard similarity, filtered under several global token orders.

Linked texts share a token among the first of each in any order of all tokens,
if "the first" are as many as the similarity demands.  Under the first order,
rare tokens before common ones, posting lists bring sharing texts together.
Under two other orders, each text's first tokens are kept as 16-bit values in
its profile; a pair that shares none of them under either order is dropped
before any text moves, as is one whose first common token leaves too little
room, or whose tokens' counts by class bound what they can share below what
they need.  All these filters are exact: they drop no pair that links.

Groups are not paired off.  In a posting list every text is compared with one
leader, the text with the fewest rare tokens, which joins a group of copies in
as many comparisons as it has texts; lists of common tokens are split, and
their leaders compared with one leader.  Then only texts of one list that lie
in different components may still link.  Short lists are paired off.  Longer
ones with the same leader are one group; in each, all texts outside its largest component are compared with all
of its texts, in one task for up to some thousand texts.  First only sizes and
counts by class move, which leave few; of those the three filters are
products of small matrices, what is left is counted exactly, and only
links become rows.  So the components are exact, whatever the leaders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .tables import forget, free_names, settle
from .text import LOWER, Block, binary_column, blocks, mix, shingle_hashes, span_hashes, word_spans

_U = np.uint64
#: The odd factors that make other orders of the same hashes.
_ORDERS = (0x9FB21C651E98DF25, 0xA0761D6478BD642F)
#: Cells that count tokens by hash, to tell common from rare; fixed, so the counts stay 16 MB for any corpus.
CELL_BITS = 21
#: A list is kept in parts of about this many times the count from which a token is common.
PART_LEVELS = 6
_CELLS_A_ROW = 1 << 12
#: Bits by hashed id that say which texts are candidates.  A false one costs a fetch, no result.
ID_BITS = 23
#: Classes of tokens by hash.  Two sets share at most the sum of the smaller counts of each class.
BARS = 256
#: Texts of a block, and their tokens; a leader with more members is spread over several.
BLOCK_TEXTS, BLOCK_TOKENS = 500, 1 << 21
#: Lists of up to so many texts are paired off, so that they make at most half as many times more pairs than they have rows.
SMALL_LIST = 8
#: Texts of a group that are compared with PART_TEXTS others in one task; larger groups are dealt to several.
REST_TEXTS, PART_TEXTS = 512, 2048
#: The same in tokens, which cut groups of long texts sooner.
REST_TOKENS, PART_TOKENS = 1 << 20, 1 << 22
#: Columns of the matrices that first tokens are compared by.  Two tokens in one column cost a comparison, no result.
_COLUMNS = 2048
#: Pairs whose bars are compared at a time.
_PAIRS = 1 << 15
_PROFILE = ("bars", "second", "third", "print")


def _sort(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The order by row and then value."""
    order = np.argsort(value)
    kind = np.uint16 if not len(row) or row[-1] < 1 << 16 else np.uint32
    return order[np.argsort(row[order].astype(kind), kind="stable")]


def token_sets(block: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token, number of tokens of each row): distinct shingle hashes of the lower-cased words, by row and hash."""
    data = LOWER[block.data]
    starts, ends, first = word_spans(data, block.rows)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(block.n, np.int64)
    row, token = shingle_hashes(span_hashes(data, starts, ends), first, k)
    order = _sort(row, token)
    row, token = row[order], token[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    row, token = row[keep], token[keep]
    return row, token, np.bincount(row, minlength=block.n)


def _meet(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _linked(s: np.ndarray, t: np.ndarray, num: int, den: int) -> bool:
    """Whether two sets of tokens are similar enough."""
    if not len(s) or not len(t):
        return False
    both = _meet(s, t)
    return both * den >= (len(s) + len(t) - both) * num


def prefix_sizes(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """How many first tokens a set of n must show: n - ceil(n * num / den) + 1, none for empty sets."""
    return np.where(n > 0, n + (-n * num) // den + 1, 0)


def _first(row: np.ndarray, n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Marks the first size[r] entries of each row r."""
    return np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) < np.repeat(size, n)


def _other_firsts(row: np.ndarray, token: np.ndarray, n: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The first size[r] tokens of each row r under each of the other orders."""
    firsts = []
    for factor in _ORDERS:
        other = token * _U(factor)
        firsts.append(other[_sort(row, other)][_first(row, n, size)])
    return firsts


def _profiles(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """For each document a row (id, n, bars, second, third, print): its set size, how many tokens fall in each of BARS, its first tokens under the other orders, and the 128-bit hash of the set; and rows (cell, counts) of token counts.

    Sets too large for 8-bit bars have empty ones, which exclude nothing.
    """
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), *(T.StructField(c, T.BinaryType()) for c in _PROFILE), T.StructField("cell", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for block in blocks(batch.column(1)):
                row, token, n = token_sets(block, k)
                bars = np.bincount(row * BARS + (token & _U(BARS - 1)).astype(np.int64), minlength=block.n * BARS).reshape(-1, BARS)
                fit = bars.max(1, initial=0) < 1 << 8
                size = prefix_sizes(n, num, den)
                firsts = [binary_column((mix(f) >> _U(48)).astype("<u2"), size) for f in _other_firsts(row, token, n, size)]
                upto = np.concatenate([[0], np.cumsum(n)]).tolist()
                prints = [hashlib.blake2b(token[i:j], digest_size=16).digest() for i, j in zip(upto, upto[1:])]
                np.add.at(cells, (token >> _U(64 - CELL_BITS)).astype(np.int64), 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), pa.array(n), binary_column(bars[fit].astype(np.uint8).ravel(), fit * BARS), *firsts, pa.array(prints, pa.binary()), pa.nulls(block.n, pa.int32()), pa.nulls(block.n, pa.binary())], names=schema.names)
        parts = cells.reshape(-1, _CELLS_A_ROW)
        used = np.flatnonzero(parts.any(1))
        counts = pa.array([parts[i].astype("<i4").tobytes() for i in used], pa.binary())
        blank = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int64(), *[pa.binary()] * len(_PROFILE))]
        yield pa.RecordBatch.from_arrays([*blank, pa.array(used.astype(np.int32)), counts], names=schema.names)

    return docs.mapInArrow(profile, schema)


def _levels(profiles: DataFrame) -> np.ndarray:
    """For each cell how common its tokens are: 0 up to three deviations above the mean cell, then one more for each doubling."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = np.frombuffer(raw.as_py(), "<i4").astype(np.int64)
                sums[cell] = sums[cell] + counts if cell in sums else counts
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["cell", "counts"])

    parts = profiles.where(F.col("cell").isNotNull()).select("cell", "counts").repartition("cell").mapInArrow(add, "cell int, counts binary")
    cells = np.zeros(1 << CELL_BITS, np.float64)
    for r in parts.collect():  # as many cells as CELL_BITS says, for any corpus
        cells[r["cell"] * _CELLS_A_ROW : (r["cell"] + 1) * _CELLS_A_ROW] += np.frombuffer(r["counts"], "<i8")
    mean = cells.mean()
    above = (cells - mean) / (3 * np.sqrt(max(mean, 1.0)))
    return np.where(above > 1, np.minimum(1 + np.floor(np.log2(np.maximum(above, 1))), 63), 0).astype(np.uint8)


def _postings(docs: DataFrame, levels: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """Rows (token, id, n, room, lead, lead_n, lead_room, rare, level, closed): the members of posting lists under the first order, each with its list's leader.

    room is how many of the text's tokens, in this order, are left from this
    one on.  A list of a token of level l is kept in 2**(l - PART_LEVELS) parts
    by id; lists of one member are left out, save those of common tokens.
    closed says that a list is known to have no more than the leader and one
    other, so that the leader's comparison settles it.
    """
    level_of = docs.sparkSession.sparkContext.broadcast(levels)
    listed = "token long, part int, level int, rare int, id long, n int, room int"

    def list_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = level_of.value
        for batch in batches:
            for block in blocks(batch.column(1)):
                row, token, n = token_sets(block, k)
                level = table[(token >> _U(64 - CELL_BITS)).astype(np.int64)]
                order = np.argsort(row * 64 + level, kind="stable")
                first = _first(row, n, prefix_sizes(n, num, den))
                row_, token_, level_ = row[first], token[order][first], level[order][first].astype(np.int64)
                rare = np.bincount(row[level == 0], minlength=block.n)
                room = (np.repeat(np.cumsum(n), n) - np.arange(len(row)))[first]
                ids = batch.column(0).slice(block.first, block.n).to_numpy()[row_]
                part = (mix(ids.astype(np.uint64)) >> _U(1)).astype(np.int64) % (1 << np.clip(level_ - PART_LEVELS, 0, 30))
                columns = [token_.view(np.int64), part.astype(np.int32), level_.astype(np.int32), rare[row_].astype(np.int32), ids, n[row_].astype(np.int32), room.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "part", "level", "rare", "id", "n", "room"])

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by list and rank; only the current list's leader is carried from batch to batch."""
        names = ["token", "part", "level", "rare", "id", "n", "room"]
        carried, told = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy() for c in names]
            x = new if carried is None else [np.concatenate([a, b]) for a, b in zip(carried, new)]
            begin = np.ones(len(x[0]), bool)
            begin[1:] = (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1])
            at = np.flatnonzero(begin)
            size = np.diff(np.append(at, len(begin)))
            head = np.repeat(at, size)
            listed_now = (size > 1) | (x[2][at] > 0)
            show = np.repeat(listed_now, size)
            again = carried is not None and told
            if again:
                show[0] = False
            carried = [c[at[-1] : at[-1] + 1] for c in x]
            told = bool(listed_now[-1]) or (again and len(size) == 1)
            # lists that begin and end within this batch
            pair = (size == 2) & (x[2][at] <= PART_LEVELS)
            pair[-1] = False
            if again:
                pair[0] = False
            closed = np.repeat(pair, size)
            i = np.flatnonzero(show)
            columns = [x[0][i], x[4][i], x[5][i], x[6][i], x[4][head[i]], x[5][head[i]], x[6][head[i]], x[3][i], x[2][i], closed[i]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "id", "n", "room", "lead", "lead_n", "lead_room", "rare", "level", "closed"])

    rows = docs.where(F.col("id").isNotNull()).mapInArrow(list_tokens, listed)
    sorted_rows = rows.repartition("token", "part").sortWithinPartitions("token", "part", "rare", "n", "id")
    return sorted_rows.mapInArrow(lead, "token long, id long, n int, room int, lead long, lead_n int, lead_room int, rare int, level int, closed boolean")


def _may_link(n_a: Column, room_a: Column, n_b: Column, room_b: Column, num: int, den: int) -> Column:
    """Whether two texts whose first common token is this one can be similar enough.

    They need num / (num + den) of both sizes in common, and have at most what
    is left of the smaller rest.
    """
    return F.least(room_a, room_b).cast("long") * (num + den) >= (n_a.cast("long") + n_b) * num


def _named(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of docs whose id is in named, and a few more: a filter before a join, of a size that ID_BITS fixes."""
    at = F.xxhash64("id")
    bits = named.select((F.shiftrightunsigned(at, 64 - ID_BITS + 6)).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(xxhash64(id), 64) as int))").alias("bit"))
    words = np.zeros(1 << (ID_BITS - 6), np.int64)
    for r in bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # at most 2**(ID_BITS - 6) rows
        words[r["word"]] = r["bits"]
    mask = docs.sparkSession.sparkContext.broadcast(words)
    names = docs.columns

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(len(names)).to_numpy()
            word = mask.value[(h.view(np.uint64) >> _U(64 - ID_BITS + 6)).astype(np.int64)]
            yield batch.select(names).filter(pa.array((word.view(np.uint64) >> (h.view(np.uint64) & _U(63))) & _U(1) == 1))

    return docs.where(F.col("id").isNotNull()).select(*names, F.xxhash64("id").alias("h")).mapInArrow(pick, docs.schema)


def _within_bound(pairs: DataFrame, profiles: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (a, b, lead, same, n_a, n_b): the pairs whose profiles allow a link, with the sizes of their sets.

    They have enough tokens in common by bars, and a first token in common under
    each of the other orders; same says that the sets are equal.
    """
    profiles = _named(profiles.select("id", "n", *_PROFILE), pairs.select(F.explode(F.array("a", "b")).alias("id")))
    for side in ("a", "b"):
        mine = profiles.select(F.col("id").alias(f"__{side}"), *(F.col(f).alias(f"{f}_{side}") for f in ("n", *_PROFILE)))
        pairs = pairs.join(mine, F.col(side) == F.col(f"__{side}")).drop(f"__{side}")

    def may_link(x: list[np.ndarray], y: list[np.ndarray]) -> bool:
        if not len(x[1]) or not len(y[1]):
            return False  # an empty set
        if len(x[0]) and len(y[0]) and int(np.minimum(x[0], y[0]).sum()) * (num + den) < (int(x[0].sum()) + int(y[0].sum())) * num:
            return False
        return all(np.isin(u, v).any() for u, v in zip(x[1:], y[1:]))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[[np.frombuffer(v, kind) for v in batch.column(f"{f}_{s}").to_pylist()] for f, kind in zip(_PROFILE, (np.uint8, "<u2", "<u2"))] for s in ("a", "b")]
            keep = pa.array([may_link([c[i] for c in sides[0]], [c[i] for c in sides[1]]) for i in range(batch.num_rows)], pa.bool_())
            same = pc.equal(batch.column("print_a"), batch.column("print_b"))
            a, b, lead, n_a, n_b = (batch.column(c) for c in ("a", "b", "lead", "n_a", "n_b"))
            yield pa.RecordBatch.from_arrays([a, b, lead, same, n_a, n_b], names=["a", "b", "lead", "same", "n_a", "n_b"]).filter(keep)

    return pairs.mapInArrow(bound, "a long, b long, lead long, same boolean, n_a long, n_b long").distinct()


def _loads(texts: int, tokens: int | None) -> int:
    """How many blocks of BLOCK_TEXTS and BLOCK_TOKENS there are to be, at least one."""
    return max(1, texts // BLOCK_TEXTS, (tokens or 0) // BLOCK_TOKENS)


def _verified(pairs: DataFrame, profiles: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Rows (u, v): the pairs (a, b, lead) that link.  Unless their sets are equal they are compared in blocks that get each of their texts once."""
    able = settle(_within_bound(pairs, profiles, num, den), "pairs")
    pairs = able.where(~F.col("same"))
    ends = F.explode(F.array(*(F.struct(F.col(s).alias("id"), F.col(f"n_{s}").alias("n")) for s in ("a", "b"))))
    members = settle(pairs.select("lead", ends.alias("end")).select("lead", "end.*").distinct(), "members")
    total = members.agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("tokens")).first()
    parts = members.groupBy("lead").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_TEXTS, F.sum("n") / BLOCK_TOKENS)).alias("g")).where(F.col("g") > 1)
    buckets = F.lit(_loads(*total))
    half = lambda side: F.pmod(F.xxhash64(side), F.coalesce("g", F.lit(1)))
    placed = pairs.join(parts, "lead", "left").select("a", "b", F.pmod(F.xxhash64("lead", half("a"), half("b")), buckets).cast("int").alias("block"))
    placed = settle(placed, "placed")
    needed = placed.select(F.col("block").alias("of_block"), F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = needed.join(_named(docs, members.select("id")), "id").select("of_block", "id", "text")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        sets: dict[int, list[np.ndarray]] = {}  # rows that share an id have several
        ids = right.column("id").to_numpy()
        for block in blocks(right.column("text")):
            row, token, n = token_sets(block, k)
            upto = np.concatenate([[0], np.cumsum(n)])
            for i in range(block.n):
                sets.setdefault(int(ids[block.first + i]), []).append(token[upto[i] : upto[i + 1]].copy())
        a, b = left.column("a").to_pylist(), left.column("b").to_pylist()
        link = [any(_linked(u, v, num, den) for u in sets.get(x, ()) for v in sets.get(y, ())) for x, y in zip(a, b)]
        return pa.table([left.column("a"), left.column("b")], names=["u", "v"]).filter(pa.array(link, pa.bool_()))

    links = placed.groupBy("block").cogroup(texts.groupBy("of_block")).applyInArrow(compare, "u long, v long")
    links = settle(links.unionByName(able.where("same").select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    forget(able, members, placed)
    return links


def _short_pairs(short: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (a, b, lead): of short lists, rows (m1, m2, id, n, room, component, group), the texts in different components that may link.

    m1 and m2 are sums of hashes of a list's ids.  Texts that share one rare
    token mostly share many, so lists with the same sums are paired off once;
    the most room that one of them leaves a text keeps the filter exact.
    """
    once = short.groupBy("m1", "m2", "id").agg(F.min("n").alias("n"), F.max("room").alias("room"), F.min("component").alias("c"), F.min("group").alias("lead"))
    side = lambda i, s: once.select("m1", "m2", F.col("id").alias(i), *(F.col(c).alias(f"{c}{s}") for c in ("n", "room", "c", "lead")))
    pairs = side("a", 1).join(side("b", 2), ["m1", "m2"]).where((F.col("c1") < F.col("c2")) & _may_link(F.col("n1"), F.col("room1"), F.col("n2"), F.col("room2"), num, den))
    return pairs.select("a", "b", F.col("lead1").alias("lead"))


def _left_open(postings: DataFrame, components: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """What the leaders left: of lists whose texts lie in several components, pairs (a, b, lead) and groups (lead, id, n, component).

    Lists of up to SMALL_LIST texts that may still link give pairs, so a text
    has no more than that many in a list.  Longer lists that share a leader are
    one group; the parts of a common token's list have the smallest of their
    leaders.
    """
    member = postings.where(~F.col("closed")).select("token", "id", "n", "room", "lead").join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))

    def several(rows: DataFrame) -> DataFrame:
        # null where they overflow, which SMALL_LIST of them don't
        sums = [F.try_sum(F.shiftrightunsigned(F.xxhash64("id", F.lit(i)), 8)).alias(f"m{i}") for i in (1, 2)]
        return rows.groupBy("token").agg(*sums, F.min("component").alias("c1"), F.max("component").alias("c2"), F.min("n").alias("least"), F.min("lead").alias("group"), F.count(F.lit(1)).alias("size")).where(F.col("c1") < F.col("c2"))

    lists = several(member).select("token", "least", "group")
    # the smallest text of a list is its easiest partner
    able = member.join(lists, "token").where(_may_link(F.col("n"), F.col("room"), F.col("least"), F.col("room"), num, den)).drop("least")
    able = settle(able, "able")
    still = settle(able.join(several(able).select("token", "size", "m1", "m2"), "token"), "open-lists")
    pairs = settle(_short_pairs(still.where(F.col("size") <= SMALL_LIST), num, den).groupBy("a", "b").agg(F.min("lead").alias("lead")), "open-pairs")
    groups = settle(still.where(F.col("size") > SMALL_LIST).groupBy(F.col("group").alias("lead"), "id", "component").agg(F.max("n").alias("n")), "open-groups")
    forget(able, still)
    return pairs, groups


class _Texts:
    """The token sets of a block's texts and their first tokens under three orders; rows that share an id are texts of their own."""

    def __init__(self, table: pa.Table, k: int, num: int, den: int, levels: np.ndarray):
        ids = table.column("of_id").to_numpy()
        tokens, sizes, shown, firsts = [], [], [], [[], [], []]
        for block in blocks(table.column("text")):
            row, token, n = token_sets(block, k)
            size = prefix_sizes(n, num, den)
            rare_first = np.argsort(row * 64 + levels[(token >> _U(64 - CELL_BITS)).astype(np.int64)], kind="stable")
            for found, f in zip(firsts, [token[rare_first][_first(row, n, size)], *_other_firsts(row, token, n, size)]):
                found.append(f)
            tokens.append(token)
            sizes.append(n)
            shown.append(size)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.tokens, self.n, shown = join(tokens, np.uint64), join(sizes, np.int64), join(shown, np.int64)
        self.upto, self.shown = np.concatenate([[0], np.cumsum(self.n)]), np.concatenate([[0], np.cumsum(shown)])
        self.columns = [(mix(join(f, np.uint64)) % _U(_COLUMNS)).astype(np.int32) for f in firsts]
        self.of_id: dict[int, list[int]] = {}
        for i, x in enumerate(ids.tolist()):
            self.of_id.setdefault(x, []).append(i)
        self.num, self.den = num, den

    @staticmethod
    def _ranges(upto: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of all entries of units, number of the unit of each)."""
        size = upto[units + 1] - upto[units]
        row = np.repeat(np.arange(len(units)), size)
        return np.arange(len(row)) + np.repeat(upto[units] - (np.cumsum(size) - size), size), row

    def _shown(self, units: np.ndarray, order: int) -> np.ndarray:
        at, row = self._ranges(self.shown, units)
        out = np.zeros((len(units), _COLUMNS), np.float32)
        out[row, self.columns[order][at]] = 1
        return out

    def _counts(self, some: np.ndarray, all_: np.ndarray) -> np.ndarray:
        """How many tokens each of some shares with each of all_, by products of membership matrices."""
        (at, row), (at2, row2) = self._ranges(self.upto, some), self._ranges(self.upto, all_)
        token, token2 = self.tokens[at], self.tokens[at2]
        kinds = np.intersect1d(token, token2)
        place, place2 = (np.minimum(np.searchsorted(kinds, t), max(len(kinds) - 1, 0)) for t in (token, token2))
        out = np.zeros((len(some), len(all_)))
        hit, hit2 = (kinds[p] == t if len(kinds) else np.zeros(len(t), bool) for p, t in ((place, token), (place2, token2)))
        for begin in range(0, len(kinds), 4096):
            width = min(4096, len(kinds) - begin)
            sides = []
            for n, r, p, h in ((len(some), row, place, hit), (len(all_), row2, place2, hit2)):
                use = h & (p >= begin) & (p < begin + width)
                x = np.zeros((n, width), np.float32)
                x[r[use], p[use] - begin] = 1
                sides.append(x)
            out += sides[0] @ sides[1].T  # below 2**24 in each, so exact
        return out

    def links(self, some: np.ndarray, component: np.ndarray, all_: np.ndarray, component2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (i, j) of linked texts in different components; of one text's links into one component, one."""
        n, n2 = self.n[some][:, None], self.n[all_][None, :]
        open_ = (component[:, None] != component2[None, :]) & (np.minimum(n, n2) * self.den >= np.maximum(n, n2) * self.num) & (np.minimum(n, n2) > 0)
        for order in range(3):
            if open_.any():
                open_ &= (self._shown(some, order) @ self._shown(all_, order).T) > 0
        i, j = np.nonzero(open_)
        if len(i) <= 8 * (len(some) + len(all_)):
            sets = lambda u: self.tokens[self.upto[u] : self.upto[u + 1]]
            both = np.array([_meet(sets(a), sets(b)) for a, b in zip(some[i], all_[j])], np.int64)
        else:
            both = self._counts(some, all_)[i, j].astype(np.int64)
        linked = both * (self.num + self.den) >= (self.n[some[i]] + self.n[all_[j]]) * self.num
        i, j = i[linked], j[linked]
        _, one = np.unique(np.stack([i, component2[j]]), axis=1, return_index=True)
        return i[one], j[one]


def _still_open(cells: DataFrame, profiles: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (cell, id, component, outside, n) of cells (and block): the texts that may link with one of another component on their cell's other side.

    Sizes and bars are compared, of which a text has some 256 bytes, so that
    most texts of a cell, which share rare tokens by chance, never move.
    """
    needed = cells.select(F.col("block").alias("of_block"), F.col("id").alias("of_id")).distinct()
    sizes = needed.join(_named(profiles.select("id", "n", "bars"), cells.select("id")), F.col("of_id") == F.col("id")).select("of_block", "of_id", "n", "bars")

    def sieve(left: pa.Table, right: pa.Table) -> pa.Table:
        of_id: dict[int, list[int]] = {}  # rows that share an id have several
        for i, x in enumerate(right.column("of_id").to_pylist()):
            of_id.setdefault(x, []).append(i)
        n, raw = right.column("n").to_numpy(), right.column("bars").to_pylist()
        fit = np.array([len(x) == BARS for x in raw], bool)
        bars = np.zeros((len(raw), BARS), np.uint8)
        bars[fit] = np.frombuffer(b"".join(x for x in raw if len(x) == BARS), np.uint8).reshape(-1, BARS)
        cell, ids, component, outside = (left.column(c).to_numpy() for c in ("cell", "id", "component", "outside"))
        order = np.argsort(cell, kind="stable")
        edge = np.flatnonzero(np.append(True, cell[order][1:] != cell[order][:-1]))
        keep, size = np.zeros(len(cell), bool), np.zeros(len(cell), np.int64)
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(cell)]):
            sides = []
            for mine in (True, False):
                at = order[a:b][outside[order[a:b]] == mine]
                units = [(r, i) for r, x in zip(at.tolist(), ids[at].tolist()) for i in of_id.get(x, ())]
                sides.append(np.array(units, np.int64).reshape(-1, 2).T)
            (row, some), (row2, all_) = sides
            m, m2 = n[some][:, None], n[all_][None, :]
            open_ = (component[row][:, None] != component[row2][None, :]) & (np.minimum(m, m2) * den >= np.maximum(m, m2) * num) & (np.minimum(m, m2) > 0)
            i, j = np.nonzero(open_)
            for begin in range(0, len(i), _PAIRS):
                x, y = i[begin : begin + _PAIRS], j[begin : begin + _PAIRS]
                new = ~(keep[row[x]] & keep[row2[y]])
                x, y = x[new], y[new]
                s, t = some[x], all_[y]
                both = np.minimum(bars[s], bars[t]).sum(1, dtype=np.int64)
                may = ~(fit[s] & fit[t]) | (both * (num + den) >= (n[s] + n[t]) * num)
                keep[row[x[may]]] = keep[row2[y[may]]] = True
            for r, u in sides:
                np.maximum.at(size, r, n[u])
        return pa.table([pa.array(c[keep]) for c in (cell, ids, component, outside, size)], names=["cell", "id", "component", "outside", "n"])

    kept = cells.groupBy("block").cogroup(sizes.groupBy("of_block")).applyInArrow(sieve, "cell long, id long, component long, outside boolean, n long")
    return settle(kept, "open-cells")


def _links_within(groups: DataFrame, profiles: DataFrame, docs: DataFrame, levels: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """Rows (u, v): links between different components of a group (lead, id, n, component), enough of them to join all components that link.

    Texts outside a group's largest component are compared with all of the
    group.  A cell is up to about REST_TEXTS of the former and PART_TEXTS of the
    latter, and fewer where these have more than REST_TOKENS and PART_TOKENS;
    small groups are one cell, and blocks have several.  What sizes and bars
    exclude is left out before texts move.
    """
    level_of = docs.sparkSession.sparkContext.broadcast(levels)
    by_component = groups.groupBy("lead", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("t"))
    largest = F.max(F.struct("c", "component", "t"))
    sizes = by_component.groupBy("lead").agg(largest.alias("most"), F.sum("c").alias("m"), F.sum("t").alias("t"))
    sizes = sizes.select("lead", "m", "t", F.col("most.component").alias("most"), (F.col("m") - F.col("most.c")).alias("rest"), (F.col("t") - F.col("most.t")).alias("rest_t")).where(F.col("rest") > 0)
    cut = lambda texts, size, tokens, bound: F.ceil(F.greatest(F.col(texts) / size, F.col(tokens) / bound))
    dealt = groups.join(sizes, "lead").withColumns({"r": cut("rest", REST_TEXTS, "rest_t", REST_TOKENS), "g": cut("m", PART_TEXTS, "t", PART_TOKENS)})
    every = dealt.select("lead", "id", "component", F.lit(False).alias("outside"), F.pmod(F.xxhash64("id"), "g").alias("j"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("r") - 1)).alias("i"))
    outside = dealt.where("component != most").select("lead", "id", "component", F.lit(True).alias("outside"), F.pmod(F.xxhash64("id", F.lit(1)), "r").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("j"))
    in_blocks = lambda rows, counted: rows.withColumn("block", F.pmod(F.xxhash64("cell"), F.lit(_loads(*counted.agg(F.count(F.lit(1)), F.sum("n")).first()))).cast("int"))
    dealt_out = settle(in_blocks(every.unionByName(outside).select(F.xxhash64("lead", "i", "j").alias("cell"), "id", "component", "outside"), groups), "cells")
    left_in = _still_open(dealt_out, profiles, num, den)
    placed = in_blocks(left_in, left_in.where(~F.col("outside")))
    needed = placed.select(F.col("block").alias("of_block"), F.col("id").alias("of_id")).distinct()
    texts = needed.join(_named(docs, left_in.select("id")), F.col("of_id") == F.col("id")).select("of_block", "of_id", "text")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        known = _Texts(right, k, num, den, level_of.value)
        cell, ids, component, outside = (left.column(c).to_numpy() for c in ("cell", "id", "component", "outside"))
        order = np.argsort(cell, kind="stable")
        cell, ids, component, outside = cell[order], ids[order], component[order], outside[order]
        edge = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        u, v = [], []
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(cell)]):
            sides = []
            for mine in (outside[a:b], ~outside[a:b]):
                units = [(x, i, c) for i, c in zip(ids[a:b][mine].tolist(), component[a:b][mine].tolist()) for x in known.of_id.get(i, ())]
                sides.append(np.array(units, np.int64).reshape(-1, 3))
            some, all_ = sides
            i, j = known.links(some[:, 0], some[:, 2], all_[:, 0], all_[:, 2])
            u.append(some[i, 1])
            v.append(all_[j, 1])
        return pa.table([np.concatenate(u), np.concatenate(v)], names=["u", "v"])

    links = settle(placed.groupBy("block").cogroup(texts.groupBy("of_block")).applyInArrow(compare, "u long, v long"), "links")
    forget(dealt_out, left_in)
    return links


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: id_col, n_shingles, component_id.

    Two texts link when the Jaccard similarity of their sets of k-word shingles
    is at least percent / 100; component_id is the smallest id that links
    reach.  A text of fewer words has its whole sequence as one shingle; a null
    or empty text has none and links with nothing.  Ids are integers; rows
    that share an id share its component; a null id has none.  Very long texts
    are sets like others.  Extra columns are not read.  Words are told apart by
    64-bit hashes, as are shingles: any two by chance agree once in 2**64.
    """
    num, den = percent, 100
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    profiles = settle(_profiles(rows, k, num, den), "profiles")
    levels = _levels(profiles)
    postings = settle(_postings(rows, levels, k, num, den), "postings")

    fits = _may_link(F.col("n"), F.col("room"), F.col("lead_n"), F.col("lead_room"), num, den)
    stars = postings.where((F.col("id") != F.col("lead")) & fits).select(F.col("lead").alias("a"), F.col("id").alias("b"))
    heads = postings.where((F.col("level") > 0) & (F.col("id") == F.col("lead"))).select("token", "rare", "id", "n", "room")
    chief = heads.groupBy("token").agg(F.min(F.struct("rare", "n", "id", "room")).alias("c"))
    over = heads.join(chief, "token").where((F.col("id") != F.col("c.id")) & _may_link(F.col("n"), F.col("room"), F.col("c.n"), F.col("c.room"), num, den))
    stars = settle(stars.unionByName(over.select(F.col("c.id").alias("a"), F.col("id").alias("b"))).distinct(), "stars")
    sets = profiles.where(F.col("cell").isNull())
    links = _verified(stars.withColumn("lead", F.col("a")), sets, rows, k, num, den)
    components = settle(connected_components(links), "components")

    pairs, groups = _left_open(postings, components, num, den)
    forget(postings, stars, components)
    more = _verified(pairs, sets, rows, k, num, den)
    most = _links_within(groups, sets, rows, levels, k, num, den)
    forget(pairs, groups)
    final = connected_components(links.unionByName(more).unionByName(most))
    forget(links, more, most)
    named = sets.select("id", F.col("n").alias("n_shingles"))
    out = named.join(final, "id", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay, with all their columns: of the texts that links join, those of the one row with the smallest id.

    Rows are told apart by id and text together.  A row whose id is its own goes by
    it; rows that share an id, or have none, are numbered behind the largest id by a
    hash of id and text, so that a text like no other stays whatever its id.  A row
    with an id comes before one without; of rows with one id the smallest number
    stays.  Rows that agree in both are one text and stay together.  Null and empty
    texts link with nothing and stay.
    """
    names = docs.columns
    row, shared_id, gone_row = free_names(docs, "__row", "__shared", "__gone")
    own = F.col(id_col).cast("long")
    ids = docs.select(own.alias(shared_id)).groupBy(shared_id).agg(F.count(F.lit(1)).alias("n"))
    bounds = ids.agg(F.count_if((F.col("n") > 1) | F.col(shared_id).isNull()).alias("shared"), F.coalesce(F.max(shared_id), F.lit(0)).alias("top")).first()
    if bounds["shared"]:
        behind = max(bounds["top"], 0) + 1
        room = (1 << 63) - 1 - behind
        if room < 1 << 61:
            raise ValueError("ids leave no room for numbers of rows that share one")
        shared = settle(ids.where((F.col("n") > 1) & F.col(shared_id).isNotNull()).select(shared_id), "shared-ids")
        number = F.lit(behind) + F.pmod(F.xxhash64(id_col, text_col), F.lit(room))
        docs = docs.join(shared, own == F.col(shared_id), "left").withColumn(row, F.when(F.col(shared_id).isNotNull() | F.col(id_col).isNull(), number).otherwise(own))
        # the rows' texts are read in several jobs: by their new numbers from one table
        docs = settle(docs.drop(shared_id), "numbered")
    else:
        docs = docs.withColumn(row, own)
    found = similar_components(docs, row, text_col, k, percent).withColumnRenamed(row, "row")
    if bounds["shared"]:
        order = F.struct(F.col(id_col).isNull().alias("none"), own.alias("id"), F.col(row).alias("row"))
        rows = docs.select(F.col(row).alias("row"), order.alias("o")).distinct().join(found.distinct(), "row")
        first = rows.groupBy("component_id").agg(F.min("o").alias("first"))
        gone = rows.join(first, "component_id").where(F.col("o.row") != F.col("first.row")).select(F.col("row").alias(gone_row))
    else:
        gone = found.where(F.col("row") != F.col("component_id")).select(F.col("row").alias(gone_row))
    return docs.join(gone.hint("shuffle_hash"), F.col(row) == F.col(gone_row), "left_anti").select(*names)
