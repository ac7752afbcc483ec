"""Best-fit packing by bin completion.

Documents become pieces of at most ``capacity`` tokens.  How many pieces have
each length is a table of at most ``capacity`` rows, whatever the corpus, and
packing is planned on it.  Best-fit plans are the first incumbents.  Where they
miss the lower bound, branch and bound completes one sequence after the other
around the largest length left: its undominated fillings are enumerated by
growing waste, each repeated while its lengths last or taken once, and a branch
is pruned when its waste, or the sequences that its rest needs, can't beat the
incumbent.  The plan is small; Spark deals the pieces out to it by their rank
among the pieces of their length.
"""

from __future__ import annotations

import json
import logging
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import PieceIds, encode_block
from .tables import settle
from .text import blocks

#: Steps of the search for a plan, some seconds.
WORK = 4_000_000
_encoders: dict[str, PieceIds] = {}


def byte_characters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_encoder(path: str) -> PieceIds:
    """The ids of pre-tokens by a byte-level BPE tokenizer file, made once in each worker.

    If the file's merges are in the order of the ids they make, ranks say the
    same as merges and the faster library is used.  The strings of special
    tokens are ordinary text.
    """
    if path not in _encoders:
        with open(path) as f:
            model = json.load(f)["model"]
        vocab, byte_of = model["vocab"], byte_characters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab["".join(m)] for m in merges]
        ranked = made == sorted(made) and made[:1] == [256]
        if ranked:
            import tiktoken

            ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if i <= made[-1] and all(c in byte_of for c in t)}
            one = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            one = lambda piece: whole.encode(piece.decode(), add_special_tokens=False).ids
        _encoders[path] = PieceIds(lambda pieces, _: [one(p) for p in pieces])
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Rows (id_col, piece, start, length, ids_crc32[, ids]): every document's tokens, then end_id, in pieces.

    A document longer than capacity is cut into pieces of capacity, all but the
    first, which may be shorter.  Null and empty texts are one piece, end_id.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())] + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_encoder(tokenizer)
        for batch in batches:
            for block in blocks(batch.column(1)):
                ids, counts = encode_block(block, encode)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                counts = counts + 1
                at = np.cumsum(counts) - counts
                n = -(-counts // capacity)
                row = np.repeat(np.arange(block.n), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                head = counts - capacity * (n - 1)
                start = np.where(piece == 0, 0, head[row] + capacity * (piece - 1))
                length = np.where(piece == 0, head[row], capacity)
                frm = at[row] + start
                view = memoryview(ids.tobytes())
                crc = np.fromiter((zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(frm.tolist(), (frm + length).tolist())), np.int64, len(row))
                columns = [batch.column(0).slice(block.first, block.n).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(np.cumsum(length) - length, length.sum()).astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


@dataclass(frozen=True)
class Filling:
    """``times`` sequences, each with these lengths, largest first."""

    times: int
    lengths: tuple[int, ...]


@dataclass(frozen=True)
class Plan:
    """Fillings that use every length as often as it is there; no packing has fewer than ``least`` sequences, nor than this one if ``proven``."""

    fillings: list[Filling]
    sequences: int
    least: int
    proven: bool


def _exact_fillings(lengths: list[int], counts: list[int], room: int, most_waste: int, work: list[int]) -> Iterator[tuple[tuple[int, ...], int]]:
    """(lengths, waste) of all fillings of room by bounded counts of descending lengths, by growing waste up to most_waste.

    reach[i] has a bit for every sum that lengths[i:] can make, so that no
    branch is entered that leads nowhere.  Each step counts against work[0].
    """
    reach = [1] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        sums, n, part = reach[i + 1], min(counts[i], room // lengths[i]), 1
        while n > 0:
            part = min(part, n)
            sums |= sums << part * lengths[i]
            n -= part
            part *= 2
        reach[i] = sums & ((1 << room + 1) - 1)
    work[0] -= len(lengths) + 1
    for waste in range(min(most_waste, room) + 1):
        if not reach[0] >> (room - waste) & 1:
            continue
        stack = [(0, room - waste, ())]
        while stack:
            i, left, chosen = stack.pop()
            work[0] -= 1
            if not left:
                yield chosen, waste
                continue
            while lengths[i] > left or not counts[i]:
                i += 1
            # on top of the stack, and so first: as many of the larger length as can be
            for n in range(min(counts[i], left // lengths[i]) + 1):
                if reach[i + 1] >> (left - n * lengths[i]) & 1:
                    stack.append((i + 1, left - n * lengths[i], chosen + (lengths[i],) * n))


def _dominated(chosen: tuple[int, ...], waste: int, spare: int) -> bool:
    """Whether one of the spare lengths (a bit for each) could stand for some of the chosen ones and leave no more waste, and these be packed elsewhere."""
    one, two = 1, 0
    for x in chosen:
        two |= (one & ~1) << x
        one |= one << x
    if two & spare:
        return True
    return any(one << d & spare for d in range(1, waste + 1))


def _bound(lengths: list[int], counts: list[int], capacity: int) -> int:
    """lower_bound over descending lengths and their counts."""
    pairs = [(x, n) for x, n in zip(lengths, counts) if n]
    best = -(-sum(x * n for x, n in pairs) // capacity)
    if len(pairs) > 64:
        return best  # the sum alone: a bound as well, found faster
    for small in {0, *(x for x, _ in pairs if 2 * x <= capacity)}:
        big = sum(n for x, n in pairs if x > capacity - small)
        middle = [(x, n) for x, n in pairs if x <= capacity - small and 2 * x > capacity]
        held = sum(n for _, n in middle)
        room = held * capacity - sum(x * n for x, n in middle)
        low = sum(x * n for x, n in pairs if small <= x and 2 * x <= capacity)
        best = max(best, big + held + max(0, -(-(low - room) // capacity)))
    return best


def _complete(have: dict[int, int], capacity: int, incumbent: list[Filling], size: int, least: int, work: list[int]) -> tuple[list[Filling], int, bool]:
    """Branch and bound over the fillings of the largest length left: (best plan, its sequences, whether none is better)."""
    lengths = sorted(have, reverse=True)
    at = {x: i for i, x in enumerate(lengths)}
    total = sum(x * n for x, n in have.items())
    seen: dict[tuple[int, ...], int] = {}

    def options(counts: list[int], waste: int) -> Iterator[tuple[tuple[int, ...], int, int]]:
        """(lengths, times, waste of each): a filling as often as it can be, then once, which leaves nothing out."""
        top = next(i for i, n in enumerate(counts) if n)
        rest = counts[:]
        rest[top] -= 1
        room = capacity - lengths[top]
        usable = [i for i in range(top, len(lengths)) if rest[i] and lengths[i] <= room]
        found = _exact_fillings([lengths[i] for i in usable], [rest[i] for i in usable], room, (size - 1) * capacity - total - waste, work)
        for chosen, lost in found:
            used = {x: chosen.count(x) for x in dict.fromkeys(chosen)}
            spare = sum(1 << lengths[i] for i in usable if rest[i] > used.get(lengths[i], 0))
            if len(chosen) <= 24 and _dominated(chosen, lost, spare):
                continue
            whole = (lengths[top], *chosen)
            most = min(counts[at[x]] // whole.count(x) for x in dict.fromkeys(whole))
            yield whole, most, lost
            if most > 1:
                yield whole, 1, lost

    start = [have[x] for x in lengths]
    stack = [(start, 0, 0, options(start, 0))]
    plan: list[Filling] = []
    best = incumbent
    while stack and work[0] > 0 and size > least:
        counts, waste, packed, more = stack[-1]
        option = next(more, None)
        if option is None:
            stack.pop()
            if plan:
                plan.pop()
            continue
        work[0] -= 20 + 2 * len(counts)
        whole, times, lost = option
        waste, packed = waste + times * lost, packed + times
        if waste > (size - 1) * capacity - total:
            continue
        left = counts[:]
        for x in whole:
            left[at[x]] -= times
        if not any(left):
            best, size = [*plan, Filling(times, whole)], packed
            continue
        key = tuple(left)
        if seen.get(key, packed + 1) <= packed or packed + _bound(lengths, left, capacity) >= size:
            continue
        if len(seen) < 200_000:
            seen[key] = packed
        plan.append(Filling(times, whole))
        stack.append((left, waste, packed, options(left, waste)))
    return best, size, size <= least or not stack and work[0] > 0


def _quick_filling(room: int, counts: list[int], mask: int, steps: int) -> tuple[int, ...] | None:
    """Lengths that fill room exactly, larger ones first, if a search of so many steps finds any; mask has a bit for each length that is left."""
    used: dict[int, int] = {}
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, room, ())]
    while stack and steps:
        left, limit, chosen = stack.pop()
        if not left:
            return chosen
        fit = mask & ((1 << min(left, limit) + 1) - 1)
        if not fit:
            continue
        steps -= 1
        x = fit.bit_length() - 1
        used[x] = chosen.count(x)
        stack.append((left, x - 1, chosen))
        if used[x] < counts[x]:
            stack.append((left - x, x, (*chosen, x)))
    return None


def _best_fit(have: dict[int, int], capacity: int, share: float) -> tuple[list[Filling], int]:
    """Around the largest length left the filling with least waste, repeated for a share of the times it could be: (plan, sequences)."""
    left = [0] * (capacity + 1)
    for x, n in have.items():
        left[x] = n
    mask = sum(1 << x for x in have)
    plan, size = [], 0
    while mask:
        top = mask.bit_length() - 1
        left[top] -= 1
        room = capacity - top
        chosen = _quick_filling(room, left, mask if left[top] else mask & ~(1 << top), 400)
        if chosen is None:
            usable = [x for x in range(min(room, top), 0, -1) if left[x]]
            chosen, _ = next(_exact_fillings(usable, [left[x] for x in usable], room, room, [0]))
        left[top] += 1
        whole = (top, *chosen)
        need = {x: whole.count(x) for x in dict.fromkeys(whole)}
        most = min(left[x] // n for x, n in need.items())
        times = max(1, int(most * share)) if most > 8 else most
        for x, n in need.items():
            left[x] -= times * n
            if not left[x]:
                mask &= ~(1 << x)
        plan.append(Filling(times, whole))
        size += times
    return plan, size


def lower_bound(counts: list[int], capacity: int) -> int:
    """No packing has fewer sequences: the sum of lengths, and the bound that keeps large lengths apart from each other."""
    total = sum(i * c for i, c in enumerate(counts))
    best = -(-total // capacity)
    number, weight = np.cumsum([0, *counts]), np.cumsum([0, *(i * c for i, c in enumerate(counts))])
    for small in range(capacity // 2 + 1):
        big = number[capacity + 1] - number[capacity - small + 1]
        middle = number[capacity - small + 1] - number[capacity // 2 + 1]
        room = middle * capacity - (weight[capacity - small + 1] - weight[capacity // 2 + 1])
        lows = weight[capacity // 2 + 1] - weight[small]
        best = max(best, int(big + middle + max(0, -(-(lows - room) // capacity))))
    return best


def _scaled(have: dict[int, int], capacity: int, factor: int, work: int) -> tuple[list[Filling], int]:
    """A plan of the counts divided by factor, each filling that many times as often, and one of what remains."""
    few = plan_packing({x: n // factor for x, n in have.items()}, capacity, work)
    rest = plan_packing({x: n % factor for x, n in have.items()}, capacity, work)
    return [Filling(f.times * factor, f.lengths) for f in few.fillings] + rest.fillings, few.sequences * factor + rest.sequences


def plan_packing(counts: dict[int, int], capacity: int, work: int = WORK) -> Plan:
    """The fewest sequences that hold every length as often as counts says.

    Best-fit plans come first, one that repeats a filling as long as it lasts
    and some that repeat less, so that scarce lengths last longer.  If none
    meets the lower bound, branch and bound starts from the best of them, for
    lengths that are there many times also over the counts divided by a factor.
    ``work`` bounds its steps, a few seconds; a plan that is not proven within
    them says so, and is above the fewest by ``sequences - least`` at most.
    """
    have = {x: n for x, n in sorted(counts.items()) if n}
    dense = [0] * (capacity + 1)
    for length, count in have.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        dense[length] = count
    if not have:
        return Plan([], 0, 0, True)
    least = lower_bound(dense, capacity)
    best, size = None, None
    for share in (1.0, 0.5, 0.25, 0.1):
        plan, n = _best_fit(have, capacity, share)
        if size is None or n < size:
            best, size = plan, n
        if size == least:
            return Plan(best, size, least, True)
    for factor in (max(have.values()), min(have.values()), max(have.values()) // 8):
        if factor > 1 and size > least and len(have) <= 64:
            plan, n = _scaled(have, capacity, factor, work // 8)
            if n < size:
                best, size = plan, n
    best, size, proven = _complete(have, capacity, best, size, least, [work])
    return Plan(best, size, least, proven)


def _log_gap(plan: Plan) -> None:
    if plan.sequences > plan.least and not plan.proven:
        logging.getLogger(__name__).warning("%d sequences, where there are %d at least: not proven to be the fewest", plan.sequences, plan.least)


def pack(
    pieces: DataFrame, capacity: int = 2048, keys: tuple[str, ...] = ("doc_id", "piece"), rows_per_bucket: int = 4096, work: int = WORK, report: Callable[[Plan], None] = _log_gap
) -> DataFrame:
    """The rows of pieces with sequence_id and offset: whole sequences of at most capacity tokens, without gaps.

    ``length`` says how long a piece is.  Pieces are numbered within their
    length in buckets by a hash of ``keys``, so that a length that most pieces
    have is spread over many tasks; what reaches the driver is the number of
    pieces by length and, for each bucket, nothing.  Rows that agree in keys
    are pieces like any others.  ``work`` bounds the search for a plan, and
    ``report`` gets the plan: how many sequences it has, how many there are at
    least, and whether it is proven to be the best; by default a gap is logged.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    found = plan_packing(counts, capacity, work)
    report(found)
    plan = found.fillings
    buckets = max(1, sum(counts.values()) // rows_per_bucket)

    # for each length, the ranges of ranks that a filling takes: key, first rank, per sequence, first sequence, place
    taken: dict[int, int] = dict.fromkeys(counts, 0)
    ranges: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for filling in plan:
        place = 0
        for x in dict.fromkeys(filling.lengths):
            n = filling.lengths.count(x)
            ranges.append((x, taken[x], n, sequence, place))
            taken[x] += n * filling.times
            place += n * x
        sequence += filling.times
    ranges.sort()
    table = np.array(ranges, np.int64).reshape(-1, 5)
    key_of = lambda length, rank: length << 44 | rank
    slots = spark.sparkContext.broadcast((key_of(table[:, 0], table[:, 1]), table))

    # pieces without an id, or of one that many rows share, are spread by their contents
    more = [c for c in ("start", "ids_crc32") if c in pieces.columns]
    bucket = F.pmod(F.xxhash64(*keys, *more), F.lit(buckets)).cast("int")
    rows = pieces.withColumn("__bucket", bucket)
    before = rows.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = before.select(F.col("length").alias("__length"), F.col("__bucket").alias("__b"), (F.sum("__n").over(Window.partitionBy("length").orderBy("__bucket")) - F.col("__n")).alias("__before"))
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("length", "__bucket").orderBy(*keys)))
    ranked = ranked.join(before, (F.col("length") == F.col("__length")) & (F.col("__bucket") == F.col("__b")))
    names = pieces.columns
    ranked = ranked.select(*names, (F.col("__before") + F.col("__rank") - 1).alias("rank"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, rows_of = slots.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            hit = rows_of[np.searchsorted(firsts, key_of(length, rank), "right") - 1]
            j = rank - hit[:, 1]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(hit[:, 3] + j // hit[:, 2]), pa.array(hit[:, 4] + j % hit[:, 2] * length)], names=schema.names)

    return ranked.mapInArrow(place_rows, schema)


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, work: int = WORK, report: Callable[[Plan], None] = _log_gap) -> DataFrame:
    """Tokenise docs, cut, and pack: token_pieces with sequence_id and offset; see pack for work and report.

    Null and empty texts are packed as their end token.  Repeated rows are
    packed each.  Extra columns are not read.  An empty table gives no rows.
    Texts are tokenised once, into a table that planning and placing read.
    """
    pieces = settle(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), "pieces")
    return pack(pieces, capacity, (id_col, "piece"), work=work, report=report)
