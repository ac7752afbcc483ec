"""The trie of conversations' beginnings, by vertical bitmaps.

Conversations are dealt to shards by ranges of their ids.  A shard indexes what
stands where: for each position and turn a bitset of the conversations that
have that turn there, and for each length one of those that end there.  Depth
first, a node's members are its parent's bitset intersected with the posting of
its turn; popcounts, least members and end lists come off the bitsets.  A node
is named by a chain of hashes over its turns, so that shards' nodes meet by
name, in the order of ids, which lets end lists pass by as a stream.

Sums over subtrees need only nodes with two members or more: below any other
hangs a single path.  They double the distance that they look down in each
round, as deep as the shared part of the trie is, in powers of two.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import forget, settle

#: A shard closes with the first block of ids that brings it to so many conversations or turns.
SHARD_CONVERSATIONS, SHARD_TURNS = 4096, 1 << 16

_NODES = "key binary, parent binary, depth long, n_convs long, conv_id long, words long, ends array<long>"
_MERGED = "key binary, parent binary, depth long, n_convs long, conv_id long, words long, n_ends long, ends_sha256 string"


@dataclass(frozen=True)
class Graft:
    """Beginnings that conversations take over: c has the first h turns of c - c % block, h being crc32 of its decimal id modulo most, and its own behind its first h."""

    block: int = 20
    most: int = 4


def _digested(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (conv_id, turn, digest, words): 128 bits of the SHA-256 of role and text, and the text's words."""
    who, what = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.length(who).cast("string"), F.lit(":"), who, what)
    return rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("digest"), F.regexp_count(what, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")
    )


def _shard_nodes(ids: list[int], sequences: list[list[tuple[bytes, int]]]) -> Iterator[tuple]:
    """Nodes of a shard whose conversations, by ascending id, have these turns (digest, words)."""
    postings: list[dict[bytes, int]] = []
    ends: dict[int, int] = {}
    for i, sequence in enumerate(sequences):
        bit = 1 << i
        while len(postings) < len(sequence):
            postings.append({})
        for place, (digest, _) in zip(postings, sequence):
            place[digest] = place.get(digest, 0) | bit
        ends[len(sequence)] = ends.get(len(sequence), 0) | bit
    stack = [((1 << len(ids)) - 1, 0, b"", None, 0)]
    while stack:
        members, depth, key, parent, words = stack.pop()
        first = (members & -members).bit_length() - 1
        ended = members & ends.get(depth, 0)
        going, done = members ^ ended, []
        while ended:
            low = ended & -ended
            done.append(ids[low.bit_length() - 1])
            ended ^= low
        yield key, parent, depth, members.bit_count(), ids[first], words, done
        while going:
            digest, n = sequences[(going & -going).bit_length() - 1][depth]
            child = going & postings[depth][digest]
            going ^= child
            stack.append((child, depth + 1, hashlib.blake2b(key + digest, digest_size=16).digest(), key, n))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _nodes(turns: DataFrame, graft: Graft | None, conversations: int, most_turns: int) -> DataFrame:
    """The nodes of every shard."""
    block = graft.block if graft else 1

    def base(c: int) -> int:
        return c - (c % block if c >= 0 else -(-c % block))  # the remainder has c's sign, as in SQL

    def close(held: dict[int, list[tuple[bytes, int]]]) -> Iterator[tuple]:
        ids = sorted(held)
        if not graft:
            return _shard_nodes(ids, [held[c] for c in ids])
        sequences = []
        for c in ids:
            h = zlib.crc32(str(c).encode()) % graft.most
            sequences.append(held.get(base(c), [])[:h] + held[c][h:])
        return _shard_nodes(ids, sequences)

    fields = [("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("words", pa.int64()), ("ends", pa.list_(pa.int64()))]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: dict[int, list[tuple[bytes, int]]] = {}
        count, now = 0, None
        for batch in batches:
            for c, digest, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if base(c) != now:
                    if count >= most_turns or len(held) >= conversations:
                        yield from close(held)
                        held, count = {}, 0
                    now = base(c)
                held.setdefault(c, []).append((digest, words))
                count += 1
        if held:
            yield from close(held)

    origin = F.col("conv_id") - F.col("conv_id") % block
    dealt = turns.withColumn("__block", origin).repartitionByRange("__block").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest")
    return dealt.select("conv_id", "digest", "words").mapInArrow(lambda batches: _batches(shards(batches), pa.schema(fields)), _NODES)


def _merged(nodes: DataFrame) -> DataFrame:
    """Shards' nodes of one name as one: members added up, the least of them, and the hash of all ends.  Shards of a node come in the order of their ids."""
    fields = [("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("words", pa.int64()), ("n_ends", pa.int64()), ("ends_sha256", pa.string())]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, total, n_ends, digest = None, 0, 0, hashlib.sha256()
        for batch in batches:
            for key, parent, depth, n, conv, words, ends in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if now is None or now[0] != key:
                    if now is not None:
                        yield (*now[:3], total, *now[3:], n_ends, digest.hexdigest())
                    now, total, n_ends, digest = (key, parent, depth, conv, words), 0, 0, hashlib.sha256()
                total += n
                if ends:
                    digest.update(("," * (n_ends > 0) + ",".join(map(str, ends))).encode())
                    n_ends += len(ends)
        if now is not None:
            yield (*now[:3], total, *now[3:], n_ends, digest.hexdigest())

    dealt = nodes.repartition("key").sortWithinPartitions("key", "conv_id")
    return dealt.mapInArrow(lambda batches: _batches(merge(batches), pa.schema(fields)), _MERGED)


def _subtree_sums(tree: DataFrame) -> DataFrame:
    """Rows (key, above, leaves, saved) of a tree, each with its own figures, to those of whole subtrees; above is null at the root."""
    now = settle(tree, "subtrees")
    while not now.where(F.col("above").isNotNull()).isEmpty():
        # leaves and saved cover what is less than 2^k below, above is the ancestor at 2^k
        lower = now.where(F.col("above").isNotNull()).groupBy("above").agg(F.sum("leaves").alias("__leaves"), F.sum("saved").alias("__saved")).withColumnRenamed("above", "__at")
        upper = now.select(F.col("key").alias("__up"), F.col("above").alias("__above"))
        both = now.join(lower, F.col("key") == F.col("__at"), "left").join(upper, F.col("above") == F.col("__up"), "left")
        added = [(F.col(c) + F.coalesce(F.col(f"__{c}"), F.lit(0))).alias(c) for c in ("leaves", "saved")]
        after = settle(both.select("key", F.col("__above").alias("above"), *added), "subtrees")
        forget(now)
        now = after
    return now.drop("above")


def conversation_trie(
    rows: DataFrame, graft: Graft | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS
) -> DataFrame:
    """One row per distinct beginning of conversations, the root with no turns among them.

    Columns: conv_id, the smallest member; depth; parent_conv_id; n_convs, members;
    n_children; n_leaves, nodes without children in the subtree; saved_tokens, over
    the subtree, each node's members but one times the words of its last text;
    n_ends and ends_sha256, members that end here: the SHA-256 of their decimal ids,
    ascending, with commas.

    Turns go by ``turn``, null first, and rows of one turn by the SHA-256 of role and
    text; equal rows are turns each.  Null role and text are empty.  Rows without a
    conversation's id belong to none.  Turns are told apart by 128 bits of that
    hash.  Extra columns, whatever their names, aren't read.  An empty table has no
    rows, not even a root.  Texts are hashed where they are read and never move; a
    task holds the hashes of a shard, or of its longest block of conversations,
    some hundred bytes a turn.
    """
    if graft and (graft.block < 1 or graft.most < 1):
        raise ValueError("block and most must be positive")
    digests = settle(_digested(rows, conv, turn, role, text), "turns")
    nodes = settle(_merged(_nodes(digests, graft, conversations, turns)), "nodes")
    shared = (F.col("n_convs") > 1) | F.col("parent").isNull()
    below = nodes.where(F.col("parent").isNotNull()).groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single")).withColumnRenamed("parent", "__of")
    top = nodes.where(shared).join(below, F.col("key") == F.col("__of"), "left").drop("__of")
    top = settle(top.withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "single": F.coalesce("single", F.lit(0))}), "shared")
    # the root may have one member, whose path is then its only child
    leaves = F.col("single") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    sums = _subtree_sums(top.select("key", F.col("parent").alias("above"), leaves.cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    names = ["parent", "depth", "n_convs", "conv_id", "n_ends", "ends_sha256"]
    many = top.join(sums, "key").select(*names, "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    one = nodes.where(~shared).select(*names, F.when(F.col("n_ends") == 0, 1).otherwise(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    parents = top.select(F.col("key").alias("__key"), F.col("conv_id").alias("__parent"))
    out = many.unionByName(one).join(parents, F.col("parent") == F.col("__key"), "left")
    # a parent that isn't shared has the same one member
    above = F.when(F.col("parent").isNotNull(), F.coalesce("__parent", "conv_id"))
    return out.select("conv_id", "depth", above.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "n_ends")
