"""The trie of conversations against a plain one, and against SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from editflow.llm import conversation_trie as C
from editflow.llm.queries import QUERIES, SQL

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows, graft=True):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            who, what = role or "", text or ""
            tie = hashlib.sha256(f"{len(who)}:{who}{what}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), tie, (who, what)))
    own = {c: [x[2] for x in sorted(turns)] for c, turns in own.items()}
    sequences = dict(own)
    if graft:
        for c in own:
            base = c - (c % 20 if c >= 0 else -(-c % 20))
            h = zlib.crc32(str(c).encode()) % 4
            sequences[c] = own.get(base, [])[:h] + own[c][h:]
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for key, convs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        kids = [k for k in below if len(k) == len(key) + 1]
        leaves = [k for k in below if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in below)]
        saved = sum((len(members[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) for k in below if k)
        ends = ",".join(str(c) for c in sorted(c for c in convs if sequences[c] == list(key)))
        out.add((min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(df):
    rows = [tuple(r) for r in df.select(*NAMES).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_the_query(spark, size):
    d = f"/root/testdata/{size}"
    mine = found(QUERIES["op13_conversation_trie"](spark, d))
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert mine == plain_trie(rows)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    assert mine == set(c.execute(f"SELECT {', '.join(NAMES)} FROM ({SQL['op13_conversation_trie']})").fetchall())


@pytest.mark.parametrize("seed,shard", [(0, 1), (1, 30), (2, 4096)])
def test_few_turns_in_many_shards(spark, seed, shard):
    """Ids below zero, missing bases, null turns and ties of them, repeated rows, null roles and texts, conversations that end up without turns."""
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-70, 200), 90):
        for t in range(r.choice([1, 1, 2, 4, 6])):
            rows.append((c, r.choice([t, t, None, 0]), r.choice(["user", "bot", None]), r.choice(["", None, "a b", "a b\n\tc", "aé"])))
    rows += [(c, 0, "user", "hi") for c in range(1000, 1040)] + rows[:5] + [(None, 0, "user", "nobody's")]
    mine = found(C.conversation_trie(table(spark, rows), C.Graft(), conversations=shard))
    assert mine == plain_trie(rows)


def test_a_long_conversation_and_its_copies(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2, 3) for t in range(150)] + [(4, t, "user", f"turn {t}" if t < 100 else "else") for t in range(130)] + [(9, 0, "user", "alone")]
    mine = found(C.conversation_trie(table(spark, rows), None, conversations=2, turns=10))
    assert mine == plain_trie(rows, graft=False)
    root = next(x for x in mine if x[1] == 0)
    assert root[3:6] == (5, 2, 3)


def test_one_conversation(spark):
    rows = [(7, 0, "u", "x y"), (7, 1, "u", "z")]
    assert found(C.conversation_trie(table(spark, rows))) == plain_trie(rows, graft=False)


def test_long_texts_and_clashing_columns(spark):
    big = "word " * 200_000
    rows = [(1, 0, "user", big), (2, 0, "user", big), (3, 0, "user", big + "more")]
    wide = table(spark, rows).selectExpr("*", "1 AS key", "2 AS parent", "'x' AS words", "3 AS depth", "4 AS n_convs", "5 AS digest")
    assert found(C.conversation_trie(wide)) == plain_trie(rows, graft=False)


def test_no_rows(spark):
    assert C.conversation_trie(table(spark, [])).count() == 0
    assert C.conversation_trie(table(spark, [(None, 1, "a", "b")]), C.Graft()).count() == 0
    with pytest.raises(ValueError):
        C.conversation_trie(table(spark, []), C.Graft(block=0))


def test_shards_by_hand():
    turns = lambda *names: [(n.encode(), 1) for n in names]
    nodes = list(C._shard_nodes([3, 5, 8], [turns("a", "b"), turns("a"), turns("a", "c")]))
    assert [(n[2], n[3], n[4], n[6]) for n in nodes if n[2] < 2] == [(0, 3, 3, []), (1, 3, 3, [5])]
    assert sorted((n[3], n[4], n[6]) for n in nodes if n[2] == 2) == [(1, 3, [3]), (1, 8, [8])]
