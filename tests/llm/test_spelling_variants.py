"""Spelling variants against plain counts and all pairs."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from editflow.llm import spelling_variants as V
from editflow.llm.queries import QUERIES, SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a != b and (a[same + 1 :] == b[same + 1 :] if len(a) == len(b) else len(b) == len(a) + 1 and a[same:] == b[same + 1 :])


def plain_groups(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) if near[w] else None for w in counts}
    form = {w: b if b and counts[b] >= ratio * counts[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def as_set(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_the_query_against_sql(spark):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    found = c.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({SQL['op12_spelling_variants']})").fetchall()
    mine = as_set(QUERIES["op12_spelling_variants"](spark, d))
    assert mine == set(found) and len(found) > 500


def test_the_query_against_all_pairs(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    counts = plain_counts(rows)
    mine = as_set(QUERIES["op12_spelling_variants"](spark, d))
    assert {(w, n) for w, _, _, n, _, _ in mine} == set(counts.items())
    some = dict(random.Random(1).sample(sorted(counts.items()), 300))
    near = {w: sum(one_edit(w, v) for v in counts) for w in some}
    assert {(w, k) for w, _, _, _, k, _ in mine if w in some} == set(near.items())


@pytest.mark.parametrize("seed,limit", [(0, 4), (1, 20), (2, 1 << 14)])
def test_dense_words(spark, seed, limit):
    """Few symbols, runs of one symbol and edits at both ends; partitions divided down to the last symbol."""
    r = random.Random(seed)
    words = {"".join(r.choice("abé") for _ in range(r.randint(7, 10))) for _ in range(150)} | {"a" * n for n in range(7, 14)} | {"a" * 7 + "b", "b" + "a" * 7}
    words |= {w[:-1] + "c" for w in list(words)[:20]} | {"c" + w[1:] for w in list(words)[:20]}
    words = {w: r.choice([2, 3, 20, 30, 300]) for w in words if len(w) >= 7}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [(x.word, x.other) for x in V.near_pairs(table, limit).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert as_set(V.variant_groups(table, 10, limit)) == plain_groups(words)


def test_acceptor():
    words = sorted({"taps", "tap", "tops", "top", "", "s"})
    a = V.Acceptor(words)

    def accepted(q, at, word):
        out = [(at, word)] if a.final[q] else []
        for c, (to, before) in a.arcs[q].items():
            out += accepted(to, at + before, word + c)
        return out

    assert sorted(accepted(a.start, 0, "")) == list(enumerate(words))
    assert len(a.arcs) == 5  # "", "s" | t | a, o | p | final
    assert a.count[a.start] == 6 and a.low[a.start] == 0 and a.high[a.start] == 4


def test_checksums():
    r = random.Random(0)
    data = np.frombuffer(bytes(r.randrange(256) for _ in range(4000)), np.uint8)
    starts = np.array([r.randrange(3000) for _ in range(200)])
    ends = starts + np.array([r.choice([0, 1, 7, 48, 49, 300]) for _ in range(200)])
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(200)], np.uint32)
    found = V._checksums(data, starts, ends, before)
    assert found.tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]


def test_texts(spark):
    long_word = "qwertzu" * 300
    rows = [
        (1, "Example EXAMPLE exampla Éxample éxample example2example"), (1, "Example EXAMPLE exampla Éxample éxample example2example"), (None, "Example, example"), (None, None), (2, ""), (3, " \n "),
        (4, f"{long_word} {long_word}x {long_word}x"), (5, f"{long_word} ×÷×÷×÷× ×÷×÷×÷× Āxample xampleĀample 中example中"),
        (6, "Exampls " * 3 + "examples " * 40), (7, "examplesx examplesx " * 2),
    ]
    docs = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], "doc_id long, text string, n long, word string, form int")
    counts = plain_counts(rows)
    assert len(counts) >= 8 and long_word in counts
    assert as_set(V.spelling_variants(docs)) == plain_groups(counts)


def test_chains_are_followed_to_their_ends(spark):
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000, "abcdefghijkl": 200000}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r.root for r in V.variant_groups(table).collect()} == {"abcdefghijkl"}


def test_no_rows_and_bad_parameters(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert V.spelling_variants(docs).count() == 0
    with pytest.raises(ValueError):
        V.word_counts(docs, shortest=6)
    with pytest.raises(ValueError):
        V.variant_groups(spark.createDataFrame([], "word string, n long"), ratio=1)
