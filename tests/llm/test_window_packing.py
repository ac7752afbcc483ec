"""Order-preserving packing against the tokenizer's library and against all ways to cut."""

import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from editflow.llm import window_packing as W
from editflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    return [e.ids + [2] for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def padded(n, capacity):
    return 0 if n & (n - 1) == 0 else capacity - n


def check(rows, texts, capacity):
    """rows, with keys that are places in texts, are a packing of all of them; returns (padding, tokens)."""
    ids = library_ids(texts)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for key, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids[key])
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[key][p.start : at], "<u4").tobytes())
        assert at == len(ids[key])
    waste = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity and {p.padding for p in pieces} == {padded(at, capacity)}
        waste += padded(at, capacity)
    return waste, sum(map(len, ids))


@pytest.mark.parametrize("seed", range(60))
def test_no_way_to_cut_is_cheaper(seed):
    r = random.Random(seed)
    capacity = r.choice([5, 8, 11, 16])
    places = [0]
    for _ in range(r.randint(1, 10)):
        places.append(places[-1] + r.randint(1, capacity))
    penalty = [0, *(r.choice([0, 1, 3, 7]) for _ in places[1:])]

    def cost(chosen):
        widths = [places[b] - places[a] for a, b in zip(chosen, chosen[1:])]
        return None if max(widths) > capacity else sum(padded(w, capacity) for w in widths) + sum(penalty[i] for i in chosen)

    last = len(places) - 1
    ways = [(0, *some, last) for n in range(last) for some in combinations(range(1, last), n)]
    least = min((cost(w), len(w)) for w in ways if cost(w) is not None)
    chosen, found = W.plan_cuts(np.array(places), np.array(penalty), capacity)
    assert found == cost(chosen.tolist()) and (found, len(chosen)) == least


def test_candidates():
    cuts = W.Cuts(sentence=3, inside=9, long_sentence=20, grain=8)
    places, penalty = W.candidate_cuts(np.array([10, 60, 5]), np.array([0, 0, 1, 2]), np.array([4, 9, 30, 2]), 16, cuts)
    price = dict(zip(places.tolist(), penalty.tolist()))
    assert price[0] == price[10] == price[70] == price[75] == 0
    assert price[4] == price[40] == price[72] == 3
    assert 9 not in price  # before the end token alone
    assert {p for p in price if 10 < p < 59} == {18, 26, 34, 40, 48, 56} and price[18] == 9
    assert all(p in price for p in range(59, 76))


def test_sentences():
    text = 'One two. Three "four?" five,\nsix e.g.) seven'
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = W.word_spans(data, np.array([0, len(data)]))
    words = [text[a:b] for a, b in zip(starts, ends)]
    assert [w for w, stop in zip(words, W._ends_sentence(data, starts, ends)) if stop] == ["two.", '"four?"', "five,", "e.g.)"]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_the_query(spark, size):
    d = f"/root/testdata/{size}"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    place = {r.doc_id: i for i, r in enumerate(docs)}
    rows = QUERIES["op11_window_packing"](spark, d)
    assert set(rows.columns) >= {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    rows = rows.collect()
    moved = [type("Row", (), r.asDict() | {"doc_id": place[r.doc_id]}) for r in rows]
    waste, tokens = check(moved, [r.text for r in docs], 4096)
    assert waste <= 0.02 * tokens + 4096
    order = [place[r.doc_id] for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))]
    assert order == sorted(order)


TEXTS = ["Is it?  Yes, it's 42!\n\nNew line", None, "", " \t\n", "İstanbul ΣΑΣ café  x y 　", "́a b<|endoftext|>c <|startoftext|>", "x" * 5000 + " " + "a1!" * 2000, "don't we'll 'sx ''s", "word. " * 3000]


@pytest.mark.parametrize("capacity,run", [(64, 1 << 21), (100, 500), (4096, 1 << 21), (1, 1 << 21)])
def test_edges(spark, capacity, run):
    rows = [(i, t, 7, 8, 9) for i, t in enumerate(TEXTS * 2)]  # equal texts
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id long, __task long, ids long").coalesce(1)
    got = W.window_packing(docs, PATH, capacity, 2, cuts=W.Cuts(run_tokens=run)).collect()
    check(got, TEXTS * 2, capacity)


def test_shared_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "one two"), (None, "one two"), (5, "three"), (5, "three"), (5, None)], "doc_id long, text string").coalesce(1)
    got = W.window_packing(docs, PATH, 64, 2).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0] == [None, None, 5, 5, 5]
    assert sum(r.length for r in got) == sum(map(len, library_ids(["one two", "one two", "three", "three", ""])))


def test_no_rows_order_and_ids(spark):
    docs = spark.createDataFrame([(3, "c c c"), (1, "a"), (2, "b b")], "doc_id long, text string")
    assert W.window_packing(docs.where("false"), PATH).count() == 0
    got = W.window_packing(docs, PATH, 4096, 2, order_by=("doc_id",), with_ids=True).collect()
    got.sort(key=lambda r: (r.sequence_id, r.offset))
    assert [r.doc_id for r in got if r.start == 0] == [1, 2, 3]
    assert {k: [i for r in got if r.doc_id == k for i in r.ids] for k in (1, 2, 3)} == dict(zip((3, 1, 2), library_ids(["c c c", "a", "b b"])))


def test_long_texts_in_parts(spark, monkeypatch):
    """Texts longer than a block are encoded in parts, which changes nothing."""
    monkeypatch.setattr(W, "BLOCK_BYTES", 50)
    r = random.Random(3)
    text = "".join(r.choice(["a", "bc", "d.", " ", "\n", "e" * 130, "é"]) for _ in range(400))
    data = np.frombuffer(text.encode(), np.uint8)
    block = W.blocks.__globals__["Block"](0, data, np.array([0, len(data)]))
    encode = W.word_encoder(PATH)
    ids, counts, row, place = W._row_tokens(block, encode)
    monkeypatch.setattr(W, "BLOCK_BYTES", 1 << 20)
    whole = W._row_tokens(block, encode)
    assert [2, *ids.tolist()] == [2, *whole[0].tolist()] and counts.tolist() == whole[1].tolist() and not row.any()
    assert place.tolist() == whole[3].tolist()
    assert ids.tolist() == library_ids([text])[0][:-1]


def test_words_by_ranks_are_the_library_s():
    """Letters of every kind below U+0250, signs, digits and contractions, joined at random, and what goes to the library."""
    r = random.Random(5)
    some = [chr(c) for c in range(33, 0x250) if not chr(c).isspace()]
    words = ["".join(r.choice(some) for _ in range(r.randint(1, 9))) for _ in range(3000)]
    words += ["".join(r.choice("abcdefghijklmnopqrstuvwxyzABC") for _ in range(r.randint(1, 30))) for _ in range(3000)]
    words += ["".join(r.choice(["'s", "'LL", "it", "n't", "7", "½", "²", "ª", "ß", "İ", "́", "中", "..", "'", "-"]) for _ in range(r.randint(1, 6))) for _ in range(3000)]
    words = [w for w in dict.fromkeys(words) if w.strip()]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = W.word_spans(data, np.array([0, len(data)]))
    ids, upto = W._word_ids(data, starts, ends, W.word_encoder(PATH))
    upto = np.concatenate([[0], upto])
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == [x[:-1] for x in library_ids([data[a:b].tobytes().decode() for a, b in zip(starts, ends)])]


def test_bad_parameters(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        W.window_packing(docs, PATH, 0)
    with pytest.raises(ValueError):
        W.window_packing(docs, PATH, 64, cuts=W.Cuts(sentence=-1))
    assert W.window_packing(docs, PATH, 64).agg(F.sum("length")).first()[0] == 2
