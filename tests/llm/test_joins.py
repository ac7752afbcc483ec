import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from editflow.llm import components, ngram_join


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    common = defaultdict(int)
    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    for members in lists.values():
        for n, a in enumerate(members):
            for b in members[:n]:
                common[b, a] += 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("seed, k, percent", [(0, 4, 85), (1, 2, 60), (2, 5, 80)])
def test_components_match_brute_force(spark, seed, k, percent):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(41))) for _ in range(12)]
    rows = []
    for i in range(400):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            if w:
                w[rng.randrange(len(w))] = rng.choice("abcdefghijkl")
        rows.append((i * 7 - 300, " ".join(w)))
    rows += [(5000, None), (5001, ""), (5002, "one"), (5003, "ONE"), (5004, "a b c"), (5005, "A b\tC"), (5006, "word " * 30_000)]
    got = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), k=k, percent=percent).collect()
    expected = brute(rows, k, percent)
    assert len(got) == len(rows)
    assert all((r.n_shingles, r.component_id) == expected[r.doc_id] for r in got)


def test_a_group_whose_links_all_lead_to_one_text(spark):
    """Copies that are similar to the original but not to each other."""
    words = [f"w{i}" for i in range(200)]
    rows = [(50, " ".join(words))]
    for i in range(30):
        w = words[:]
        for j in range(4):
            w[i * 6 + j + 5] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), k=4, percent=90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 4, 90)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = spark.createDataFrame([(3, text, 1), (3, text, 1), (None, text, 1), (4, text, 1)], "doc_id long, text string, n int")
    got = ngram_join.similar_components(rows).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == sorted([("3", 26, 3), ("3", 26, 3), ("4", 26, 3), ("None", 26, None)], key=str)
    assert ngram_join.similar_components(rows.where("false")).count() == 0


def test_connected_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)] + [(None, 5), (7, 7)]
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}


def test_lists_of_the_same_texts_are_paired_off_once(spark):
    """Three lists of texts 1, 2 and 3, which leave different room, and one of 1 and 4."""
    rows = [(7, 70, i, 100, room, i, 1) for room in (40, 90, 60) for i in (1, 2, 3)] + [(8, 80, 1, 100, 95, 1, 1), (8, 80, 4, 100, 95, 1, 1), (9, 90, 2, 100, 10, 2, 2), (9, 90, 5, 100, 99, 5, 2)]
    short = spark.createDataFrame(rows, "m1 long, m2 long, id long, n int, room int, component long, group long")
    got = sorted(map(tuple, ngram_join._short_pairs(short, 80, 100).collect()))
    # 1 and 4 lie in one component; of 2 and 5 too little is left
    assert got == [(1, 2, 1), (1, 3, 1), (2, 3, 1)]


@pytest.mark.parametrize("sizes", [{"REST_TEXTS": 16, "PART_TEXTS": 40, "BLOCK_TEXTS": 50}, {"REST_TOKENS": 1500, "PART_TOKENS": 4000, "BLOCK_TOKENS": 5000}])
def test_a_large_family_just_below_the_threshold(spark, monkeypatch, sizes):
    """Variants that share rare words: some link, most don't quite; groups are dealt to several cells, by texts or by tokens."""
    for name, value in {"SMALL_LIST": 4, **sizes}.items():
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(160):
        w = words[:]
        for j in rng.sample(range(120), rng.choice([1, 2, 3, 3, 4])):
            w[j] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(w)))
    rows += [(500 + i, " ".join(rng.choice(words) for _ in range(100))) for i in range(40)]
    expected = brute(rows, 4, 80)
    assert 5 < len({c for _, c in expected.values()}) - 40 < 155
    got = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), k=4, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_texts_that_share_words_by_chance_leave_their_cell_without_moving(spark):
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(1000)}" for _ in range(n)]
    base, long = words(200), words(200)
    texts = {i: ["one", "two", "three", "four", *words(200)] for i in range(40)}
    texts |= {100: base, 101: [*base, "x"], 102: base, 103: ["same"] * 70_000, 104: ["same"] * 300 + long, 105: []}
    profiles = ngram_join._profiles(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "id long, text string"), 4, 85, 100).where("cell is null")
    # 102 is in the component of 100, and 101 in another cell as well, where it is alone with what is unlike it
    cells = [(7, i, 100 if i == 102 else i, o, 0) for i in texts for o in (False, True)] + [(8, i, i, o, 0) for i in (101, 1, 2) for o in (False, True)]
    got = ngram_join._still_open(spark.createDataFrame(cells, "cell long, id long, component long, outside boolean, block int"), profiles, 85, 100).collect()
    assert sorted((r.cell, r.id, r.component, r.outside) for r in got) == [(7, i, c, o) for i, c in ((100, 100), (101, 101), (102, 100)) for o in (False, True)]
    assert {r.n for r in got} == {197, 198}


def test_counts_by_matrices_are_exact(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60))) for _ in range(90)] + [""]
    table = pa.table({"of_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    known = ngram_join._Texts(table, 2, 50, 100, np.zeros(1 << ngram_join.CELL_BITS, np.uint8))
    every = np.arange(len(texts))
    sets = [{tuple(t.split()[i : i + 2]) for i in range(max(len(t.split()) - 1, min(len(t.split()), 1)))} for t in texts]
    assert (known._counts(every[:20], every) == [[len(a & b) for b in sets] for a in sets[:20]]).all()
    i, j = known.links(every, every, every, every)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in every for b in every if a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= 50 * len(sets[a] | sets[b])}


def test_words_alike_to_polynomials_do_not_link(spark):
    a = "a"
    for _ in range(10):
        a += a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a), (2, a.translate(str.maketrans("ab", "ba"))), (3, a.upper())]
    got = {r.doc_id: r.component_id for r in ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), k=4, percent=85).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
