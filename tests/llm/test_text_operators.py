"""Operators on texts against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from editflow.llm import bpe, decision_list, exact_dedup, hmm_lm, license_scan, packing, pretokens, queries, quality_pu, secret_scan, statistics, text, url_filter

D = "/root/testdata/sf0.001"
BLANK = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = [(1, "a  b"), (2, "a b"), (3, None), (4, ""), (5, "a\tb"), (6, " "), (7, "long " * 40_000), (8, "Ünï cödé \u00a0 x"), (9, "a b ")]


@pytest.fixture
def docs(spark):
    """With columns that operators use names like themselves."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "k", 1) for i, t in BASE], "doc_id long, text string, lang string, source string, n_chars long, hash string, length int")


@pytest.fixture
def none(docs):
    return docs.where("false")


def test_word_hashes_depend_on_bytes_alone():
    rng = random.Random(1)
    words = {bytes(rng.randrange(33, 127) for _ in range(rng.randrange(1, 9))) for _ in range(5000)}
    line = b" ".join(words)
    data = np.frombuffer(line, np.uint8)
    s, e, _ = text.word_spans(data, np.array([0, len(data)]))
    hashes = text.span_hashes(data, s, e)
    assert len(set(hashes.tolist())) == len(words)
    alone = np.frombuffer(line[s[7] : e[7]], np.uint8)
    assert text.span_hashes(alone, np.array([0]), np.array([len(alone)]))[0] == hashes[7]


def thue_morse(n):
    """Two words of 2**n letters that a polynomial modulo a power of two can't tell apart."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_hashes_of_near_and_long_words():
    words = [*thue_morse(10), *thue_morse(11), "a" * 7, "a" * 8, "a" * 9, "a" * 7 + "b", *(bytes([0]) * i for i in range(1, 30))]
    raw = [w if isinstance(w, bytes) else w.encode() for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw])
    starts = ends - [len(w) for w in raw]
    assert len(set(text.span_hashes(data, starts, ends).tolist())) == len(raw)
    every = np.arange(len(raw))
    for i in range(len(raw)):
        one = np.full(len(raw), i)
        assert (text.equal_spans(data, starts[one], ends[one], data.copy(), starts, ends) == (every == i)).all()


def test_ids_do_not_hang_on_hashes(monkeypatch):
    monkeypatch.setattr(pretokens, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) // np.uint64(3))
    ids = pretokens.PieceIds(lambda pieces, _: [tuple(p) for p in pieces], limit=6)
    rng = random.Random(3)
    for _ in range(20):
        words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 20))).encode() for _ in range(50)]
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        flat, size = ids(data, ends - [len(w) for w in words], ends)
        assert flat.tolist() == list(data) and size.tolist() == [len(w) for w in words]


def test_words_alike_to_polynomials_are_told_apart_by_bpe(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = list(enumerate(thue_morse(10)))
    enc = library("byte_bpe_multi_50k.tiktoken")
    got = bpe.bpe_decode(bpe.bpe_encode(spark.createDataFrame(rows, "doc_id long, text string"), path), path).collect()
    assert all(np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(rows[r.doc_id][1]) and bytes(r.decoded) == rows[r.doc_id][1].encode() for r in got)


# ---- exact dedup


def test_exact_dedup(docs):
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(docs).collect()}
    norm = {i: BLANK.sub(" ", t or "") for i, t in BASE}
    for i, t in norm.items():
        same = [j for j, u in norm.items() if u == t]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (min(same), len(same), i == min(same))
        assert got[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_exact_dedup_tells_collisions_apart(docs):
    weak = lambda t: F.lit(b"\0" * 16)
    strong = {tuple(r) for r in exact_dedup.exact_dedup(docs).collect()}
    assert {tuple(r) for r in exact_dedup.exact_dedup(docs, hash_of=weak).collect()} == strong


def test_exact_dedup_of_odd_rows(spark, docs, none):
    assert exact_dedup.exact_dedup(none).count() == 0
    rows = exact_dedup.exact_dedup(spark.createDataFrame([(1, "x"), (1, "x"), (None, "x"), (None, "y")], "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.group_size, r.kept) for r in rows) == [("1", 3, True), ("1", 3, True), ("None", 1, True), ("None", 3, False)]
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 7, 8, 9]


def test_exact_copies_go_where_ids_are_null_or_shared(spark):
    def left(rows):
        kept = exact_dedup.drop_exact_copies(spark.createDataFrame(rows, "doc_id long, text string, n int"))
        return sorted(str((r.doc_id, r.text)) for r in kept.collect())

    assert left([(None, "A", 1), (1, "A", 2), (None, "B", 3)]) == ["(1, 'A')", "(None, 'B')"]
    assert left([(5, "A", 1), (5, "B", 2), (3, "B", 3)]) == ["(3, 'B')", "(5, 'A')"]
    assert left([(5, "A", 1), (5, "A", 2), (5, "A", 2), (None, "B", 1), (None, "B", 1), (None, None, 1), (None, "", 1)])[:2] == ["(5, 'A')", "(None, 'B')"]
    assert len(left([(None, None, 1), (None, "", 1), (None, "", 1)])) == 1


# ---- pre-tokens, BPE, packing

PIECES = ["'s", "'ll", "'", "s", "re", "ve", "d", " ", "  ", "\n", "\t", "\r\n", "a", "É", "ñ", "1", "٣", "!", "#", "日本", "\u00a0", "\u2003", "\x1c", "\x85", "😀", "'S", "t", "m", "\u0301", "the", "<|endoftext|>"]


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(2)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(4000)] + ["", "a" * 3000, "ab " * 5000, None]


def library(name):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(name)), special_tokens={})


def test_bpe_matches_the_library_and_round_trips(spark, samples):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    df = spark.createDataFrame(list(enumerate(samples)), "doc_id long, text string")
    enc = library("byte_bpe_multi_50k.tiktoken")
    for r in bpe.bpe_decode(bpe.bpe_encode(df, path), path).collect():
        t = samples[r.doc_id] or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (ids, r.n_tokens, bytes(r.decoded)) == (enc.encode_ordinary(t), len(ids), t.encode())


def test_perfect_hash_is_minimal():
    keys = text.mix(np.arange(5000, dtype=np.uint64))
    assert sorted(bpe.PerfectHash(keys).slot_of(keys).tolist()) == list(range(5000))


def test_long_rows_are_cut_where_pre_tokens_begin(samples):
    long = " ".join(s for s in samples[:2000] if s)
    encode = packing.piece_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    data = np.frombuffer(long.encode(), np.uint8)
    parts = list(pretokens.row_chunks(data, 500))
    assert len(parts) > 5 and b"".join(p.tobytes() for p in parts) == long.encode()
    ids = [encode(p, *pretokens.pretoken_spans(p, np.array([0, len(p)]))[:2])[0] for p in parts]
    assert np.concatenate(ids).tolist() == library("byte_bpe_50k.tiktoken").encode_ordinary(long)


def check_packing(rows, capacity):
    bins: dict[int, list] = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, "word " * (i * 7 % 90)) for i in range(150)], "doc_id long, text string"))
    rows = packing.best_fit_packing(df, path, capacity=64).collect()
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    per: dict[int, list] = {}
    for r in rows:
        per.setdefault(r.doc_id, []).append(r)
    assert per.keys() == texts.keys()
    for i, t in texts.items():
        ids = [*whole.encode(t, add_special_tokens=False).ids, 0]
        mine = sorted(per[i], key=lambda r: r.piece)
        assert [r.start for r in mine] == [sum(x.length for x in mine[:k]) for k in range(len(mine))] and sum(r.length for r in mine) == len(ids)
        assert all(r.length == 64 for r in mine[1:])
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert check_packing(rows, 64) <= -(-sum(r.length for r in rows) // 64) + 1
    assert packing.best_fit_packing(none, path).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_every_length_and_come_near_the_bound(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randrange(1, 101) for _ in range(3000))
    plan = packing.plan_packing(counts, 100).fillings
    used = Counter()
    for f in plan:
        assert sum(f.lengths) <= 100
        for x in f.lengths:
            used[x] += f.times
    assert used == counts
    bound = packing.lower_bound([counts.get(i, 0) for i in range(101)], 100)
    assert bound <= sum(f.times for f in plan) <= bound * 1.01 + 1
    with pytest.raises(ValueError):
        packing.plan_packing({101: 1}, 100)


def check_plan(plan, counts, capacity):
    used = Counter()
    for f in plan.fillings:
        assert f.times > 0 and sum(f.lengths) <= capacity
        for x in f.lengths:
            used[x] += f.times
    assert used == Counter(counts) and plan.sequences == sum(f.times for f in plan.fillings) >= plan.least


def fewest(items, capacity):
    """By all subsets: the fewest sequences, and the room left in the last one."""
    best = {0: (1, capacity)}
    for mask in range(1, 1 << len(items)):
        options = []
        for i, x in enumerate(items):
            if mask >> i & 1:
                n, room = best[mask & ~(1 << i)]
                options.append((n, -(room - x)) if x <= room else (n + 1, -(capacity - x)))
        n, room = min(options)
        best[mask] = n, -room
    return best[(1 << len(items)) - 1][0]


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    for _ in range(60):
        capacity = rng.choice([10, 20, 50, 100])
        low = rng.choice([1, capacity // 5, capacity // 3])
        items = [rng.randrange(max(low, 1), max(low + 1, rng.choice([capacity // 2, capacity]))) for _ in range(rng.randrange(1, 11))]
        plan = packing.plan_packing(Counter(items), capacity)
        check_plan(plan, Counter(items), capacity)
        assert plan.proven and plan.sequences == fewest(items, capacity)


def test_perfect_triplets_are_found():
    rng = random.Random(11)
    for n in (6, 9, 12, 15, 20):
        for _ in range(12):
            items = []
            for _ in range(n):
                a = rng.randrange(380, 490)
                b = rng.randrange(250, (1000 - a) // 2)
                items += [a, b, 1000 - a - b]
            plan = packing.plan_packing(Counter(items), 1000)
            check_plan(plan, Counter(items), 1000)
            assert plan.sequences == n


def test_many_copies_of_few_lengths():
    counts = dict.fromkeys([996, 991, 787, 782, 745, 654, 612, 307, 270], 1000)
    plan = packing.plan_packing(counts, 2048)
    check_plan(plan, counts, 2048)
    assert plan.sequences <= 3000 + plan.least * 0.002
    assert packing.plan_packing({}, 10).sequences == 0


# ---- statistics, rules, quality


def brute_counts(t):
    words = WORD.findall(t)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, cover = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            cover.update(range(i, i + 8))
    lines, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_statistics():
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", " ", "b ", "\n", "é ", "\x0b", "#", "a a a a a a a a ", "x y\n", "\r", "\u00a0"]) for _ in range(rng.randrange(60))) for _ in range(2000)] + ["", "\n", " ", "a\na\n", None]
    for block in text.blocks(pa.array(texts), 4000):
        found = statistics.block_counts(block)
        for i in range(block.n):
            assert tuple(int(found[c][i]) for c in statistics.COUNTS[:5]) == brute_counts(texts[block.first + i] or "")


def test_quality_rules(spark, docs, none):
    rows = queries.op10_quality_rules(spark, D).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    for r in rows:
        n = brute_counts(texts[r.doc_id])
        failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (*n, failed)
        assert r.kept == (not failed and r.rule is None)
    assert len(rows) == len(texts)
    assert decision_list.judge(none, []).count() == 0
    assert decision_list.fit_rules(docs, spark.createDataFrame([], "doc_id long, quality int")) == []


def test_decision_lists_learn_and_stop():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    bad = (x["a"] > 0.8) | ((x["b"] < 0.1) & (x["a"] > 0.3))
    rules = decision_list.learn_decision_list(x, bad, np.arange(3000))
    hit = np.zeros(3000, bool)
    for r in rules:
        hit |= decision_list._covers(r, x, 3000)
    assert (hit == bad).mean() > 0.97
    assert decision_list.learn_decision_list(x, rng.random(3000) < 0.05, np.arange(3000)) == []


def test_nnpu_against_the_plain_risk_and_its_prior():
    rng = np.random.default_rng(8)
    for truth in (0.3, 0.6, 0.85):
        good = (rng.random(4000) < truth)[:, None]
        x = lambda g: (rng.random((len(g), 6)) < np.where(g, 0.75, 0.2)).astype(np.float32)
        positive, unlabelled = x(np.ones((3000, 1), bool)), x(good)
        prior = quality_pu.estimate_prior(positive, unlabelled)
        assert prior == pytest.approx(truth, abs=0.08)
        w, b = quality_pu.fit_nnpu(positive, unlabelled, prior)

        def risk(w, b):
            zp, zu = positive @ w + b, unlabelled @ w + b
            return prior * np.logaddexp(0, -zp).mean() + max(0.0, np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())

        # no small step in any direction lowers the risk by more than its weight decay explains
        assert all(risk(w + d, b) > risk(w, b) - 0.01 for d in rng.normal(0, 0.3, (50, 6)))
        assert (((unlabelled @ w + b) > 0) == good[:, 0]).mean() > 0.85


def test_sums_over_a_table_are_those_of_its_rows(spark, docs):
    known = spark.createDataFrame([(0, True), (1, False), (1, True)], "doc_id long, positive boolean")
    table = quality_pu._with_marks(docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))), known, "doc_id", "text").persist()
    assert table.count() == 2 * docs.count() and table.where("positive is null").count() >= docs.count()
    names = list(statistics.shares())
    edges = [[0.1, 0.5]] * len(names)
    rng = np.random.default_rng(2)
    w, thresholds = rng.normal(0, 1, 3 * len(names) + 1), np.array([-3.0, 0.0, 2.0])
    there = quality_pu.TableRows(table, edges)
    here = quality_pu.Rows(quality_pu._one_hot(table.select(*names).toPandas().to_numpy(float), edges))
    assert there.slope(w) == pytest.approx(here.slope(w)) and there.sums(w) == pytest.approx(here.sums(w))
    assert there.reach(w, thresholds) == pytest.approx(here.reach(w, thresholds))
    assert sum(h.slope(w)[0] for h in there.halves()) == len(here.x)
    table.unpersist()


def test_quality_scores_on_held_out_labels(spark, docs, none):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op8_quality_pu(spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, poor = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert sum(a > b for a in good for b in poor) / (len(good) * len(poor)) > 0.9
    blank = quality_pu.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality_pu.score_quality(docs, blank).collect()} == {0.5}
    assert quality_pu.keep_quality(docs, blank, threshold=0.4).columns == docs.columns and quality_pu.score_quality(none, blank).count() == 0


# ---- licenses, secrets, urls

WORDS9 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(license_scan.UPPER, license_scan.UPPER.lower())


def test_license_places(spark, none):
    rng = random.Random(4)
    parts = ["MIT", "License", "mit license", " ", "\n", "Apache", "apache license.", "General public", "public license", "GENERAL PUBLIC LICENSE", "é", "-", "x", "K", "\x00"]
    texts = {i: " ".join(rng.choice(parts) for _ in range(rng.randrange(14))) for i in range(300)} | {1000: None, 1001: "", 1002: "x " * 50_000 + "MIT license"}
    found = license_scan.license_report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert len(found) == len(texts)
    for r in found:
        words = WORDS9.findall((texts[r.doc_id] or "").translate(LOWER))
        places = [(i, label) for i in range(len(words)) for p, label in license_scan.PHRASES.items() if words[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert license_scan.license_report(none).count() == 0


def test_license_spans_join_neighbouring_diagonals(spark):
    notice = next(t for t in license_scan.NOTICES if t.startswith("permission is hereby")).split()
    torn = notice[:20] + ["really"] + notice[20:35] + notice[37:]
    df = spark.createDataFrame([(1, "intro here " + " ".join(torn) + " and more"), (2, " ".join(notice[:12]))], "doc_id long, text string")
    spans = license_scan.license_spans(df).collect()
    assert [(r.doc_id, r.label, r.start, r.end) for r in spans] == [(1, "mit", 2, 2 + len(torn))]


def test_license_words_in_another_order_are_no_license(spark):
    template = license_scan.Template(tuple("licensed under the apache license version 2 0".split()), "apache", False)
    texts = ["version 2 0 licensed under the apache license", "x licensed under the apache license version 2 0", "licensed under the very apache license version 2 0", "version 2 0 of it is licensed under what the apache license says"]
    df = spark.createDataFrame([*enumerate(texts), (None, texts[1]), (None, texts[0]), (7, texts[1]), (7, texts[1])], "doc_id long, text string")
    found = license_scan.license_report(df.selectExpr("*", "1 AS template", "'k' AS key", "2 AS n_words"), [template]).collect()
    assert sorted((str(r.doc_id), r.labels, r.n_words) for r in found) == sorted([("0", "", 8), ("1", "apache", 9), ("2", "apache", 9), ("3", "", 13), ("None", "apache", 9), ("None", "", 8), ("7", "apache", 9), ("7", "apache", 9)])


def test_secrets(spark, docs, none):
    rng = random.Random(5)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'some words here token = "{key()}" and after', "a/b.py") for i in range(40)] + [(100 + i, "averyveryverylongordinaryword appears and 4532015112830366 too", "c") for i in range(40)]
    rows += [(200, None, None), (201, "", "x"), (202, "averyveryverylongordinaryword " * 3 + rows[0][1], "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secret_scan.scan_secrets(df).collect()
    texts = {i: t for i, t, _ in rows}
    assert all(texts[r.doc_id][r.start : r.start + len(r.secret)] == r.secret for r in found)
    assert len(found) == sum(len(re.findall(secret_scan.CANDIDATE, t or "")) for t in texts.values())
    assert all(r.is_secret == (len(r.secret) == 40) for r in found)
    clean = {r.doc_id: r for r in secret_scan.redact(df.withColumn("n_chars", F.length("text").cast("long")), secret_scan.scan_secrets(df)).collect()}
    assert clean.keys() == texts.keys() and clean[3].text == 'some words here token = "[secret]" and after' and clean[3].n_chars == len(clean[3].text)
    assert clean[100].text == texts[100] and clean[200].text is None
    assert secret_scan.scan_secrets(none).count() == 0 and secret_scan.scan_secrets(docs).count() == 0


def test_precision_and_recall_on_planted_findings(spark):
    """Findings that no seed label names: bare keys in prose, and identifiers, paths and numbers with words in them."""
    rng = random.Random(12)
    vocabulary = ["release", "window", "harbour", "signal", "engine", "report", "garden", "letter", "number", "little", "planet", "winter"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    key = lambda: "".join(rng.choice("0123456789abcdefABCDEFGHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz") for _ in range(rng.randrange(28, 44))) + "7x"
    words = lambda: rng.choice(["-", "_", "/"]).join(rng.choice(vocabulary) for _ in range(4)) + rng.choice(["", "-2", "_31", "/v4"])
    rows, planted = [], {}
    for i in range(300):
        kind = i % 4
        if kind == 0:
            text = f'{prose(6)}\napi_key = "{key()}"\n{prose(5)}'
        elif kind == 1:
            text = f"{prose(8)} {''.join(rng.choice(vocabulary) for _ in range(3))} {prose(5)}"
        else:
            item = key() if kind == 2 else words()
            planted[i, item] = kind == 2
            text = f"{prose(7)} {item} {prose(6)}"
        rows.append((i, text, f"src/{i % 7}/file{i}.py"))
    found = {(r.doc_id, r.secret): r.is_secret for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    judged = [(found.get(k, False), truth) for k, truth in planted.items()]
    hits = sum(a and b for a, b in judged)
    assert hits / sum(b for _, b in judged) > 0.9 and hits / max(sum(a for a, _ in judged), 1) > 0.9


def test_dictionary_leaves_out_keys_and_copies(spark):
    key = "Qwzxkj/vbNhtgPlmrk+Zxqw"
    rows = [(i, f"plain words stand here {key} and there") for i in range(20)] + [(100 + i, f"plain words {i}") for i in range(3)] + [(200 + i, "copied rarity") for i in range(20)]
    words = {r.word: (r.n, r.known) for r in secret_scan.dictionary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert words["plain"] == (4, True) and words["rarity"] == (1, False)
    assert not {"qwzxkj", "vbnhtgplmrk", "zxqw"} & words.keys()
    # of words of three random letters, the corpus has each many times
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [(n, " ".join(a + b + c for a in letters for b in letters for c in letters) + f" the {n}") for n in range(6)]
    found = {r.word: r.known for r in secret_scan.dictionary(spark.createDataFrame(noise, "doc_id long, text string")).collect()}
    assert not any(found.values())


def test_short_punctuated_and_dotted_secrets(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcXYZ0123456789!@#$") for _ in range(n)) + "1x"
    lines = ['password = "S3cr3t-pw1"', "pwd: p@$$w0rd!\\E9;", "the S3cr3t-pw1 elsewhere", "api_key='aB3.x$9'", "Authorization: Bearer ab12.cd34.ef", "see abcdefgh01.ijklmnop23.qrs for it", "(secret=q1w2)"]
    rows = [(1, "\n".join(lines), "a")] + [(10 + i, f'password = "{word(8)}" and words', "b") for i in range(40)] + [(100 + i, "averyveryverylongordinaryword here", "c") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [r for r in secret_scan.find_candidates(df).collect() if r.id == 1]
    assert sorted(r.secret for r in found) == sorted(["S3cr3t-pw1", "p@$$w0rd!\\E9", "aB3.x$9", "ab12.cd34.ef", "abcdefgh01.ijklmnop23.qrs", "q1w2"])
    assert all(rows[0][1][r.start : r.start + len(r.secret)] == r.secret for r in found)
    judged = {(r.doc_id, r.secret): r.is_secret for r in secret_scan.scan_secrets(df).collect()}
    assert judged[1, "S3cr3t-pw1"] and not judged[100, "averyveryverylongordinaryword"]
    marked = spark.createDataFrame([(1, x, True) for x in ("S3cr3t-pw1", "p@$$w0rd!\\E9", "aB3.x$9", "q1w2")], "doc_id long, secret string, is_secret boolean")
    clean = {r.doc_id: r.text for r in secret_scan.redact(df, marked).collect()}
    assert clean[1].split("\n") == ['password = "[secret]"', "pwd: [secret];", lines[2], "api_key='[secret]'", *lines[4:6], "(secret=[secret])"]


def test_urls(spark):
    urls = ["http://A.Example.NET/en/x?q=1", "http://a.example.net/de/", "https://net/x", "https://planet/x", "http://x.example.com/de/1#t", "http://x.example.com/de", "https://b.org/fr/1", "nothing", "", None, "http://", "ftp://h.net", "x://y://z.net/", "http://cheappills.example.com/en/1", "http://cheap-pills.example.com/en/2"]
    df = spark.createDataFrame([(i, u, "<p>cheap pills are words of pages, cheap and pills and words</p>", "h") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    rows = {r.page_id: r for r in url_filter.judge_urls(df, queries.URL_RULES).collect()}
    expected = [("a.example.net", "/en/x", "example.net/en/", "allow"), ("a.example.net", "/de/", "net/", "block"), ("net", "/x", "net/", "block"), ("planet", "/x", None, None), ("x.example.com", "/de/1", "example.com/de/", "block"), ("x.example.com", "/de", None, None), ("b.org", "/fr/1", "org/fr/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h.net", "", None, None), ("y:", "//z.net/", None, None)]
    for i, (host, path, rule, verdict) in enumerate(expected):
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), urls[i]
        assert verdict is None or rows[i].verdict == verdict
    assert rows[13].words[:2] == ["h:cheap", "h:pills"] and rows[13].verdict == rows[14].verdict == "block"
    assert url_filter.judge_urls(df.where("false"), queries.URL_RULES).count() == 0


def all_splits(name):
    return [[name]] if len(name) == 1 else [x for rest in all_splits(name[1:]) for x in ([name[0], *rest], [name[0] + rest[0], *rest[1:]])]


def split_cost(parts, cost, unknown):
    return sum(cost.get(p, unknown * len(p)) for p in parts)


@pytest.mark.parametrize("seed", range(40))
def test_splits_match_all_splits(seed):
    r = random.Random(seed)
    name = "".join(r.choices("abc", k=r.randint(1, 10)))
    cost = {"".join(r.choices("abc", k=r.randint(2, 4))): r.uniform(-5, -0.1) for _ in range(12)}
    arcs = [(i, j, cost[name[i:j]]) for i in range(len(name)) for j in range(i + 1, len(name) + 1) if name[i:j] in cost]
    got = url_filter.best_split(name, arcs, -6.0)
    assert "".join(got) == name
    assert split_cost(got, cost, -6.0) == pytest.approx(max(split_cost(s, cost, -6.0) for s in all_splits(name)))


@pytest.mark.parametrize("hot", [3, 1_000])
def test_urls_match_plain_counts(spark, monkeypatch, hot):
    """Unigram counts, the splits' likelihood and naive Bayes's log odds, recounted; one url and null have most rows."""
    monkeypatch.setattr(url_filter, "HOT", hot)
    r = random.Random(5)
    vocabulary = ["cheap", "pills", "garden", "tool", "news", "river", "casino", "rivergardentoolnewsriverg"]
    urls = ["http://" + "".join(r.choices(vocabulary, k=r.randint(1, 2))) + r.choice([".com/", ".org/"]) + "/".join(r.choices(vocabulary, k=2)) for _ in range(60)]
    urls += ["http://rivergardentoolnewsrivergtool.com/en"] + ["http://www.casino.com/x"] * 150 + [None] * 100
    rows = [(None if i % 7 == 0 else i, u, " ".join(r.choices(vocabulary, k=20)), "x") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, words string")
    got = url_filter.judge_urls(df, []).collect()
    assert sorted(map(str, (x.page_id for x in got))) == sorted(str(x[0]) for x in rows)
    runs = Counter(w for x in rows for t in (x[1] or "", x[2]) for w in re.findall("[a-z]{2,}", t.lower()) if len(w) <= url_filter.MAX_WORD)
    total = sum(runs.values())
    cost = {w: math.log(n / total) for w, n in runs.items()}
    tokens = {x[1]: y.words for x in rows if x[1] for y in got if url_parts_of(x[1]) == (y.host, y.path)}
    for url, words in tokens.items():
        host, path = url_parts_of(url)
        split = [w[2:] for w in words if w.startswith("h:")]
        names = re.findall("[a-z]+", host)
        assert "".join(split) == "".join(names) and [w[2:] for w in words if w.startswith("p:")] == re.findall("[a-z]+", path)
        unknown = math.log(0.01 / total)
        assert split_cost(split, cost, unknown) == pytest.approx(sum(best_cost(n, cost, unknown) for n in names))
    seeds = {"h:" + w for w in url_filter.SEED_WORDS}
    bad = Counter(t for w in tokens.values() if seeds & set(w) for t in w)
    good = Counter(t for w in tokens.values() if not seeds & set(w) for t in w)
    kinds, n_bad = len(bad | good), sum(1 for w in tokens.values() if seeds & set(w))
    prior = math.log((n_bad + 1) / (len(tokens) - n_bad + 1))
    for x in got:
        if x.host == "":
            assert x.log_odds is None and x.words is None and x.verdict == "allow"
            continue
        odds = prior + sum(math.log((bad[t] + 1) / (bad.total() + kinds + 1)) - math.log((good[t] + 1) / (good.total() + kinds + 1)) for t in x.words)
        assert x.log_odds == pytest.approx(odds) and x.verdict == ("block" if odds > 0 else "allow")
    assert "h:rivergardentoolnewsriverg" in tokens["http://rivergardentoolnewsrivergtool.com/en"]


def url_parts_of(url):
    host, _, path = url.split("://", 1)[1].partition("/")
    return host, "/" + path


def best_cost(name, cost, unknown):
    """Of all splits into known words and single letters, by the best of each beginning."""
    best = [0.0]
    for end in range(1, len(name) + 1):
        best.append(max([best[end - 1] + unknown, *(best[i] + cost[name[i:end]] for i in range(end) if name[i:end] in cost)]))
    return best[-1]


def test_very_long_and_odd_urls(spark):
    urls = ["http://" + "abcd" * 2_000 + ".com/" + "p/" * 5_000, "http://" + "a." * 2_000 + "com", "http://\u00e4\u00f6.example/\u00fc", "http://-._/", "http://123/4"]
    rows = [(i, u) for i, u in enumerate(urls) for _ in range(2)]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES, html_col=None).collect()
    assert sorted(x.page_id for x in got) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    assert all(x.verdict in ("allow", "block") and x.log_odds is not None for x in got)
    assert next(x for x in got if x.page_id == 3).words == [] and len(next(x for x in got if x.page_id == 1).words) == 2_001


# ---- language model


def test_likelihood_sums_to_one_and_matches_the_plain_recursion():
    rng = np.random.default_rng(1)
    k, kinds = 3, 5
    share = rng.dirichlet(np.ones(kinds))
    emit = rng.dirichlet(np.ones(kinds), k).T
    ratio = emit / share[:, None]
    model = hmm_lm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), ratio)
    lengths = np.array([1, 2, 64, 65, 128, 300, 7])
    classes = rng.integers(0, kinds, lengths.sum())
    known = rng.random(len(classes)) < 0.9
    got = hmm_lm.log10_likelihood_ratio(model, classes, known, lengths)
    at = 0
    for n, g in zip(lengths, got):
        a, logs = model.start.copy(), 0.0
        for t in range(n):
            a = (a if t == 0 else a @ model.move) * (ratio[classes[at + t]] if known[at + t] else 1.0)
            logs += np.log10(a.sum())
            a /= a.sum()
        assert g == pytest.approx(logs, abs=1e-9)
        at += n
    pairs = np.array([(i, j) for i in range(kinds) for j in range(kinds)])
    both = hmm_lm.log10_likelihood_ratio(model, pairs.ravel(), np.ones(pairs.size, bool), np.full(len(pairs), 2))
    assert (10**both * share[pairs[:, 0]] * share[pairs[:, 1]]).sum() == pytest.approx(1)


def test_expected_counts_match_the_plain_recursion(monkeypatch):
    monkeypatch.setattr(hmm_lm, "WHOLE", 20)
    monkeypatch.setattr(hmm_lm, "SEGMENT", 8)
    rng = np.random.default_rng(6)
    k, kinds = 3, 6
    model = hmm_lm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.gamma(2, 1, (kinds, k)))
    lengths = np.array([1, 5, 20, 21, 40, 33, 8, 100])
    classes = rng.integers(0, kinds, lengths.sum())
    emissions, moves, starts = np.zeros((kinds, k)), np.zeros((k, k)), np.zeros(k)
    at = 0
    for n in lengths:
        r = model.ratio[classes[at : at + n]]
        alpha, beta = np.zeros((n, k)), np.ones((n, k))
        for t in range(n):
            alpha[t] = (model.start if t == 0 else alpha[t - 1] @ model.move) * r[t]
            alpha[t] /= alpha[t].sum()
        for t in range(n - 2, -1, -1):
            beta[t] = model.move @ (r[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        gamma = alpha * beta
        gamma /= gamma.sum(1, keepdims=True)
        np.add.at(emissions, classes[at : at + n], gamma)
        starts += gamma[0]
        for t in range(n - 1):
            xi = alpha[t][:, None] * model.move * (r[t + 1] * beta[t + 1])
            moves += xi / xi.sum()
        at += n
    for mine, plain in zip(hmm_lm.expected_counts(model, classes, lengths), (emissions, moves, starts)):
        assert mine == pytest.approx(plain, abs=1e-9)


def test_expected_counts_raise_the_likelihood():
    rng = np.random.default_rng(2)
    segments = [rng.integers(0, 5, 40) + 10 * (i % 2) for i in range(60)]
    length = np.array([40] * 60)
    flat = np.concatenate(segments)
    share = np.bincount(flat, minlength=15) / len(flat)
    model = hmm_lm.start_model(segments, 2, 15, steps=1)
    before = -np.inf
    for _ in range(8):
        now = hmm_lm.log10_likelihood_ratio(model, flat, np.ones(len(flat), bool), length).sum()
        assert now >= before - 1e-6
        before = now
        model = hmm_lm.maximise(*hmm_lm.expected_counts(model, flat, length), share, 0.0)


def test_states_start_from_the_pairs_of_all_texts(spark):
    rng = random.Random(4)
    texts = [None, "", "one"] + [" ".join(f"{'ab'[i % 2]}{rng.randrange(6)}" for _ in range(rng.randrange(1, 40))) for i in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    words = [f"{c}{i}" for c in "ab" for i in range(6)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    begins, ends, _ = text.word_spans(data, np.array([0, len(data)]))
    hashes = text.span_hashes(data, begins, ends)
    order = np.argsort(hashes)
    place = {words[j]: i for i, j in enumerate(order)}
    plain = np.zeros((13, 13))
    for t in texts:
        at = [place.get(w, 12) for w in [*(t or "").split(), None]]
        np.add.at(plain, (at[:-1], at[1:]), 1)
    got = hmm_lm.count_pairs(df, hashes[order])
    assert (got == plain).all()
    model = hmm_lm.pair_model(got, np.arange(12), 2, 15)
    assert model.ratio.shape == (15, 2) and (model.ratio[12:] == model.ratio[12]).all()
    side = {w: int(model.ratio[i].argmax()) for w, i in place.items()}
    assert len({side[w] for w in words[:6]}) == len({side[w] for w in words[6:]}) == 1 and side["a0"] != side["b0"]
    assert np.isfinite(hmm_lm.pair_model(np.zeros((3, 3)), np.arange(2), 4, 3).ratio).all()


def test_language_model(spark, none):
    import math

    rows = queries.op5_hmm_lm(spark, D).collect()
    texts = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    train = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(train.values()), len(train)
    for r in rows:
        t = texts[r.doc_id]
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(train[w] > 0 for w in t), n, zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert hmm_lm.score_texts(none, F.lit(False)).count() == 0
    odd = spark.createDataFrame([(1, None), (None, "a b"), (1, "a"), (2, "A")], "doc_id long, text string")
    got = hmm_lm.score_texts(odd, F.col("doc_id") == 2).collect()
    assert len(got) == 4 and all(r.train_tokens == 6 for r in got)


def test_short_forms_and_bodies_of_licenses(spark):
    mit = (license_scan.LICENSE_TEXTS / "mit.MIT.txt").read_text()
    gpl = (license_scan.LICENSE_TEXTS / "gpl.GPL-3.txt").read_text()
    middle = gpl[gpl.index("5. Conveying Modified") : gpl.index("6. Conveying Non-Source")]
    texts = {
        1: ("Text. Licensed under CC BY-NC 4.0. More", "cc"), 2: ("under CC BY 3.0", "cc"), 3: ("# SPDX-License-Identifier: GPL-2.0-or-later", "gpl"), 4: ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache,mit"),
        5: (mit[mit.index("THE SOFTWARE IS") :], "mit"), 6: (middle, "gpl"), 7: (gpl, "gpl"), 8: ((license_scan.LICENSE_TEXTS / "lgpl.LGPL-2.1.txt").read_text(), "lgpl"), 9: ("licensed under nothing, version 4.0", ""),
        10: ((license_scan.LICENSE_TEXTS / "apache.Apache-2.0.txt").read_text(), "apache"), 11: ("SPDX-License-Identifier: Apache-2.0 OR MIT", "apache,mit"),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.license_report(df).collect()}
    assert {i: r.labels for i, r in found.items() if i not in (7, 8)} == {i: label for i, (_, label) in texts.items() if i not in (7, 8)}
    # the whole text, which also names others' phrases
    assert "gpl" in found[7].labels.split(",") and "lgpl" in found[8].labels.split(",") and found[7].score == found[8].score == 1


def test_templates_of_any_length(spark):
    words = [f"w{i}" for i in range(200)]
    whole = license_scan.Template(tuple(words), "long", False)
    torn = words[:70] + ["x"] * 20 + words[75:]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "a b " + " ".join(torn)), (3, " ".join(words[:100]))], "doc_id long, text string")
    spans = {r.doc_id: r for r in license_scan.license_spans(df, [whole]).collect()}
    assert {i: (r.start, r.end) for i, r in spans.items()} == {1: (0, 200), 2: (2, 217)} and spans[1].coverage == 1 and spans[2].coverage == 191 / 198


def test_license_rows_that_share_an_id(spark):
    words = [f"w{i}" for i in range(20)]
    template = [license_scan.Template(tuple(words), "long", False), license_scan.Template(("mit", "license"), "mit", True)]
    whole, halves = " ".join(words), (" ".join(words[:9]), " ".join(words[9:]))
    rows = [(1, halves[0]), (1, halves[1]), (None, "mit license"), (None, "MIT license x"), (None, None), (2, whole), (2, whole), (3, ""), (3, ""), (4, "mit license"), (4, "mit license")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(str((r.doc_id, r.n_words, r.n_base, r.labels)) for r in license_scan.license_report(df, template).collect())
    expected = [(1, 9, 0, ""), (1, 11, 0, ""), (None, 2, 1, "mit"), (None, 3, 1, "mit"), (None, 0, 0, ""), (2, 20, 0, "long"), (2, 20, 0, "long"), (3, 0, 0, ""), (3, 0, 0, ""), (4, 2, 1, "mit"), (4, 2, 1, "mit")]
    assert got == sorted(map(str, expected))
    spans = license_scan.license_spans(df, template).collect()
    assert sorted(str(r.doc_id) for r in spans) == ["2", "2", "4", "4", "None", "None"]


def test_a_notice_that_stands_in_a_row(spark):
    """The places of every repeat are found, and the work grows with their number and not with its square."""
    words, n = "licensed under the apache license version 2 0 ", 20_000
    r = license_scan.license_report(spark.createDataFrame([(1, words * n)], "doc_id long, text string")).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) == (8 * n, n, 3, 8 * n - 5, "apache", 1.0)


def test_very_many_candidates_in_one_text(spark):
    n = 30_000
    text = " ".join(f"key{i:013d}Ab" for i in range(n)) + " pwd: q1"
    found = secret_scan.find_candidates(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).collect()
    assert len(found) == n + 1 and all(text[r.start : r.start + len(r.secret)] == r.secret for r in found)
    assert all(text[max(0, r.start - 60) : r.start] == r.before and text[r.start + len(r.secret) :][:40] == r.after for r in found[::97])


def test_the_features_of_candidates_counted_plainly(spark):
    """Length, make-up, transitions and dictionary coverage of every candidate, from the words of all texts."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    found, words = secret_scan.find_candidates(docs), secret_scan.dictionary(docs)
    texts = {r.text for r in docs.select("text").collect() if r.text}
    counts = {}
    for t in texts:
        bare = t
        for pattern in (secret_scan.NAMED, secret_scan.DOTTED, secret_scan.CANDIDATE):
            bare = re.sub(pattern, " ", bare)
        for w in {w for w in re.split("[^a-z]+", bare.lower()) if len(w) >= 3}:
            counts[w] = counts.get(w, 0) + 1
    assert {r.word: r.n for r in words.collect()} == counts
    of_size = {}
    for w, n in counts.items():
        of_size[len(w)] = of_size.get(len(w), 0) + n
    known = {w for w, n in counts.items() if n > 1 and n > secret_scan.ABOVE_CHANCE * of_size[len(w)] / 26 ** len(w)}
    assert {r.word for r in words.where("known").collect()} == known
    pairs, starts = {}, {}
    for w, n in counts.items():
        for a, b in zip(w, w[1:]):
            pairs[a, b] = pairs.get((a, b), 0) + n
            starts[a] = starts.get(a, 0) + n

    def kind(c):
        return c if "a" <= c <= "z" else "0" if c.isdigit() else ""

    rows = secret_scan.describe(found, words).collect()
    assert len(rows) > 20
    for r in rows:
        s, low = r.secret, [kind(c) for c in r.secret.lower()]
        cost = sum(-math.log2((pairs.get((a, b), 0) + 0.5) / (starts.get(a, 0) + 14)) for a, b in zip(low, low[1:]))
        covered = sum(len(w) for w in re.split("[^a-z]+", s.lower()) if w in known)
        want = (len(s), len(set(s)) / len(s), len(re.findall("[a-z](?=[A-Z])", s)) / len(s), len(re.findall("[^A-Za-z0-9]", s)) / len(s), cost / len(s), covered / len(s))
        assert np.allclose([r.length, r.distinct_share, r.case_switches, r.symbol_share, r.transition, r.dictionary], want)


def test_a_plan_reports_its_gap(spark, caplog):
    """Six thirds and more of a sequence leave gaps that no search closes; without work the plan is unproven, and says so."""
    sizes = [340, 341, 343, 347, 353, 359, 367, 373, 379, 383, 389, 397, 401, 409]
    rows = spark.createDataFrame([(i, 0, n) for i, n in enumerate(sizes * 3)], "doc_id long, piece int, length long")
    plans = []
    packed = packing.pack(rows, 1000, report=plans.append)
    assert packed.select("sequence_id").distinct().count() == plans[0].sequences >= plans[0].least
    with caplog.at_level("WARNING"):
        packing.pack(rows, 1000, work=1)
    lazy = packing.plan_packing({n: 3 for n in sizes}, 1000, 1)
    assert ("not proven" in caplog.text) == (lazy.sequences > lazy.least and not lazy.proven)


def test_pieces_without_an_id_are_packed_each(spark):
    docs = spark.createDataFrame([(None, "one two three")] * 5 + [(None, None), (1, "a"), (1, "a"), (1, "b")], "doc_id long, text string").withColumns({"sequence_id": F.lit(1), "length": F.lit("x"), "__bucket": F.lit(2)})
    got = packing.best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=16, end_id=0).collect()
    assert len(got) == 9 and sorted((r.doc_id is None, r.length) for r in got) == sorted([(True, 4)] * 5 + [(True, 1)] + [(False, 2)] * 3)
    rooms = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert rooms.get(r.sequence_id, 0) == r.offset
        rooms[r.sequence_id] = r.offset + r.length
    assert max(rooms.values()) <= 16 and len(rooms) == 2
