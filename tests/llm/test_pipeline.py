"""The pipeline's stages, each against a plain version, and all of them in a row through run()."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from editflow.llm.quality_pu import fit_quality, score_quality
from editflow.llm.secret_scan import scan_secrets

D = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def as_docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", None if t is None else len(t)) for i, t in rows], COLUMNS)


def normal(text):
    return re.sub("[ \t-\r]+", " ", text or "")


def plain_exact(rows):
    """One row of each text: the smallest id, one with an id before one without."""
    best = {}
    for r in rows:
        key = normal(r[1])
        if key not in best or (r[0] is None, r[0] or 0) < (best[key][0] is None, best[key][0] or 0):
            best[key] = r
    return {(r[0], normal(r[1])) for r in best.values()}


def shingles(text, k=5):
    words = [w.lower() for w in re.split("[ \t-\r]+", text or "") if w]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain_near(rows):
    """Rows that stay, from all pairs."""
    texts = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    sets = [shingles(t[2]) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [t for i, t in enumerate(texts) if find(i) == i], [find(i) for i in range(len(texts))]


def test_run_is_its_stages_and_every_stage_a_plain_one(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select(*[c.split()[0] for c in COLUMNS.split(", ")])
    step = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{spark.conf.get('spark.checkpoint.dir')}/{name.replace(' ', '-')}-test"
        stage(spark, before, D).write.mode("overwrite").parquet(path)
        before = step[name] = spark.read.parquet(path)
        assert before.columns == docs.columns
    rows = {name: rows_of(df) for name, df in step.items()}

    # quality: by the score of each text, and clean labelled documents stay
    labels = spark.read.parquet(f"{D}/labels.parquet")
    scores = {r.doc_id: r.score for r in score_quality(docs, fit_quality(docs, labels)).collect()}
    assert {r[0] for r in rows["quality classifier"]} == {i for i, s in scores.items() if s >= 0.7}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good & {r[0] for r in rows["quality classifier"]}) >= 0.95 * len(good)

    # exact copies: one row of each text
    assert {(r[0], normal(r[1])) for r in rows["exact dedup"]} == plain_exact(rows["quality classifier"])

    # near copies: one of each group, from all pairs that share a shingle
    kept = {r[0] for r in rows["n-gram Jaccard join"]}
    given = sorted((r[0], r[1]) for r in rows["exact dedup"])
    sets, holders = {i: shingles(t) for i, t in given}, {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j in {j for g in s for j in holders[g] if j < i}:
            if 5 * len(s & sets[j]) >= 4 * len(s | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert kept == {i for i in sets if find(i) == i} and len(kept) < len(given)

    # secrets: every row stays, and each long secret is gone from the text it was found in
    assert {r[0] for r in rows["secret scans"]} == kept
    found = [r for r in scan_secrets(step["n-gram Jaccard join"]).where("is_secret").collect() if len(r.secret) >= 16]
    after = {r[0]: r for r in rows["secret scans"]}
    assert found and not any(f.secret in after[f.doc_id][1] for f in found)
    same = {r[0]: r for r in rows["n-gram Jaccard join"]}
    touched = {r.doc_id for r in scan_secrets(step["n-gram Jaccard join"]).where("is_secret").collect()}
    assert all(same[i] == after[i] for i in kept - touched)

    # run: the same documents, packed whole
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    packed = corpus_pipeline.run(spark, D).collect()
    by_doc, room = {}, {}
    for p in packed:
        by_doc.setdefault(p.doc_id, []).append(p)
        room[p.sequence_id] = room.get(p.sequence_id, 0) + p.length
    assert by_doc.keys() == kept and max(room.values()) <= 2048
    for i, pieces in by_doc.items():
        ids = whole.encode(after[i][1] or "", add_special_tokens=False).ids + [0]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)


A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))
KEY = "AKIA" + "Q1W2E3R4T5Y6U7I8"


def test_near_copies_of_shared_and_missing_ids(spark):
    """The text of (5, B) is like no other and stays, though (5, A) goes; so do texts without ids that are like no other."""
    rows = [(3, A + " x"), (5, A), (5, B), (None, A + " y"), (None, B + " z"), (None, "gamma delta epsilon zeta eta theta"), (None, None), (None, ""), (7, None), (9, A + " w"), (-4, "gamma delta epsilon zeta eta iota")]
    got = sorted((i is None, i or 0, t or "") for i, t, *_ in rows_of(corpus_pipeline.near_copies(spark, as_docs(spark, rows), D)))
    stay = plain_near(rows)[0]
    assert {t for t in got} == set(stay) and (False, 5, B) in got and (False, 5, A) not in got


@pytest.mark.parametrize("rows", [[(1, A), (1, A), (2, B), (2, B)], [(None, A), (None, A + " x")], [(2, A), (1, A + " x"), (2, B)]])
def test_near_copies_of_repeated_rows(spark, rows):
    got = {(i, t) for i, t, *_ in rows_of(corpus_pipeline.near_copies(spark, as_docs(spark, rows), D))}
    assert got == {(None if none else i, t) for none, i, t in plain_near(rows)[0]}


def test_secrets_of_rows_that_share_an_id(spark):
    """A secret goes from the text it was found in and from no other, whatever the ids; columns of any name stay as they are."""
    words = "with plain words around it that say nothing at all"
    rows = [(1, f"aws key {KEY} {words}"), (1, f"no secret here, {words}"), (None, f"{words} token = {KEY}"), (None, None), (None, ""), (2, f"aws key {KEY} {words}"), (2, f"aws key {KEY} {words}")]
    docs = as_docs(spark, rows).withColumns({"text_hash": F.lit(7), "probability": F.lit("p"), "id": F.lit(True), "secret": F.lit(None).cast("string")})
    out = corpus_pipeline.secrets(spark, docs, D)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows) and not any(KEY in (r.text or "") for r in got)
    assert sorted(r.text for r in got if r.doc_id == 1) == sorted([rows[0][1].replace(KEY, "[secret]"), rows[1][1]])
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert {(r.text_hash, r.probability, r.id) for r in got} == {(7, "p", True)}


def test_every_stage_takes_shared_ids_nulls_and_long_texts(spark):
    long_text = " ".join(f"w{i % 5000}" for i in range(150_000))
    rows = [(1, A), (1, B), (None, A + " q"), (None, None), (2, ""), (2, long_text), (2, long_text), (3, f"{B} {KEY}")]
    docs = as_docs(spark, rows).withColumns({"__row": F.lit(1), "component_id": F.lit(2), "__hash": F.lit(3), "score": F.lit(4.0), "length": F.lit("five")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, D)
        if name == "best-fit packing":
            assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()
            assert out.where("piece = 0").count() == len(rows)
            continue
        assert sorted(out.columns) == sorted(docs.columns), name
        got = out.collect()
        assert {r.text for r in got} <= {t for _, t in rows} or name == "secret scans"
        assert {(r["__row"], r.component_id, r["__hash"], r.score, r.length) for r in got} <= {(1, 2, 3, 4.0, "five")}, name


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, D).count() == 0
