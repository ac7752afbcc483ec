"""The queries of this subpackage, op1 to op13, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_encode
from .conversation_trie import Graft, conversation_trie
from .decision_list import fit_rules, judge
from .exact_dedup import exact_dedup
from .hmm_lm import score_texts
from .license_scan import license_report
from .ngram_join import similar_components
from .packing import best_fit_packing
from .quality_pu import fit_quality, score_quality
from .secret_scan import scan_secrets
from .spelling_variants import spelling_variants
from .url_filter import Rule, judge_urls
from .window_packing import window_packing

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


URL_RULES = [Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    done = bpe_decode(bpe_encode(_table(spark, sf_dir, "documents"), ranks), ranks)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 10 == 0)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""

def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op8_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = fit_quality(docs.where(fold != 2), labels.where(fold != 2))
    scored = score_quality(docs, model)
    return scored.select("doc_id", (F.coalesce(fold, F.lit(0)) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return judge(docs, fit_rules(docs, _table(spark, sf_dir, "labels")))


def op11_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


#: The unsigned crc32 of the bytes of {0}, bit by bit.
_CRC = "xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(octet_length(encode({0}))), lambda i: [CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"

OP12_SQL = rf"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents),
low AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS m FROM runs WHERE length(r) >= 7 GROUP BY 1, 2),
hashed AS (SELECT w, m, {_CRC.format("s")} AS h FROM low),
words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, CAST(sum(m) AS BIGINT) AS n FROM hashed GROUP BY 1 HAVING sum(m) >= 2 AND length(word) >= 7),
shorter AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
one_less AS (SELECT DISTINCT a.word AS long, a.n AS long_n, b.word AS short, b.n AS short_n FROM shorter a JOIN words b ON a.rest = b.word),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM one_less UNION ALL SELECT short, long, long_n FROM one_less),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY 1),
first AS (SELECT near.word, min(other) AS other FROM near JOIN best ON near.word = best.word AND near.other_n = best.top GROUP BY 1),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * n THEN first.other END AS form, CASE WHEN top >= 10 * n THEN top END AS form_n FROM words LEFT JOIN best ON words.word = best.word LEFT JOIN first ON words.word = first.word),
reach AS (SELECT word, form AS at FROM forms WHERE form IS NOT NULL UNION ALL SELECT reach.word, forms.form FROM reach JOIN forms ON reach.at = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT reach.word, reach.at AS root FROM reach JOIN forms ON reach.at = forms.word WHERE forms.form IS NULL)
SELECT forms.word, form, coalesce(root, forms.word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends ON forms.word = ends.word
"""

def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"), Graft(block=20, most=4))


OP13_SQL = rf"""
WITH own AS (
  SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn_hash, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT conv_id, turn_hash, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, turn_hash) AS p FROM own),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC.format("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (
  SELECT convs.conv_id, p, turn_hash, words FROM convs JOIN placed ON placed.conv_id = convs.base AND p <= h
  UNION ALL SELECT convs.conv_id, p, turn_hash, words FROM convs JOIN placed ON placed.conv_id = convs.conv_id AND p > h),
paths AS (
  SELECT convs.conv_id, coalesce(string_agg(turn_hash, '' ORDER BY p), '') AS path, coalesce(list(words ORDER BY p) FILTER (WHERE words IS NOT NULL), []) AS words
  FROM convs LEFT JOIN rebuilt ON convs.conv_id = rebuilt.conv_id GROUP BY 1),
members AS (SELECT conv_id, d, substr(path, 1, 64 * d) AS k, 64 * d = length(path) AS ended, coalesce(words[d], 0) AS w FROM (SELECT *, unnest(range(len(words) + 1)) AS d FROM paths)),
nodes AS (
  SELECT k, d, count(*) AS n, min(conv_id) AS conv_id, max(w) AS w, count(*) FILTER (WHERE ended) AS n_ends, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM members GROUP BY 1, 2),
kids AS (SELECT substr(k, 1, 64 * (d - 1)) AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
above AS (SELECT substr(a.k, 1, 64 * a.up) AS k, kids.k IS NULL AS leaf, (n - 1) * w AS saved FROM (SELECT *, unnest(range(d + 1)) AS up FROM nodes) a LEFT JOIN kids ON a.k = kids.k),
sums AS (SELECT k, count(*) FILTER (WHERE leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM above GROUP BY 1)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, CASE WHEN x.d > 0 THEN p.conv_id END AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, x.ends_sha256, x.n_ends
FROM nodes x LEFT JOIN nodes p ON x.d > 0 AND p.k = substr(x.k, 1, 64 * (x.d - 1)) AND p.d = x.d - 1 LEFT JOIN kids ON x.k = kids.k JOIN sums ON x.k = sums.k
"""

OP7_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS grams FROM t),
u AS (SELECT doc_id, unnest(grams) AS gram FROM s),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM u x JOIN u y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 85 * (len(x.grams) + len(y.grams) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS r FROM s UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, min(r) AS component_id FROM s JOIN reach ON s.doc_id = reach.id GROUP BY s.doc_id, grams
"""

QUERIES: dict[str, Query] = {q.__name__: q for q in (op1_secret_scan, op2_best_fit_packing, op3_url_filter, op4_byte_bpe, op5_hmm_lm, op6_exact_dedup, op7_ngram_join, op8_quality_pu, op9_license_scan, op10_quality_rules, op11_window_packing, op12_spelling_variants, op13_conversation_trie)}
SQL: dict[str, str] = {"op6_exact_dedup": OP6_SQL, "op7_ngram_join": OP7_SQL, "op12_spelling_variants": OP12_SQL, "op13_conversation_trie": OP13_SQL}
