"""URL filters: rules by host and path, and for the rest naive Bayes over segmented host names and path tokens.

Names of hosts are often words written together.  A unigram model of the pages'
words splits each name of a distinct host by the Viterbi recursion; its arcs,
the substrings that are words, come from a join with the word counts.  A
multinomial naive Bayes model over host words and path tokens then weighs each
distinct url.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import settle

#: Longest word of the unigram model: a label of a host has 63 octets at most, so no longer word lies in a valid one.
MAX_WORD = 63
#: Copies of a small side of a join, so that a hot key is spread over as many tasks.
SALTS = 16
#: A key with more than one in so many rows is hot.  There are fewer hot keys than this, whatever the input's size.
HOT = 1_000

# Words of hosts that nobody wants to train on; they label the urls that naive Bayes learns from.
SEED_WORDS = "ads adult adware bet bets betting casino cheap dating escort free gambling jackpot loan loans lottery malware payday phishing pills poker porn sex slots spam torrent track tracker viagra warez win xxx".split()


@dataclass(frozen=True)
class Rule:
    """Fits the host and its subdomains where the path starts with the rule's path."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and for urls without `://`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.regexp_extract(F.coalesce(url, F.lit("")), pattern, i)
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits; null without one."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def word_counts(pages: DataFrame, url_col: str, html_col: str | None) -> DataFrame:
    """Rows (word, n): the runs of two or more ASCII letters in html and urls, lower-case, up to MAX_WORD long."""
    texts = [pages.select(F.col(c).alias("t")) for c in (url_col, html_col) if c]
    runs = [t.select(F.explode(F.split(F.lower("t"), "[^a-z]+")).alias("word")) for t in texts]
    both = runs[0] if len(runs) == 1 else runs[0].unionByName(runs[1])
    return both.where(F.length("word").between(2, MAX_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def best_split(name: str, arcs: list[tuple[int, int, float]], unknown: float) -> list[str]:
    """Viterbi: the split of name with the highest sum of log probabilities; characters no word covers cost `unknown` each.

    Neighbouring characters without a word stay together.  Ties go to the
    longer last word.
    """
    at: list[list[tuple[int, float]]] = [[] for _ in range(len(name) + 1)]
    for start, end, cost in arcs:
        at[end].append((start, cost))
    best: list[tuple[float, int, bool]] = [(0.0, 0, False)]
    for end in range(1, len(name) + 1):
        choice = (best[end - 1][0] + unknown, end - 1, False)
        for start, cost in sorted(at[end]):
            if best[start][0] + cost > choice[0]:
                choice = (best[start][0] + cost, start, True)
        best.append(choice)
    out, end, open_run = [], len(name), False
    while end:
        _, start, known = best[end]
        if known or not open_run:
            out.append(name[start:end])
        else:
            out[-1] = name[start:end] + out[-1]
        open_run, end = not known, start
    return out[::-1]


def segment_names(names: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (name, words): each distinct name split into words of the unigram model.

    A name that is a frequent word itself stays whole if its probability is
    above that of its parts.
    """
    total = words.agg(F.sum("n")).first()[0] or 1
    unknown = math.log(0.01 / total)
    names = names.select("name").distinct()
    starts = names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("start"))
    parts = starts.select("name", "start", F.explode(F.expr(f"sequence(start + 1, least(start + {MAX_WORD}, length(name)))")).alias("end"))
    parts = parts.select("name", "start", "end", F.expr("substring(name, start + 1, end - start)").alias("word"))
    arcs = parts.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("start", "end", F.log(F.col("n") / total).alias("cost"))).alias("arcs"))
    known = names.join(arcs, "name", "left")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [best_split(r["name"], [(a["start"], a["end"], a["cost"]) for a in r["arcs"] or ()], unknown) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["name", "words"])

    return known.mapInArrow(split, "name string, words array<string>")


def _salted(df: DataFrame, on: str) -> DataFrame:
    """One of SALTS salts for each row, by a hash of the other columns."""
    return df.withColumn("__salt", F.pmod(F.xxhash64(*[c for c in df.columns if c != on]), F.lit(SALTS)))


def _copies(df: DataFrame) -> DataFrame:
    return df.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))


def _spread_join(many: DataFrame, few: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """many joined with few, which has each value of on once.

    Rows of hot keys are dealt to SALTS tasks, and their row of few goes to all
    of these; the broadcast table has the hot keys only, fewer than HOT.  Rows
    without a key match nothing and are dealt out too.
    """
    total = many.count()
    counted = many.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("__n"))
    hot = F.broadcast(counted.where(F.col("__n") * HOT > total).select(F.col(on).alias("__hot")))
    is_hot = F.col("__hot").isNotNull()
    dealt = F.pmod(F.xxhash64(*[c for c in many.columns if c != on]), F.lit(SALTS))
    left = many.join(hot, F.col(on) == F.col("__hot"), "left").withColumn("__salt", F.when(is_hot | F.col(on).isNull(), dealt).otherwise(0)).drop("__hot")
    copies = F.sequence(F.lit(0), F.when(is_hot, SALTS - 1).otherwise(0)).cast("array<bigint>")
    right = few.join(hot, F.col(on) == F.col("__hot"), "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    return left.join(right, [on, "__salt"], how).drop("__salt")


def url_tokens(urls: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (url, tokens): the words of the host's names, marked h:, and the tokens of the path, marked p:."""
    hosts = urls.select("host").distinct()
    names = hosts.select("host", F.posexplode(F.filter(F.split("host", "[^a-z]+"), lambda x: x != "")).alias("i", "name"))
    names = settle(names, "host-names")
    split = _spread_join(names, segment_names(names, words), "name")
    host_words = split.groupBy("host").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("i", "words"))), lambda x: x["words"])).alias("words"))
    joined = _salted(urls, "host").join(_copies(host_words), ["host", "__salt"], "left")
    in_path = F.filter(F.split(F.lower("path"), "[^a-z]+"), lambda x: x != "")
    tokens = F.concat(F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda x: F.concat(F.lit("h:"), x)), F.transform(in_path, lambda x: F.concat(F.lit("p:"), x)))
    return joined.select("url", tokens.alias("tokens"))


def token_weights(tokens: DataFrame, unwanted: Column) -> tuple[DataFrame, float]:
    """(rows (token, weight), prior): log odds of unwanted against wanted for each token, add-one smoothed, and of the classes."""
    labelled = tokens.select("tokens", unwanted.cast("int").alias("y"))
    counts = labelled.select("y", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    counts = settle(counts, "token-counts")
    size = counts.agg(F.sum("bad"), F.sum("good"), F.count(F.lit(1))).first()
    bad, good, kinds = size[0] or 0, size[1] or 0, size[2]
    classes = labelled.agg(F.sum("y"), F.count(F.lit(1))).first()
    n_bad, n = classes[0] or 0, classes[1]
    weight = F.log((F.col("bad") + 1) / (bad + kinds + 1)) - F.log((F.col("good") + 1) / (good + kinds + 1))
    return counts.select("token", weight.alias("weight")), math.log((n_bad + 1) / (n - n_bad + 1))


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", seeds: list[str] | None = None) -> DataFrame:
    """For every row of pages: id_col, host, path, rule, verdict, log_odds, words.

    verdict is that of the longest rule that fits, else naive Bayes's: block if
    the log odds of the url's tokens are above 0.  log_odds and words, the
    host's and path's tokens, are null for urls without a host.  Null urls have
    an empty host and path and, as no rule fits, are allowed.
    """
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    urls = rows.where(F.col("host") != "").select("url", "host", "path").distinct()
    words = settle(word_counts(pages, url_col, html_col), "unigrams")
    tokens = settle(url_tokens(urls, words), "url-tokens")
    marked = F.array(*[F.lit("h:" + w) for w in (SEED_WORDS if seeds is None else seeds)])
    weights, prior = token_weights(tokens, F.arrays_overlap("tokens", marked))
    each = _salted(tokens.select("url", F.explode("tokens").alias("token")).groupBy("url", "token").agg(F.count(F.lit(1)).alias("n")), "token")
    scored = each.join(_copies(weights), ["token", "__salt"]).groupBy("url").agg((F.sum(F.col("n") * F.col("weight")) + prior).alias("log_odds"))
    judged = tokens.join(scored, "url", "left").select("url", F.coalesce("log_odds", F.lit(prior)).alias("log_odds"), F.col("tokens").alias("words"))
    out = _spread_join(rows, judged, "url", "left")
    rule, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    learnt = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    return out.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, learnt).alias("verdict"), "log_odds", "words")
