"""License scans by diagonal voting, with DataFrame functions only.

All rolling word k-grams of a text are joined to the places of the same k-grams
in license texts.  A hit votes for its diagonal, the place in the text less the
place in the template: an untouched copy puts all its votes on one diagonal,
an inserted or missing word moves the rest to a neighbouring one.  Diagonals
close to each other are merged to spans, and a span is verified by alignment:
of its runs of votes, those that stand in the same order in text and template
must have enough of the template's k-grams.  Votes are kept in chunks of 63 places of the template,
so a template may be a whole license.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII characters that separate words once A-Z are lower-case.
GAP = "".join(chr(c) for c in [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
GAP_PATTERN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Places of a template whose votes are bits of one number.
CHUNK = 63
#: Whole licenses, in files named by label and license.
LICENSE_TEXTS = Path(__file__).with_name("licenses")
#: Paragraphs of a license are templates of their own from this many words on, unless this share of their triples stands in another label's license or in a notice.
PARAGRAPH_WORDS, SHARED = 12, 0.4

# Phrases, their labels, the opening or notice texts of common licenses, and their short forms.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software": "mit",
    "licensed under the apache license version 2 0": "apache",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "this work is licensed under a creative commons attribution": "cc",
    "licensed under the creative commons attribution sharealike": "cc",
}
#: Creative Commons licenses and their versions.
CC_FORMS, CC_VERSIONS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"), ("1 0", "2 0", "2 5", "3 0", "4 0")
#: Names on SPDX lines, as words.
SPDX = {
    "mit": "mit", "apache 1 1": "apache", "apache 2 0": "apache", "gpl 1 0": "gpl", "gpl 2 0": "gpl", "gpl 3 0": "gpl", "lgpl 2 0": "lgpl", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl",
    "agpl 3 0": "agpl", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "isc": "isc", "mpl 1 1": "mpl", "mpl 2 0": "mpl", "cc0 1 0": "cc",
} | {f"cc {form} {version}": "cc" for form in CC_FORMS for version in CC_VERSIONS}


@dataclass(frozen=True)
class Template:
    words: tuple[str, ...]
    label: str
    base: bool

    @property
    def k(self) -> int:
        """A phrase is found by its pairs of words, longer texts by triples, which stop words alone seldom make."""
        return 2 if self.base else 3

    @property
    def grams(self) -> int:
        return len(self.words) - self.k + 1


def _short_forms() -> dict[str, str]:
    """Creative Commons by abbreviation, with its version or after "licensed under", and SPDX lines, with a second license too."""
    forms = {t: "cc" for form in CC_FORMS for t in (*(f"cc {form} {v}" for v in CC_VERSIONS), f"licensed under cc {form}", f"licensed under a cc {form}", f"licensed under the cc {form}")}
    for name, label in SPDX.items():
        forms[f"spdx license identifier {name}"] = label
        for word in ("or", "and"):
            seconds = [f"{word} {name}"] if " " in name else [f"{last} {word} {name}" for last in ("0", "1", "clause", "only", "later")]
            forms |= dict.fromkeys(seconds, label)
    return forms


def _plain_words(text: str) -> tuple[str, ...]:
    """The words of a license file, as word_array has them."""
    bare = text.translate(str.maketrans(UPPER, UPPER.lower())).strip(GAP)
    return tuple(re.split(GAP_PATTERN, bare)) if bare else ()


def _triples(words: tuple[str, ...]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:], words[2:]))


@cache
def _license_bodies() -> dict[tuple[str, ...], str]:
    """Whole licenses, and those of their paragraphs that tell them from other labels' licenses and are no notices."""
    texts = [(f.name.split(".")[0], f.read_text()) for f in sorted(LICENSE_TEXTS.glob("*.txt"))]
    known = [(None, _triples(tuple(t.split()))) for t in NOTICES] + [(label, _triples(_plain_words(t))) for label, t in texts]
    bodies = {_plain_words(t): label for label, t in texts}
    for label, text in texts:
        for words in map(_plain_words, re.split(r"\n\s*\n", text)):
            grams = _triples(words)
            if len(words) >= PARAGRAPH_WORDS and all(label == other or len(grams & theirs) < SHARED * len(grams) for other, theirs in known):
                bodies.setdefault(words, label)
    return bodies


def default_templates() -> list[Template]:
    short = [Template(tuple(t.split()), label, base) for table, base in ((PHRASES, True), (NOTICES, False), (_short_forms(), False)) for t, label in table.items()]
    return short + [Template(words, label, False) for words, label in _license_bodies().items()]


def word_array(text: Column) -> Column:
    """The words of a text, with A-Z lower-cased; no words for null."""
    bare = F.btrim(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), F.lit(GAP))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP_PATTERN))


def _gram_table(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """One row per template and place: bounded by the templates given, so it may be broadcast."""
    rows = [(n, i, t.k, t.words[i], t.words[i + 1], t.words[i + 2] if t.k == 3 else None) for n, t in enumerate(templates) for i in range(t.grams)]
    made = spark.createDataFrame(rows, "template int, t_place int, k int, a string, b string, c string")
    return made.withColumn("t_gram", F.when(F.col("k") == 2, F.xxhash64("a", "b")).otherwise(F.xxhash64("a", "b", "c")))


def diagonals(docs: DataFrame, templates: list[Template], id_col: str, text_col: str) -> DataFrame:
    """Rows (id, key, template, diagonal, chunk, voted, first, last, n_words, copies): the votes on each diagonal for each chunk of the template.

    key is the text's 128-bit hash, so that different texts of one id stay
    apart.  voted has a bit for each place of the chunk, so that repeated rows
    vote once.  The row of a document's first word carries n_words and counts
    how many rows repeat id and text.
    """
    if any(t.grams < 1 for t in templates):
        raise ValueError("a phrase has at least two words, another template three")
    grams = _gram_table(docs.sparkSession, templates)
    words = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text_col))).alias("key"), word_array(F.col(text_col)).alias("words"))
    placed = words.select("id", "key", "words", F.posexplode_outer("words").alias("place", "w1"))
    w2, w3 = F.get("words", F.col("place") + 1), F.get("words", F.col("place") + 2)
    rolled = placed.select("id", "key", F.coalesce("place", F.lit(0)).alias("place"), F.when(F.coalesce("place", F.lit(0)) == 0, F.size("words")).alias("size"), "w1", w2.alias("w2"), w3.alias("w3"))
    # pairs are looked up only where a phrase begins, so that other words take one look
    begins = sorted({w for t in templates if t.base for w in t.words[:-1]})
    pair, triple = F.xxhash64("w1", "w2"), F.when(F.col("w3").isNotNull(), F.xxhash64("w1", "w2", "w3"))
    head = F.array(F.struct(F.lit(None).cast("long").alias("gram"), F.col("size").alias("n_words"), F.lit(1).alias("copies")))
    look = lambda gram: F.struct(gram.alias("gram"), F.lit(None).cast("int").alias("n_words"), F.lit(None).cast("int").alias("copies"))
    looks = F.when(F.col("w2").isNotNull() & F.col("w1").isin(begins), F.array(look(triple), look(pair))).otherwise(F.array(look(triple)))
    rolled = rolled.select("*", F.inline(F.when(F.col("size").isNotNull(), F.concat(head, looks)).otherwise(looks)))
    same = (F.col("w1") == F.col("a")) & (F.col("w2") == F.col("b")) & ((F.col("k") == 2) | (F.col("w3") == F.col("c")))
    hits = rolled.join(F.broadcast(grams), (F.col("gram") == F.col("t_gram")) & same, "left")
    hits = hits.where(F.col("template").isNotNull() | F.col("n_words").isNotNull())
    return hits.groupBy("id", "key", "template", (F.col("place") - F.col("t_place")).alias("diagonal"), F.expr(f"t_place div {CHUNK}").alias("chunk")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, t_place % {CHUNK})")).alias("voted"), F.min("place").alias("first"), F.max("place").alias("last"), F.max("n_words").alias("n_words"), F.sum("copies").alias("copies")
    )


def _spans(found: DataFrame, templates: list[Template], max_shift: int, max_gap: int, cover: float) -> DataFrame:
    """Rows (id, key, n_words, copies, template, label, base, start, end, coverage, verified); end is the place after the last word.

    Diagonals within max_shift of the next are one group, which is cut where
    more than max_gap words have no votes; both are for each chunk of a template.
    """
    sizes = found.sparkSession.createDataFrame([(n, t.label, t.base, t.k, t.grams, -(-t.grams // CHUNK)) for n, t in enumerate(templates)], "t int, label string, base boolean, t_k int, grams int, chunks int")
    known = found.join(F.broadcast(sizes), F.col("template") == F.col("t"), "left")
    by_diagonal = Window.partitionBy("id", "key", "template").orderBy("diagonal", "chunk")
    step = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    # phrases stand as they are: each of their diagonals is a place of its own
    part = known.withColumn("__apart", F.when((F.col("base") & (step != 0)) | (step > max_shift * F.col("chunks")), 1).otherwise(0))
    part = part.withColumn("__group", F.sum("__apart").over(by_diagonal))
    by_place = Window.partitionBy("id", "key", "template", "__group").orderBy("first", "diagonal", "chunk")
    gap = F.col("first") - F.max("last").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    part = part.withColumn("__cut", F.when(~F.col("base") & (gap > max_gap * F.col("chunks")), 1).otherwise(0))
    part = part.withColumn("__span", F.sum("__cut").over(by_place))
    # the aligned votes of a span: the chain of runs, forwards in the text and in the template, with most of them.
    # A chain that another one equals, ending no later in either, leads nowhere further and is let go, so that a notice
    # which stands in a row a thousand times keeps as few chains as one
    run = F.struct("first", "last", (F.col("first") - F.col("diagonal")).alias("t_first"), (F.col("last") - F.col("diagonal")).alias("t_last"), F.bit_count("voted").cast("long").alias("votes"))
    best = "r.votes + coalesce(array_max(transform(filter(a, x -> x.last < r.first AND x.t_last < r.t_first), x -> x.best)), 0L)"
    kept = "if(exists(a, x -> x.last <= r.last AND x.t_last <= r.t_last AND x.best >= b), a, array_append(a, named_struct('last', r.last, 't_last', r.t_last, 'best', b)))"
    chain = f"array_max(transform(aggregate(sort_array(runs), cast(array() as array<struct<last:int,t_last:int,best:bigint>>), (a, r) -> transform(array({best}), b -> {kept})[0]), x -> x.best))"
    spans = part.groupBy("id", "key", "template", "__group", "__span").agg(
        F.first("label").alias("label"), F.first("base").alias("base"), F.min("first").alias("start"), (F.max("last") + F.first("t_k")).alias("end"),
        F.collect_list(run).alias("runs"), F.first("grams").alias("grams"), F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"),
    )
    spans = spans.withColumn("coverage", F.expr(chain) / F.col("grams")).drop("runs", "grams")
    return spans.withColumn("verified", F.when(F.col("base"), F.col("coverage") == 1.0).otherwise(F.col("coverage") >= cover))


def _repeated(rows: DataFrame) -> DataFrame:
    """Each row as often as documents repeat its id and text."""
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("__copy")


def license_spans(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text", max_shift: int = 8, max_gap: int = 12, cover: float = 0.6) -> DataFrame:
    """Rows (id_col, label, base, start, end, coverage): the spans of words that hold a license text or phrase, of every document."""
    templates = templates or default_templates()
    spans = _spans(diagonals(docs, templates, id_col, text_col), templates, max_shift, max_gap, cover)
    spans = spans.withColumn("copies", F.sum("copies").over(Window.partitionBy("id", "key")))
    return _repeated(spans.where("verified")).select(F.col("id").alias(id_col), "label", "base", "start", "end", "coverage")


def license_report(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text", max_shift: int = 8, max_gap: int = 12, cover: float = 0.6) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of base phrases; first_word and last_word are the
    smallest and largest of these places, null without any.  score is the
    largest coverage of a template, 0 without hits.  Null and empty texts have
    no words.  Rows that share an id, the null id too, are documents of their own.
    """
    templates = templates or default_templates()
    spans = _spans(diagonals(docs, templates, id_col, text_col), templates, max_shift, max_gap, cover)
    base = F.col("verified") & F.col("base")
    labels = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    per_place = F.when(base, F.col("coverage"))
    per_text = spans.groupBy("id", "key").agg(
        F.sum("copies").alias("copies"),
        F.max("n_words").cast("long").alias("n_words"),
        F.count(per_place).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("verified")).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
    )
    return _repeated(per_text).select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

