"""Secret scans whose false positives a random forest removes, with DataFrame functions only.

Patterns find candidates: long runs of characters that keys are made of, such
runs joined by dots, and values of any length that are assigned to a secret's
name.  A forest judges each by its length and character make-up, its character
transitions under a model of the corpus's words, the share of it that the
corpus's dictionary covers, its path, and the words beside it.  The forest is
trained on labelled findings; where nobody has labelled any, `seed_labels`
labels the clear ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_names, settle

#: Bound of the labelled findings that the forest is trained on.
MAX_LABELLED = 20_000
#: A run of letters is in the dictionary if more texts than one have it as a word, and this many times as many as by chance.
ABOVE_CHANCE = 5.0

# What a candidate looks like, names that secrets are given, and words of paths that hold samples.
CANDIDATE = r"[A-Za-z0-9_+/\-]{16,}={0,2}"
SECRET_NAMES = r"(?i)(token|secret|password|passwd|pwd|credential|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer)"
#: Long tokens with dots; their parts are candidates too.
DOTTED = r"(?<![A-Za-z0-9_+/.\-])(?=[A-Za-z0-9_+/.\-]{16})[A-Za-z0-9_+/\-]++(?:\.[A-Za-z0-9_+/\-]++)+={0,2}"
_ASSIGN = SECRET_NAMES + r"""[A-Za-z0-9_\-]*+["'`]?[ \t]*(?:=>|:=|={1,3}|:)[ \t]*(?:(?:bearer|basic)[ \t]+)?"""
_CLOSING = r"[,;)\]}]*(?:\s|$)"
#: Values assigned to a name: quoted, or up to white space without what closes a list or statement.
NAMED = _ASSIGN + r"""(?:"[^"\r\n]+"|'[^'\r\n]+'|`[^`\r\n]+`|[^\s"'`]\S*?(?=""" + _CLOSING + "))"
SAMPLE_PATHS = r"(?i)(test|example|sample|mock|fixture|doc)"
KNOWN_FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,})$"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SYMBOLS = 28  # other, a-z, digit

#: What the forest sees: length, make-up, transitions, dictionary, path and neighbouring words.
FEATURES = ("length", "distinct_share", "case_switches", "symbol_share", "transition", "dictionary", "path_depth", "path_sample", "word_before", "word_after")
#: Characters before and after a candidate that are looked at.
_BEFORE, _AFTER = 60, 40
#: Pieces of a text, matches and what lies between them, that hold so many characters: no match is shorter than five.
_NEAR = 26


def _placed(pattern: str) -> Column:
    """Array of (secret, at, before, after): the matches of a pattern in column text, with their places from 1 and what stands beside them.

    The text is split once at the matches.  A place is the sum of the lengths
    before it: of whole blocks of pieces, and of the pieces of its own block, so
    that a text with very many matches takes little more than linear time.
    """
    quoted = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    block = 256
    # each step binds its arrays once, as the one element of an array
    pieces = f"""transform(array(struct(split(text, {quoted}, -1) AS gaps, regexp_extract_all(text, {quoted}, 0) AS matches)),
        s -> flatten(transform(s.gaps, (g, i) -> if(i < size(s.matches), array(g, s.matches[i]), array(g)))))"""
    sized = f"transform({pieces}, p -> struct(p AS p, transform(p, x -> length(x)) AS l, transform(p, x -> right(x, {_BEFORE})) AS ends, transform(p, x -> left(x, {_AFTER})) AS starts))"
    sums = f"transform(sequence(0, (size(s.l) - 1) div {block}), b -> aggregate(slice(s.l, {block} * b + 1, {block}), 0, (t, x) -> t + x))"
    before = "aggregate(s.sums, array(0), (a, x) -> array_append(a, element_at(a, -1) + x))"
    blocked = f"transform(transform({sized}, s -> struct(s.p, s.l, s.ends, s.starts, {sums} AS sums)), s -> struct(s.p, s.l, s.ends, s.starts, {before} AS sums))"
    piece = f"""transform(filter(sequence(0, size(s.p) - 1), k -> k % 2 = 1), k -> struct(s.p[k] AS secret,
        1 + s.sums[k div {block}] + aggregate(slice(s.l, {block} * (k div {block}) + 1, k % {block}), 0, (t, x) -> t + x) AS at,
        right(array_join(slice(s.ends, greatest(1, k - {_NEAR - 1}), least({_NEAR}, k)), ''), {_BEFORE}) AS before,
        left(array_join(slice(s.starts, k + 2, {_NEAR}), ''), {_AFTER}) AS after))"""
    return F.expr(f"transform({blocked}, s -> {piece})[0]")


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """Rows (id, text_hash, path, start, secret, before, after): every candidate of every whole text, start in characters from 0.

    A candidate inside another one is a row too; what two patterns find alike is
    one.  text_hash tells texts of one id apart.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    text = docs.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text_col).alias("text"))
    found = text.where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(NAMED) | F.col("text").rlike(DOTTED))
    found = found.select("id", F.xxhash64("text").alias("text_hash"), "path", _placed(CANDIDATE).alias("__runs"), _placed(DOTTED).alias("__dotted"), _placed(NAMED).alias("__named"))

    def value(m: Column) -> Column:
        """The value of an assignment without its quotes; what is left out before it moves its place."""
        raw = F.regexp_replace(m["secret"], "^" + _ASSIGN, "")
        bare = F.regexp_replace(raw, r"""^(["'`])(.*)\1$""", "$2")
        skipped = F.length(m["secret"]) - F.length(raw) + F.when(F.length(bare) < F.length(raw), 1).otherwise(0)
        before = F.right(F.concat(m["before"], F.left(m["secret"], skipped)), F.lit(_BEFORE))
        after = F.left(F.concat(F.substr(m["secret"], skipped + F.length(bare) + 1), m["after"]), F.lit(_AFTER))
        return F.struct(bare.alias("secret"), (m["at"] + skipped).alias("at"), before.alias("before"), after.alias("after"))

    # as texts, equal ones are found by their hashes: place, lengths, and the three strings
    packed = lambda m: F.concat(F.concat_ws(" ", m["at"].cast("string"), F.length(m["secret"]).cast("string"), F.length(m["before"]).cast("string")), F.lit(" "), m["secret"], m["before"], m["after"])
    every = F.array_distinct(F.concat(F.transform("__runs", packed), F.transform("__dotted", packed), F.transform(F.transform("__named", value), packed)))
    each = found.select("id", "text_hash", "path", F.explode(every).alias("x"))
    number = lambda i: F.split_part("x", F.lit(" "), F.lit(i)).cast("int")
    each = each.select("id", "text_hash", "path", number(1).alias("at"), number(2).alias("n"), number(3).alias("b"), F.substr("x", F.length(F.substring_index("x", " ", 3)) + 2).alias("x"))
    return each.select(
        "id", "text_hash", "path", (F.col("at") - 1).cast("long").alias("start"), F.left("x", F.col("n")).alias("secret"), F.substr("x", F.col("n") + 1, F.col("b")).alias("before"), F.substr("x", F.col("n") + F.col("b") + 1).alias("after")
    )


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows (word, n, known): the runs of three or more letters outside candidates, lower-case, with the number of distinct texts that have them.

    known says that a word is in the dictionary: were all words of its length
    random letters, far fewer texts would have it.
    """
    texts = docs.select(F.col(text_col).alias("text")).distinct()
    bare = F.col("text")
    for pattern in (NAMED, DOTTED, CANDIDATE):
        bare = F.regexp_replace(bare, pattern, " ")
    bare = F.lower(bare)
    runs = F.explode(F.array_distinct(F.split(bare, "[^a-z]+")))
    words = texts.select(runs.alias("word")).where(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n")).withColumn("size", F.length("word"))
    # longer runs of letters are candidates, so there are few lengths
    sizes = words.groupBy("size").agg((F.sum("n") / F.pow(F.lit(26.0), F.first("size"))).alias("chance"))
    return words.join(F.broadcast(sizes), "size").select("word", "n", ((F.col("n") > 1) & (F.col("n") > ABOVE_CHANCE * F.col("chance"))).alias("known"))


def transition_costs(words: DataFrame) -> list[float]:
    """Negative log2 probabilities of one character kind after another in words weighted by their counts; _SYMBOLS squared values."""
    pairs = words.select("n", F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("pair"))
    counts = {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()}  # at most 26 * 26 rows
    costs = []
    for a in range(_SYMBOLS):
        row = [float(counts.get(_LETTERS[a - 1] + _LETTERS[b - 1], 0)) if 1 <= a <= 26 and 1 <= b <= 26 else 0.0 for b in range(_SYMBOLS)]
        total = sum(row)
        costs += [-math.log2((x + 0.5) / (total + 0.5 * _SYMBOLS)) for x in row]
    return costs


def _codes(text: Column) -> Column:
    """0 for other characters, 1 to 26 for letters, 27 for digits, one for each character."""
    return F.transform(F.split(F.translate(F.lower(text), "0123456789", "0" * 10), ""), lambda c: F.when(c == "0", F.lit(27)).otherwise(F.instr(F.lit(_LETTERS), c)))


def describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of found with FEATURES."""
    secret, n = F.col("secret"), F.length("secret").cast("double")
    share = lambda pattern: F.regexp_count(secret, F.lit(pattern)) / n
    costs = F.lit(transition_costs(words))
    codes = _codes(secret)
    steps = F.zip_with(codes, F.slice(codes, F.lit(2), F.length("secret")), lambda a, b: F.get(costs, a * _SYMBOLS + b))
    last_word = F.regexp_extract("before", r"([A-Za-z_\-]+)\W*$", 1)
    rows = found.withColumns({
        "length": n,
        "digits_only": secret.rlike("^[0-9_/+-]+$").cast("double"),
        "letters_only": secret.rlike("^[A-Za-z_/+-]+$").cast("double"),
        "symbol_share": share("[^A-Za-z0-9]"),
        "distinct_share": F.size(F.array_distinct(F.split(secret, ""))) / n,
        "case_switches": share("[a-z](?=[A-Z])"),
        "transition": F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0))) / n,
        "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "path_sample": F.col("path").rlike(SAMPLE_PATHS).cast("double"),
        "named": last_word.rlike(SECRET_NAMES).cast("double"),
        "assigned": F.col("before").rlike(r"""[=:]>?\s*(?i:(?:bearer|basic)\s+)?["'`]?$""").cast("double"),
        "word_before": F.length(last_word).cast("double"),
        "word_after": F.length(F.regexp_extract("after", r"^\W*([A-Za-z]+)", 1)).cast("double"),
    })
    # the share of its characters that lie in words of the dictionary
    pieces = found.select("secret").distinct().select("secret", F.explode(F.split(F.lower("secret"), "[^a-z]+")).alias("word")).where(F.length("word") >= 3)
    covered = pieces.join(words.where("known"), "word").groupBy("secret").agg(F.sum(F.length("word")).alias("__covered"))
    return rows.join(covered, "secret", "left").withColumn("dictionary", F.coalesce(F.col("__covered") / F.col("length"), F.lit(0.0))).drop("__covered")


def seed_labels(described: DataFrame) -> Column:
    """1 for findings in a known format or assigned to a secret's name, 0 for words and plain numbers, null for the rest.

    A short number that is assigned is more often a count than a secret.  The
    names and signs that these labels go by, quotes, and shares and switches of
    digits, letters and cases to digits are not among FEATURES: the forest must tell
    secrets by length, make-up, transitions, dictionary and place.  What it can't be
    kept from is that transitions of a secret with digits cost more.
    """
    short_number = (F.col("length") < 16) & ~F.col("secret").rlike("[A-Za-z]")
    clear = F.col("secret").rlike(KNOWN_FORMATS) | ((F.col("named") == 1) & (F.col("assigned") == 1) & F.col("secret").rlike("[0-9]") & ~short_number)
    harmless = (F.col("letters_only") == 1) | (F.col("digits_only") == 1)
    return F.when(clear, 1.0).when(harmless, 0.0)


@dataclass
class SecretModel:
    """A trained forest, or the share of secrets among the labelled findings if these are all alike."""

    forest: RandomForestClassificationModel | None
    share: float

    def probability(self, described: DataFrame) -> DataFrame:
        """The rows of described with `probability`."""
        if self.forest is None:
            return described.withColumn("probability", F.lit(self.share))
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(described)
        judged = self.forest.transform(vectors)
        return judged.withColumn("probability", vector_to_array("__probability")[1]).drop("__features", "__raw", "__probability", "__prediction")


def fit_forest(described: DataFrame, label: Column, trees: int = 24, depth: int = 6) -> SecretModel:
    """Train on the described findings whose label is 0 or 1: at most MAX_LABELLED of each, those with the smallest hashes."""
    labelled = described.select(*FEATURES, label.alias("__label"), F.xxhash64("secret", "before", "after").alias("__order"), "start").where(F.col("__label").isNotNull())
    sample = None
    for value in (0.0, 1.0):
        part = labelled.where(F.col("__label") == value).orderBy("__order", "start").limit(MAX_LABELLED)
        sample = part if sample is None else sample.unionByName(part)
    sample = sample.coalesce(1).persist()
    counts = {r["__label"]: r["n"] for r in sample.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        sample.unpersist()
        return SecretModel(None, 1.0 if 1.0 in counts else 0.0)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(sample.sortWithinPartitions("__label", "__order", "start"))
    forest = RandomForestClassifier(labelCol="__label", featuresCol="__features", rawPredictionCol="__raw", probabilityCol="__probability", predictionCol="__prediction", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=7).fit(vectors)
    sample.unpersist()
    return SecretModel(forest, counts[1.0] / (counts[0.0] + counts[1.0]))


def scan_secrets(docs: DataFrame, model: SecretModel | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """Rows (id_col, start, secret, path, probability, is_secret, text_hash): every candidate of docs, judged.

    start counts characters from 0.  Without a model one is trained on the seed
    labels of these findings.  Null and empty texts have no findings; repeated
    rows give theirs each, rows without an id too; the same string is judged at
    each of its places.  Very long texts are searched whole; extra columns are
    not read.
    """
    found = settle(find_candidates(docs, id_col, text_col, path_col), "candidates")
    words = settle(dictionary(docs, text_col), "dictionary")
    described = describe(found, words)
    if model is None:
        described = settle(described, "findings")
        model = fit_forest(described, seed_labels(described))
    judged = model.probability(described)
    return judged.select(F.col("id").alias(id_col), "start", "secret", "path", "probability", (F.col("probability") >= threshold).alias("is_secret"), "text_hash")


def redact(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars", mark: str = "[secret]") -> DataFrame:
    """The rows of docs, all of them, with each secret of their findings replaced in the text by mark.

    A row's findings are those of its id and, where findings have text_hash, its
    text: rows that share an id, or have none, keep apart, and repeated rows are
    changed alike.  Null and empty texts stay as they are; of secrets that overlap
    the longer goes first.  Secrets of 16 characters and more go wherever they stand, shorter ones where
    they are assigned to a secret's name, since they may be words elsewhere.
    count_col, if docs has it, is set to the new length of changed texts.
    """
    by_text = "text_hash" in findings.columns
    of_id, of_text, secrets = free_names(docs, "__id", "__of", "__secrets")
    keys = [F.col(id_col).alias(of_id), *([F.col("text_hash").alias(of_text)] if by_text else [])]
    per_doc = findings.where("is_secret").groupBy(*keys).agg(F.collect_set("secret").alias(secrets))
    same = F.col(id_col).eqNullSafe(F.col(of_id))
    joined = docs.join(per_doc.hint("shuffle_hash"), same & (F.xxhash64(F.col(text_col)) == F.col(of_text)) if by_text else same, "left")
    longest_first = F.sort_array(F.transform(secrets, lambda s: F.struct((-F.length(s)).alias("k"), s.alias("s"))))
    literal = lambda s: F.concat(F.lit(r"\Q"), F.replace(s, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    assigned = lambda s: F.concat(F.lit("(" + _ASSIGN + """["'`]?)"""), literal(s), F.lit("""(?=["'`]|""" + _CLOSING + ")"))
    in_place = "$1" + mark.replace("\\", "\\\\").replace("$", "\\$")
    without = lambda t, s: F.when(F.length(s["s"]) >= 16, F.replace(t, s["s"], F.lit(mark))).otherwise(F.regexp_replace(t, assigned(s["s"]), F.lit(in_place)))
    text = F.when(F.col(secrets).isNull(), F.col(text_col)).otherwise(F.aggregate(longest_first, F.col(text_col), without))
    columns = {text_col: text}
    out = joined.withColumns(columns)
    if count_col and count_col in docs.columns:
        out = out.withColumn(count_col, F.when(F.col(secrets).isNull(), F.col(count_col)).otherwise(F.length(text_col)).cast(docs.schema[count_col].dataType))
    return out.select(*docs.columns)
