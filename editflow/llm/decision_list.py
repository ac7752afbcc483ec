"""Quality rules as a decision list learnt by sequential covering.

Each rule is a conjunction of thresholds on text statistics.  It is grown on
one part of the labelled rows by information gain until it covers no good text,
pruned on the other part, and kept while it is precise there; the rows it
covers are then set aside and the next rule is grown.  The list becomes one
ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .statistics import shares, text_statistics

#: Bound of the labelled rows that rules are learnt from.
MAX_LABELLED = 40_000


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, features: dict[str, Column]) -> Column:
        x = features[self.feature]
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for c in rule:
        hit &= (x[c.feature] > c.threshold) if c.above else (x[c.feature] <= c.threshold)
    return hit


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, thresholds: dict[str, np.ndarray], most: int) -> Rule:
    """Add the condition with the highest information gain until only bad rows are covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < most and (bad & inside).any() and (~bad & inside).any():
        p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
        best_gain, best = 1e-9, None
        for name, cuts in thresholds.items():
            values = x[name][inside]
            at = np.searchsorted(cuts, values, "left")  # value <= cuts[i] exactly if i >= at
            p = np.cumsum(np.bincount(at[bad[inside]], minlength=len(cuts) + 1))[:-1]
            n = np.cumsum(np.bincount(at[~bad[inside]], minlength=len(cuts) + 1))[:-1]
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                gain = pp * (np.log2((pp + 1e-12) / (pp + nn + 1e-12)) - np.log2(p0 / (p0 + n0)))
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best_gain:
                    best_gain, best = float(gain[k]), Condition(name, above, float(cuts[k]))
        if best is None:
            break
        rule = (*rule, best)
        inside &= _covers((best,), x, len(bad))
    return rule


def learn_decision_list(x: dict[str, np.ndarray], bad: np.ndarray, order: np.ndarray, max_rules: int = 12, max_conditions: int = 4, precision: float = 0.97, cuts: int = 64) -> list[Rule]:
    """Rules that mark bad rows, in the order they were found.

    ``order`` is a hash of each row, whose remainder by 3 deals it to growing
    (0, 1) or pruning (2).  A rule is kept if, on the pruning rows it is the
    first to cover, at least ``precision`` of them (with one good row added)
    are bad; so no rule comes from a handful of rows.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    prune_part = order % 3 == 2
    thresholds = {k: np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1), method="lower")) for k, v in x.items()} if len(bad) else {}
    while len(rules) < max_rules:
        g, q = left & ~prune_part, left & prune_part
        if not (bad & g).any():
            break
        rule = _grow({k: v[g] for k, v in x.items()}, bad[g], thresholds, max_conditions)
        if not rule:
            break
        xq, bq = {k: v[q] for k, v in x.items()}, bad[q]

        def worth(r: Rule) -> float:
            hit = _covers(r, xq, len(bq))
            p, n = int((hit & bq).sum()), int((hit & ~bq).sum())
            return (p - n) / (p + n) if p + n else -1.0

        rule = max((rule[:i] for i in range(len(rule), 0, -1)), key=worth)
        hit = _covers(rule, xq, len(bq))
        if (hit & bq).sum() < precision * (hit.sum() + 1):
            break
        rules.append(rule)
        left &= ~_covers(rule, x, len(bad))
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> list[Rule]:
    """Learn from at most MAX_LABELLED labelled rows, those with the smallest hashes of their ids.

    A label of 0 is bad, any other is good; null labels and ids are passed
    over.  Without labelled rows the list is empty and keeps every text.
    """
    order = F.xxhash64(F.col(id_col).cast("string"))
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label")).orderBy(F.xxhash64(F.col("__id").cast("string"))).limit(MAX_LABELLED)
    labelled = docs.select(id_col, text_col).join(F.broadcast(chosen), F.col(id_col) == F.col("__id"))
    counted = text_statistics(labelled, None, text_col)
    features = shares("__counts.")
    rows = counted.select(*(c.cast("double").alias(k) for k, c in features.items()), F.col("__label").cast("double").alias("__label"), order.alias("__order")).toPandas()
    return learn_decision_list({k: rows[k].to_numpy() for k in features}, rows["__label"].to_numpy() == 0, rows["__order"].to_numpy(np.int64).view(np.uint64) >> np.uint64(1), **options)


def first_rule(rules: list[Rule], features: dict[str, Column]) -> Column:
    """The number, from 1, of the first rule that covers a row; null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        condition = rule[0].column(features)
        for c in rule[1:]:
            condition = condition & c.column(features)
        out = F.when(condition, F.lit(i)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """Rows (id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule).

    Null and empty texts have no words and fail the base rule.
    """
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    counted = text_statistics(docs, id_col, text_col).withColumn("rule", first_rule(rules, shares()))
    return counted.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("rule").isNull()).alias("kept"), "rule")
