"""A quality classifier from positive and unlabelled texts.

The learner sees trusted positives and unlabelled web text, and estimates the
class prior from these two; labelled negatives are not used.  It minimises the non-negative unbiased
risk of a logistic model over binned text statistics (Kiryo et al., 2017).
Positives are a bounded sample of the labelled rows; of the unlabelled texts all
are read, by steps whose sums Spark takes over a table of their features.
The model is some hundred weights, and scoring is one Spark expression over
statistics of each whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .statistics import shares, text_statistics
from .tables import forget, settle

#: Passes over the unlabelled texts in which the regression behind the class prior settles.
PASSES = 20
#: Thresholds that are tried for the class prior.
THRESHOLDS = 256
#: Bound of the sample of trusted positives that the classifier is fitted on.
MAX_POSITIVES = 20_000
#: And of the labelled rows whose share of positives stands in where nothing can be fitted.
MAX_AUDITED = 100_000


@dataclass
class QualityModel:
    """score = sigmoid(bias + for each feature the weight of the bin it falls in)."""

    prior: float
    bias: float
    edges: dict[str, list[float]] = field(default_factory=dict)
    weights: dict[str, list[float]] = field(default_factory=dict)

    def score(self, features: dict[str, Column]) -> Column:
        total = F.lit(self.bias)
        for name, edges in self.edges.items():
            weights = self.weights[name]
            part = F.lit(weights[-1])
            for edge, weight in zip(reversed(edges), reversed(weights[:-1])):
                part = F.when(features[name] < F.lit(edge), F.lit(weight)).otherwise(part)
            total = total + part
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _one_hot(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """A row of 0 and 1 for each row of x: the bin of each feature, and a last column of ones."""
    parts = []
    for j, e in enumerate(edges):
        at = np.searchsorted(np.array(e), x[:, j], "right")
        part = np.zeros((len(x), len(e) + 1))
        part[np.arange(len(x)), at] = 1
        parts.append(part)
    return np.concatenate([*parts, np.ones((len(x), 1))], 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _slope(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of rows, their loss as negatives and its gradient, summed."""
    z = x @ w
    return np.concatenate([[len(x), np.logaddexp(0, z).sum()], x.T @ _sigmoid(z)])


def _sums(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """_slope and the upper half of the loss's curvature, summed."""
    s = _sigmoid(x @ w)
    curve = x.T @ (x * (s * (1 - s))[:, None])
    return np.concatenate([_slope(x, w), curve[np.triu_indices(len(w))]])


class Rows:
    """Texts in memory, one row of bins each."""

    def __init__(self, x: np.ndarray):
        self.x = x

    def slope(self, w: np.ndarray) -> np.ndarray:
        return _slope(self.x, w)

    def sums(self, w: np.ndarray) -> np.ndarray:
        return _sums(self.x, w)

    def reach(self, w: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
        """How many rows score each of the ascending thresholds or more."""
        return np.array([(self.x @ w >= t).sum() for t in thresholds], float)

    def halves(self) -> tuple[Rows, Rows]:
        return Rows(self.x[::2]), Rows(self.x[1::2])


class TableRows:
    """Texts in a Spark table of their features; each call is one job, which returns sums of a fixed size from each task."""

    def __init__(self, table: DataFrame, edges: list[list[float]]):
        self.table, self.edges = table, edges

    def _total(self, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        edges = self.edges

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                x = np.column_stack([batch.column(j).to_numpy() for j in range(len(edges))])
                total += of(_one_hot(x, edges))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "value"])

        rows = self.table.select(*shares()).mapInArrow(add, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(size)
        for r in rows:
            out[r["at"]] = r["value"]
        return out

    def slope(self, w: np.ndarray) -> np.ndarray:
        return self._total(2 + len(w), lambda x: _slope(x, w))

    def sums(self, w: np.ndarray) -> np.ndarray:
        return self._total(2 + len(w) + len(w) * (len(w) + 1) // 2, lambda x: _sums(x, w))

    def reach(self, w: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
        places = self._total(len(thresholds) + 1, lambda x: np.bincount(np.searchsorted(thresholds, x @ w, "right"), minlength=len(thresholds) + 1).astype(float))
        return places[::-1].cumsum()[::-1][1:]

    def halves(self) -> tuple[TableRows, TableRows]:
        return tuple(TableRows(self.table.where(F.col("half") == h), self.edges) for h in (0, 1))


def _parts(sums: np.ndarray, d: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Means of loss, gradient and curvature."""
    mean = sums / max(sums[0], 1)
    curve = np.zeros((d, d))
    curve[np.triu_indices(d)] = mean[2 + d :]
    return mean[1], mean[2 : 2 + d], curve + np.triu(curve, 1).T


def _newton(start: np.ndarray, measure: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], passes: int = PASSES) -> np.ndarray:
    """Weights of least value: Newton steps, halved where the value doesn't fall, until it falls by less than 1e-6."""
    at, share = start, 1.0
    value, grad, curve = measure(at)
    for _ in range(passes):
        trial = at - share * np.linalg.solve(curve, grad)
        found = measure(trial)
        if found[0] > value:
            share /= 2
            continue
        settled = value - found[0] < 1e-6
        at, (value, grad, curve), share = trial, found, min(1.0, 2 * share)
        if settled:
            break
    return at


def _with_decay(value: float, grad: np.ndarray, curve: np.ndarray, w: np.ndarray, decay: float) -> tuple[float, np.ndarray, np.ndarray]:
    return value + decay / 2 * (w @ w), grad + decay * w, curve + decay * np.eye(len(w))


def fit_nnpu(positive: np.ndarray, unlabelled: Rows | TableRows | np.ndarray, prior: float, steps: int = 60, rate: float = 0.2, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss.

    Risk = prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)]).
    While the second part is below zero, a step raises it instead.  Every step
    reads all unlabelled texts.  Arrays have no column of ones.
    """
    if isinstance(unlabelled, np.ndarray):
        unlabelled = Rows(np.column_stack([unlabelled, np.ones(len(unlabelled))]))
    positive = np.column_stack([positive, np.ones(len(positive))])
    w = np.append(np.zeros(positive.shape[1] - 1), np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w)), np.zeros(len(w))
    for t in range(1, steps + 1):
        z, of_unlabelled = positive @ w, unlabelled.slope(w)
        _, loss, *grad_unlabelled = of_unlabelled / of_unlabelled[0]
        grad_negative = np.array(grad_unlabelled) - prior * (positive.T @ _sigmoid(z)) / len(z)
        if loss < prior * np.logaddexp(0, z).mean():
            grad = -grad_negative
        else:
            grad = grad_negative - prior * (positive.T @ _sigmoid(-z)) / len(z)
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def estimate_prior(positive: np.ndarray, unlabelled: Rows | TableRows | np.ndarray) -> float:
    """The share of positives among the unlabelled, from both alone, by the best bin of a classifier's scores (Garg et al., 2021).

    A classifier of positives against unlabelled is fitted on half of each.  On
    the other half, positives among the unlabelled that score above a threshold
    are at most all of them there, and as many as their share of all positives;
    the ratio of both shares, with what chance may add, is smallest where hardly
    a negative is left.  Thresholds are THRESHOLDS quantiles of the positives.
    """
    if isinstance(unlabelled, np.ndarray):
        unlabelled = Rows(np.column_stack([unlabelled, np.ones(len(unlabelled))]))
    positive = np.column_stack([positive, np.ones(len(positive))])
    (fitted, other), p = unlabelled.halves(), positive[::2]
    w = fit_logistic(p, fitted)
    p = np.sort(positive[1::2] @ w)
    if not len(p):
        return 0.5
    thresholds = np.unique(np.quantile(p, np.linspace(0, 1, THRESHOLDS), method="lower"))
    n = other.slope(w)[0]
    if not n:
        return 0.5
    chance = np.sqrt(np.log(40) / 2 / n) + np.sqrt(np.log(40) / 2 / len(p))
    in_p, in_u = 1 - np.searchsorted(p, thresholds, "left") / len(p), other.reach(w, thresholds) / n
    best = int(np.argmin((in_u + chance) / in_p))
    return float(in_u[best] / in_p[best])


def fit_logistic(positive: np.ndarray, other: Rows | TableRows, decay: float = 1e-4) -> np.ndarray:
    """Weights, the bias last, of a logistic regression in which both sides weigh the same."""
    d = positive.shape[1]

    def loss(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        of_other, of_positive = _parts(other.sums(w), d), _parts(_sums(positive, w), d)
        value = of_other[0] + np.logaddexp(0, -(positive @ w)).mean()
        grad = of_other[1] + of_positive[1] - positive.mean(0)
        return _with_decay(value / 2, grad / 2, (of_other[2] + of_positive[2]) / 2, w, decay)

    return _newton(np.zeros(d), loss)


def _with_marks(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Features of every text, with `positive`: true or false for labelled texts, null for unlabelled ones; `order` and `half` are made of hashes."""
    features = [c.cast("double").alias(k) for k, c in shares().items()]
    key = F.col(id_col)
    texts = docs.select(id_col, text_col)
    counted = lambda rows: text_statistics(rows, id_col, text_col).select(key.cast("string").alias("__id"), *features)
    marks = known.groupBy(key.cast("string").alias("__id")).agg(F.max("positive").alias("positive"))
    # no label names a null id; left out of the join, such rows don't meet in one task
    named = counted(texts.where(key.isNotNull())).join(marks, "__id", "left")
    rows = named.unionByName(counted(texts.where(key.isNull())).withColumn("positive", F.lit(None).cast("boolean")))
    order = F.xxhash64("__id", *shares())
    return rows.select(*shares(), "positive", order.alias("order"), F.pmod(order, F.lit(2)).alias("half"))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bins: int = 8) -> QualityModel:
    """Fit on labels with label_col = 1 as trusted positives and on all texts of docs that labels doesn't name.

    Positives are the MAX_POSITIVES rows with the smallest hashes; unlabelled
    texts, null ids' too, are all read: for the bins' edges (quantiles of all
    texts, found to 1/10,000), the class prior and the risk, in some
    eighty passes over a table of their features, a row of numbers each.  Without positives or unlabelled
    texts every score is the share of positives among at most MAX_AUDITED
    labelled rows, 0.5 without any.  Labels that are null count as absent; an id
    that has been labelled twice is a positive if one of its labels says so.
    Rows that share an id are texts of their own with one label.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, (F.col(label_col) == 1).alias("positive"))
    audited = known.orderBy(F.xxhash64(F.col(id_col).cast("string")), "positive").limit(MAX_AUDITED).agg(F.avg(F.col("positive").cast("double")).alias("p")).first()["p"]
    prior = 0.5 if audited is None else min(max(audited, 0.05), 0.95)
    plain = QualityModel(prior, float(np.log(prior / (1 - prior))))
    if audited is None:
        return plain
    rows = settle(_with_marks(docs, known, id_col, text_col), "quality-features")
    names = list(shares())
    p = rows.where("positive").orderBy("order").limit(MAX_POSITIVES).select(*names).toPandas().to_numpy(float)
    unlabelled = rows.where(F.col("positive").isNull())
    if not len(p) or unlabelled.isEmpty():
        forget(rows)
        return plain
    cuts = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.struct(F.min(c), F.percentile_approx(c, cuts, 10_000)).alias(c) for c in names]).first()
    edges = [sorted(set(found[c][1]) - {found[c][0]}) for c in names]
    p, u = _one_hot(p, edges)[:, :-1], TableRows(unlabelled, edges)
    prior = min(max(estimate_prior(p, u), 0.05), 0.95)
    w, b = fit_nnpu(p, u, prior)
    forget(rows)
    model, at = QualityModel(prior, round(b, 9)), 0
    for name, e in zip(names, edges):
        # sums over tasks come in any order: rounded, their last digits don't show
        model.edges[name], model.weights[name] = e, [round(float(x), 9) for x in w[at : at + len(e) + 1]]
        at += len(e) + 1
    return model


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, score): for every row of docs, null and empty texts too, a score from 0 to 1."""
    return text_statistics(docs, id_col, text_col).select(id_col, model.score(shares()).alias("score"))


def keep_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose score is at least threshold, with all their columns."""
    counted = text_statistics(docs, None, text_col)
    return counted.where(model.score(shares("__counts.")) >= threshold).drop("__counts")
