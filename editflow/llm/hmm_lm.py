"""A hidden Markov language model: Baum-Welch counts from all partitions, exact likelihoods by the scaled forward recursion.

Every token is a word or the end of a text.  In state s the model draws

    P(w | s) = P_base(w) * ratio[class(w), s].

Each of the most frequent words of the corpus is a class of its own, and all
rarer words are one; VOCABULARY bounds the frequent ones and so the table of
ratios, while the counts behind P_base cover every word of the corpus.
Probabilities sum to one in every state.  A word that training never saw has
ratio 1.

Counts of neighbouring tokens over all training texts start the states, the most
frequent words by themselves and all others as one; then each pass of Baum-Welch
reads all training texts whole and sums expected counts across partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import settle
from .text import BLOCK_BYTES, LOWER, Block, blocks, span_hashes, word_spans

_U = np.uint64
#: Words that are classes of their own, the most frequent ones.
VOCABULARY = 1 << 17
#: The hash of the end token.
END_HASH = _U(0x5851F42D4C957F2D)
#: Words that the pairs which start the states tell apart; all others are one.
PAIRED = (1 << 10) - 1
#: Tokens of a piece of the recursions over texts of more than WHOLE tokens.
SEGMENT, WHOLE = 64, 512
#: Bytes of text whose words are looked up together.
CHUNK_BYTES = 16 << 20
_CLASSES_A_ROW = 1 << 10


@dataclass
class Model:
    start: np.ndarray  # probability of each state at a text's first token
    move: np.ndarray  # from state to state
    ratio: np.ndarray  # by class and state

    @property
    def states(self) -> int:
        return len(self.start)


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens of a block's rows, number of tokens of each row): words, then one end."""
    data = LOWER[block.data]
    starts, ends, first = word_spans(data, block.rows)
    words = span_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return np.insert(words, first[1:], END_HASH), np.diff(first) + 1


def classes_of(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The place of each word among the sorted frequent ones; len(frequent) for all others."""
    at = np.minimum(np.searchsorted(frequent, hashes), max(len(frequent) - 1, 0))
    return np.where(frequent[at] == hashes, at, len(frequent)) if len(frequent) else np.zeros(len(hashes), np.int64)


def _segments(counts: np.ndarray, size: int, whole: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first token, length) of the segments that rows of counts tokens are cut into; rows of up to ``whole`` tokens stay one."""
    sizes = np.where(counts <= whole, np.maximum(counts, 1), size)
    n = -(-counts // sizes)
    row = np.repeat(np.arange(len(counts)), n)
    at = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * sizes[row]
    return row, np.repeat(np.cumsum(counts) - counts, n) + at, np.minimum(sizes[row], counts[row] - at)


def _transfers(model: Model, ratios, first: np.ndarray, length: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(matrices, log10 of their scales): how each segment takes the state before it to the state at its end.

    ratios gives those of the tokens at some places.  A text's first segment
    takes no move before its first token.
    """
    k = model.states
    order = np.argsort(-length, kind="stable")
    f, size, head = first[order], length[order], opens[order]
    m = np.tile(np.eye(k), (len(order), 1, 1))
    logs = np.zeros(len(order))
    steps = int(size[0]) if len(size) else 0
    for t in range(steps):
        n = int(np.searchsorted(-size, -t, "left"))
        if t == 0:
            m[:n] = np.where(head[:n, None, None], np.eye(k), model.move)
        else:
            m[:n] = (m[:n].reshape(-1, k) @ model.move).reshape(n, k, k)
        m[:n] *= ratios(f[:n] + t)[:, None, :]
        if t % 8 == 7 or t == steps - 1:
            s = m.max((1, 2))
            m /= s[:, None, None]
            logs += np.log10(s)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return m[back], logs[back]


def _chain(start: np.ndarray, matrices: np.ndarray, begin: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(state at the end of every segment, log10 of the scales of each row): the segments of all rows taken in turn."""
    ends = np.zeros((len(matrices), len(start)))
    logs = np.zeros(len(begin))
    v = np.tile(start, (len(begin), 1))
    for j in range(int(pieces.max()) if len(pieces) else 0):
        rows = np.flatnonzero(pieces > j)
        at = begin[rows] + j
        x = np.einsum("ni,nij->nj", v[rows], matrices[at])
        s = x.sum(1)
        v[rows] = ends[at] = x / s[:, None]
        logs[rows] += np.log10(s)
    return ends, logs


def expected_counts(model: Model, classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The E step over whole texts of counts tokens each: expected (emissions by class and state, moves, starts).

    Long texts are taken in segments at once: the state before each and what
    follows it come from the segments' matrices, so nothing is lost at a cut.
    """
    k = model.states
    row, first, length = _segments(counts, SEGMENT, WHOLE)
    opens = np.ones(len(row), bool)
    opens[1:] = row[1:] != row[:-1]
    before, after = np.tile(model.start, (len(row), 1)), np.ones((len(row), k))
    begin = np.flatnonzero(opens)
    pieces = np.diff(np.append(begin, len(row)))
    cut = np.flatnonzero(np.repeat(pieces > 1, pieces))
    if len(cut):
        some = pieces > 1
        at = np.cumsum(pieces[some]) - pieces[some]
        matrices, _ = _transfers(model, lambda i: model.ratio[classes[i]], first[cut], length[cut], opens[cut])
        ends, _ = _chain(model.start, matrices, at, pieces[some])
        inner = ~opens[cut]
        before[cut[inner]] = ends[np.flatnonzero(inner) - 1]
        w = np.ones((int(some.sum()), k))
        for j in range(int(pieces.max()) - 1, 0, -1):
            rows = np.flatnonzero(pieces[some] > j)
            x = np.einsum("nij,nj->ni", matrices[at[rows] + j], w[rows])
            w[rows] = x / x.sum(1, keepdims=True)
            after[cut[at[rows] + j - 1]] = w[rows]
    order = np.argsort(-length, kind="stable")
    first, length, opens, before, after = first[order], length[order], opens[order], before[order], after[order]
    steps = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -t, "left")) for t in range(steps)]  # segments longer than t
    alphas, given = [], []
    a = np.where(opens[:, None], before, before @ model.move)
    for t in range(steps):
        n = active[t]
        r = model.ratio[classes[first[:n] + t]]
        a = (a[:n] if t == 0 else a[:n] @ model.move) * r
        a /= a.sum(1, keepdims=True)
        alphas.append(a)
        given.append(r)
    emissions, moves = np.zeros_like(model.ratio), np.zeros((k, k))

    def add_moves(a: np.ndarray, x: np.ndarray) -> None:
        scale = 1 / ((a @ model.move) * x).sum(1, keepdims=True)
        moves[:] += model.move * (a.T @ (x * scale))

    b = np.ones((0, k))
    gammas, where = [], []
    for t in range(steps - 1, -1, -1):
        n = active[t]
        beta = after[:n].copy()  # of segments that end here
        if t + 1 < steps:
            m = active[t + 1]
            x = b * given[t + 1]
            beta[:m] = x @ model.move.T
            add_moves(alphas[t][:m], x)
        g = alphas[t] * beta
        g /= g.sum(1, keepdims=True)
        gammas.append(g)
        where.append(classes[first[:n] + t])
        b = beta / beta.sum(1, keepdims=True)
    if not steps:
        return emissions, moves, np.zeros(k)
    inner = ~opens
    if inner.any():  # from the last token before a cut to the first behind it
        add_moves(before[inner], (b * given[0])[inner])
    g, c = np.concatenate(gammas), np.concatenate(where)
    for s in range(k):
        emissions[:, s] = np.bincount(c, g[:, s], len(emissions))
    return emissions, moves, gammas[-1][opens].sum(0)


def maximise(emissions: np.ndarray, moves: np.ndarray, starts: np.ndarray, share: np.ndarray, weight: float = 20.0) -> Model:
    """The M step; a state's emissions are drawn towards the classes' shares with the weight of so many tokens."""
    move = moves + 0.5
    start = starts + 0.5
    by_class = emissions / np.maximum(share, 1e-300)[:, None]
    ratio = np.where(share[:, None] > 0, (by_class + weight) / (emissions.sum(0) + weight), 1.0)
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), ratio)


def start_model(segments: list[np.ndarray], states: int, kinds: int, steps: int = 25) -> Model:
    """States from segments of kinds classes that one machine holds, by Baum-Welch from seeded random ratios and sticky moves; for small corpora and tests."""
    rng = np.random.default_rng(5)
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    model = Model(np.full(states, 1 / states), move, rng.gamma(2.0, 0.5, (kinds, states)))
    if not segments:
        model.ratio[:] = 1.0
        return model
    length = np.array([len(s) for s in segments])
    classes = np.concatenate(segments)
    share = np.bincount(classes, minlength=kinds) / len(classes)
    for _ in range(steps):
        model = maximise(*expected_counts(model, classes, length), share, 5.0)
    return model


def pair_model(pairs: np.ndarray, own: np.ndarray, states: int, kinds: int, steps: int = 60, starts: int = 3) -> Model:
    """States from how often each word follows each other one, by expectation and maximisation on these counts.

    pairs has the words of the classes ``own`` in their order, and all other
    words as the last one.  Of some seeded starts the likeliest is kept.
    """
    total = pairs.sum()
    share = (pairs.sum(0) + pairs.sum(1) + 1e-9) / (2 * total + 1e-9 * 2 * len(pairs)) if total else np.full(len(pairs), 1 / len(pairs))
    best, most = (np.full((states, states), 1 / states**2), np.tile(share, (states, 1))), -np.inf
    for seed in range(starts if total else 0):
        rng = np.random.default_rng(5 + seed)
        joint = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(joint, 0.9 if states > 1 else 1.0)
        joint /= joint.sum()
        words = rng.gamma(2.0, 0.5, (states, len(pairs))) * share
        words /= words.sum(1, keepdims=True)
        for _ in range(steps):
            ratio = pairs / (words.T @ joint @ words + 1e-300)
            follow, lead = joint @ (words @ ratio.T), joint.T @ (words @ ratio)
            joint = joint * (words @ ratio @ words.T) + 0.5
            words = words * (follow + lead) + 5.0 * share
            joint /= joint.sum()
            words /= words.sum(1, keepdims=True)
        fit = float((pairs * np.log(words.T @ joint @ words + 1e-300)).sum())
        if fit > most:
            best, most = (joint, words), fit
    joint, words = best
    of = np.full(kinds, len(pairs) - 1)
    of[own] = np.arange(len(own))
    begin = joint.sum(1)
    return Model(begin / begin.sum(), joint / joint.sum(1, keepdims=True), (words / share).T[of])


def count_pairs(docs: DataFrame, paired: np.ndarray) -> np.ndarray:
    """How often each of the paired words (sorted hashes), or any other as the last, follows each other one in all texts of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(paired)
    kinds = len(paired) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        total = np.zeros(kinds * kinds, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                hashes, counts = tokens(block)
                at = classes_of(hashes, words)
                inside = np.ones(len(at), bool)  # not the last token of a text
                inside[np.cumsum(counts) - 1] = False
                first = np.flatnonzero(inside)
                total += np.bincount(at[first] * kinds + at[first + 1], minlength=kinds * kinds)
        if total.any():
            yield _parts_of(total.reshape(kinds, kinds))

    got = np.zeros((kinds, kinds))
    for part, x in _summed(docs.select("text").mapInArrow(count, _PARTS)):
        x = x.reshape(-1, kinds)
        got[part * _CLASSES_A_ROW :][: len(x)] += x
    shared.unpersist()
    return got


_PARTS = "part int, counts binary"


def _parts_of(table: np.ndarray, *more: tuple[int, np.ndarray]) -> pa.RecordBatch:
    """Rows (part, counts) of a table by class, and of further parts."""
    parts = [*((i // _CLASSES_A_ROW, table[i : i + _CLASSES_A_ROW]) for i in range(0, len(table), _CLASSES_A_ROW)), *more]
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()), pa.array([x.astype("<f8").tobytes() for _, x in parts], pa.binary())], names=["part", "counts"])


def _summed(parts: DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """The sums of the tasks' parts; together they have the model's size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(raw.as_py(), "<f8")
                sums[part] = sums[part] + x if part in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["part", "counts"])

    for r in parts.repartition("part").mapInArrow(add, _PARTS).collect():
        yield r["part"], np.frombuffer(r["counts"], "<f8")


def baum_welch_pass(docs: DataFrame, model: Model, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts over all whole texts of docs.  Each task sums its own; what comes together has the model's size."""
    shared = docs.sparkSession.sparkContext.broadcast((model, frequent))
    k, kinds = model.states, len(model.ratio)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, words = shared.value
        total = None
        for batch in batches:
            for block in blocks(batch.column(0), 2 * BLOCK_BYTES):
                hashes, counts = tokens(block)
                got = expected_counts(m, classes_of(hashes, words), counts)
                total = got if total is None else tuple(a + b for a, b in zip(total, got))
        if total is not None:
            yield _parts_of(total[0], (-1, np.concatenate([total[1], total[2][None]])))

    emissions, moves = np.zeros((kinds, k)), np.zeros((k + 1, k))
    for part, x in _summed(docs.select("text").mapInArrow(count, _PARTS)):
        x = x.reshape(-1, k)
        if part < 0:
            moves += x
        else:
            emissions[part * _CLASSES_A_ROW :][: len(x)] += x
    shared.unpersist()
    return emissions, moves[:-1], moves[-1]


def log10_likelihood_ratio(model: Model, classes: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row, log10 of P(row) / P_base(row), exactly, by the forward recursion in pieces.

    The recursion is linear in the state it begins with, so the pieces of all
    rows go through it at once, each for every beginning state, and are then
    chained row by row.  Values are scaled as they go.
    """
    row, first, length = _segments(counts, SEGMENT)
    opens = np.ones(len(row), bool)
    opens[1:] = row[1:] != row[:-1]
    matrices, scales = _transfers(model, lambda i: np.where(known[i, None], model.ratio[classes[i]], 1.0), first, length, opens)
    begin = np.flatnonzero(opens)
    _, logs = _chain(model.start, matrices, begin, np.diff(np.append(begin, len(row))))
    return logs + np.bincount(row, scales, len(counts))


def _chunked(docs: DataFrame) -> DataFrame:
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    return docs.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(max(1, size // CHUNK_BYTES))).cast("int"))


def _chunk_words(chunks: DataFrame) -> DataFrame:
    """Rows (chunk, hash, n): the distinct tokens of each chunk with their counts in training texts."""

    def count(table: pa.Table) -> pa.Table:
        keys, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        train = ~np.array(table.column("held_out").to_pylist(), bool)
        for block in blocks(table.column("text")):
            hashes, counts = tokens(block)
            weight = np.repeat(train[block.first : block.first + block.n], counts)
            key, at = np.unique(hashes, return_inverse=True)
            n = np.bincount(at, weight, len(key)).astype(np.int64)
            keys, at = np.unique(np.concatenate([keys, key]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([sums, n]), len(keys)).astype(np.int64)
        chunk = pa.array(np.full(len(keys), table.column("chunk")[0].as_py(), np.int32))
        return pa.table([chunk, pa.array(keys.view(np.int64)), pa.array(sums)], names=["chunk", "hash", "n"])

    return chunks.groupBy("chunk").applyInArrow(count, "chunk int, hash long, n long")


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", states: int = 8, passes: int = 2, alpha: float = 0.1) -> DataFrame:
    """For every row of docs: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where held_out is false.  base_score is the sum of
    log10((c + alpha) / (N + alpha * (V + 1))) over the tokens, score the
    model's log10 probability of the whole text.  Null and empty texts are one
    end token.  Where held_out is null, as for a null id, a row is for
    training.  Repeated rows count each.  Very long texts are learnt from and
    scored whole.  Extra columns are not read.  Without training rows both
    scores are 0.  Words are told apart by 64-bit hashes.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where(~F.col("held_out"))
    chunks = _chunked(rows)
    words = settle(_chunk_words(chunks), "chunk-words")
    counts = settle(words.groupBy("hash").agg(F.sum("n").alias("c")).where(F.col("c") > 0), "word-counts")
    whole = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    total, kinds = int(whole[0] or 0), int(whole[1])
    floor = total + alpha * (kinds + 1)
    # the most frequent words, at most VOCABULARY rows of two numbers
    top = counts.orderBy(F.desc("c"), "hash").limit(VOCABULARY).toArrow()
    hashes, count = top.column("hash").to_numpy().view(np.uint64), top.column("c").to_numpy().astype(np.float64)
    order = np.argsort(hashes)
    frequent = hashes[order]
    share = np.append(count[order] + alpha, total - count.sum() + alpha * (kinds - len(top))) / max(total + alpha * kinds, 1)

    own = np.sort(np.argsort(order)[:PAIRED])  # the most frequent ones, by their places in frequent
    model = pair_model(count_pairs(train, frequent[own]), own, states, len(frequent) + 1)
    for _ in range(passes if total else 0):
        model = maximise(*baum_welch_pass(train, model, frequent), share)
    shared = docs.sparkSession.sparkContext.broadcast((model, frequent))
    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds_of = [T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), *(T.StructField(n, t) for n, t in zip(names[2:], kinds_of))])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        m, own = shared.value
        key, c = right.column("hash").to_numpy().view(np.uint64), right.column("c").to_numpy()
        order = np.argsort(key)
        key, c = key[order], c[order]
        out: list[list[np.ndarray]] = []
        for block in blocks(left.column("text")):
            hashes, n = tokens(block)
            at = np.minimum(np.searchsorted(key, hashes), max(len(key) - 1, 0))
            seen = np.where(key[at] == hashes, c[at], 0) if len(key) else np.zeros(len(hashes), np.int64)
            row = np.repeat(np.arange(block.n), n)
            base = np.bincount(row, np.log10((seen + alpha) / floor), block.n)
            known = np.bincount(row, seen > 0, block.n).astype(np.int64)
            out.append([n.astype(np.int64), known, base, base + log10_likelihood_ratio(m, classes_of(hashes, own), seen > 0, n)])
        n, known, base, full = (np.concatenate(x) for x in zip(*out))
        return pa.table([left.column("id"), left.column("held_out"), pa.array(n), pa.array(known), pa.array(np.full(len(n), total)), pa.array(base), pa.array(full)], names=names)

    looked_up = words.select("chunk", "hash").join(counts, "hash").select("chunk", "hash", "c")
    return chunks.groupBy("chunk").cogroup(looked_up.groupBy("chunk")).applyInArrow(score, schema)
