"""Document quality from a linear-chain conditional random field over lines.

Every line gets a label, good or bad. A line's features are its character
classes, repeated words and length, put in steps, and those of the lines before
and after it; the chain's transition weights let neighbouring lines agree.
Forward-backward gives each line's probability of being good, and a document's
quality is their mean weighted by line length, put on the labels' scale by a
logistic curve.

Training has document labels only. A plain classifier first learns lines from
their document's label; lines of bad documents that it finds as good as those
of good documents are then taken as good, and the chain is fitted to these line
labels by gradient ascent of its likelihood. It is fitted on a bounded sample
of labelled rows (``TRAIN_ROWS``); every document is scored, whole.

Inputs of a score are the text alone. Defined cases: NULL and empty texts are
one empty line; a text without line feeds is one line; without labelled rows of
both kinds every score is the share of good labels (1 without any). Every row gets a
row of its own, repeated rows too, and equal texts equal scores (ties); a very
long text is scored whole, holding its lines' features; an empty table gives an
empty result. Other columns are not read (``keep_good`` hands them on), whatever
their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from meterline.llm.common import batch_of, map_rows
from meterline.llm.labels import fitted, labelled_sample

#: Labelled documents the field is fitted on, at most.
TRAIN_ROWS = 4000
#: Steps of a share; a feature says which step a line's share has reached.
STEPS = np.array([0.004, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6])
SHARES = ("upper", "digit", "blank", "stop", "bang", "bar", "symbol", "other", "again", "repeat")
LENGTH_STEPS = np.array([1, 10, 30, 80, 200, 600, 2000])
OWN = len(SHARES) * len(STEPS) + len(LENGTH_STEPS) + 1
WIDTH = 3 * OWN + 1
#: Lines of one chain in training (longer documents give several chains).
CHAIN = 32


def _classes() -> np.ndarray:
    """Character class of each byte: 0 for letters, else 1 + its place in SHARES."""
    out = np.full(256, 8, "u1")
    out[ord("a"):ord("z") + 1] = 0
    out[128:] = 0
    for chars, k in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b" \t\r", 3),
                     (b".,;:'\"-()", 4), (b"!?", 5), (b"|", 6), (b"#&$%*@^~=<>{}[]\\/_+`", 7)):
        out[list(chars)] = k
    return out


CLASS = _classes()


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Own features of each line (lines x OWN, 0/1) and the lines' lengths."""
    lines = (text or "").split("\n")
    raw = (text or "").encode("utf-8", "replace")
    codes = CLASS[np.frombuffer(raw, "u1")]
    ends = np.flatnonzero(np.frombuffer(raw, "u1") == 10)
    starts = np.concatenate([[0], ends + 1])
    lengths = np.diff(np.concatenate([starts, [len(raw) + 1]])) - 1
    size = np.maximum(lengths, 1)[:, None]
    # Counts per line as differences of running sums.
    counts = np.empty((len(lines), 8))
    for k in range(8):
        run = np.concatenate([[0], np.cumsum(codes == k + 1)])
        counts[:, k] = run[starts + lengths] - run[starts]
    shares = np.empty((len(lines), len(SHARES)))
    shares[:, :8] = counts / size
    seen: set[str] = set()
    for i, line in enumerate(lines):
        words = line.split()
        shares[i, 8] = 1.0 if line in seen and words else 0.0
        seen.add(line)
        shares[i, 9] = 1 - len(set(words)) / len(words) if len(words) > 3 else 0.0
    x = np.empty((len(lines), OWN), "f4")
    at = len(SHARES) * len(STEPS)
    x[:, :at] = (shares[:, :, None] >= STEPS).reshape(len(lines), at)
    x[:, at:-1] = lengths[:, None] >= LENGTH_STEPS
    # A line's repeated words mean more the more of them there are.
    x[:, -1] = (shares[:, 9] > 0.5) & (lengths > 200)
    return x, lengths


def chain_features(own: np.ndarray) -> np.ndarray:
    """Features of each line with those of its neighbours and a constant."""
    none = np.zeros((1, OWN), own.dtype)
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]),
                      np.ones((len(own), 1), own.dtype)])


@dataclass
class LineField:
    """Weights: emission log-odds of good, transitions [from][to] (bad, good),
    and the curve that turns a mean probability into a score."""
    weights: np.ndarray
    moves: np.ndarray
    slope: float
    offset: float

    def marginals(self, odds: np.ndarray) -> list[float]:
        """P(good) of each line from its emission log-odds. With two labels a
        message is one number, the log-odds it carries."""
        (bb, bg), (gb, gg) = self.moves.tolist()
        n, e = len(odds), odds.tolist()

        def carry(r: float, b0: float, b1: float, g0: float, g1: float) -> float:
            # log of (bad -> good + good -> good) over (bad -> bad + good -> bad)
            up = max(b1, g1 + r) + math.log1p(math.exp(-abs(b1 - g1 - r)))
            down = max(b0, g0 + r) + math.log1p(math.exp(-abs(b0 - g0 - r)))
            return up - down

        ahead = [0.0] * n
        for t in range(1, n):
            ahead[t] = carry(ahead[t - 1] + e[t - 1], bb, bg, gb, gg)
        back, out = 0.0, [0.0] * n
        for t in range(n - 1, -1, -1):
            if t < n - 1:
                back = carry(back + e[t + 1], bb, gb, bg, gg)
            z = min(max(ahead[t] + e[t] + back, -60.0), 60.0)
            out[t] = 1 / (1 + math.exp(-z))
        return out

    def lines(self, text: str | None) -> tuple[list[float], np.ndarray]:
        """P(good) and length of every line."""
        own, lengths = line_features(text)
        # The neighbours' share of the odds is a shifted product: no wide copy.
        w = self.weights
        odds = own @ w[:OWN] + w[-1]
        odds[1:] += own[:-1] @ w[OWN:2 * OWN]
        odds[:-1] += own[1:] @ w[2 * OWN:3 * OWN]
        return self.marginals(odds), lengths

    def mean(self, text: str | None) -> float:
        """Length-weighted mean of P(good)."""
        p, lengths = self.lines(text)
        weight = lengths + 1.0
        return float(np.dot(p, weight) / weight.sum())

    def score(self, text: str | None) -> float:
        if not self.slope:
            return self.offset
        z = min(max(self.slope * self.mean(text) + self.offset, -60.0), 60.0)
        return 1 / (1 + math.exp(-z))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int, l2: float) -> np.ndarray:
    w = np.zeros(x.shape[1], x.dtype)   # the features' type: no wider copies
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = (weight / weight.sum()).astype(x.dtype)
    y = y.astype(x.dtype)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ ((y - p) * weight) - l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w + 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def _fit_chain(x: np.ndarray, y: np.ndarray, chains: list[slice], w: np.ndarray, steps: int,
               l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient ascent of the chains' log-likelihood (forward-backward over all
    chains at once, padded to CHAIN lines)."""
    index = np.full((len(chains), CHAIN), -1)
    for i, c in enumerate(chains):
        index[i, :c.stop - c.start] = np.arange(c.start, c.stop)
    there = index >= 0
    gold = np.where(there, y[index].astype(int), 0)
    both = there[:, 1:] & there[:, :-1]
    moves_seen = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & both).sum()
                            for b in (0, 1)] for a in (0, 1)], float)
    n = there.sum()
    w, moves = w.copy(), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(moves), np.zeros_like(moves)]
    for t in range(1, steps + 1):
        e = np.zeros((len(chains), CHAIN, 2))
        e[:, :, 1] = np.where(there, (x @ w)[index], 0.0)
        move = np.where(both[:, :, None, None], moves, 0.0)
        a = np.empty_like(e)
        a[:, 0] = e[:, 0]
        for k in range(1, CHAIN):
            a[:, k] = np.logaddexp.reduce(a[:, k - 1, :, None] + move[:, k - 1], axis=1) + e[:, k]
        b = np.zeros_like(e)
        for k in range(CHAIN - 2, -1, -1):
            b[:, k] = np.logaddexp.reduce(move[:, k] + (e[:, k + 1] + b[:, k + 1])[:, None, :], axis=2)
        z = np.logaddexp.reduce(a[:, -1], axis=1)
        good = np.exp(a[:, :, 1] + b[:, :, 1] - z[:, None])
        pair = np.exp(a[:, :-1, :, None] + move + (e[:, 1:] + b[:, 1:])[:, :, None, :]
                      - z[:, None, None, None])
        p = np.empty(len(y))
        p[index[there]] = good[there]
        g = x.T @ ((y - p) / n).astype(x.dtype) - l2 * w
        gm = (moves_seen - (pair * both[:, :, None, None]).sum((0, 1))) / n - l2 * moves
        for grad, (i, j), target in ((g, (0, 1), w), (gm, (2, 3), moves)):
            state[i] = 0.9 * state[i] + 0.1 * grad
            state[j] = 0.99 * state[j] + 0.01 * grad * grad
            target += 0.05 * (state[i] / (1 - 0.9 ** t)) / (np.sqrt(state[j] / (1 - 0.99 ** t)) + 1e-8)
    return w, moves


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> LineField:
    """A field from (label, own features, line lengths) of whole documents."""
    labels = np.array([r[0] for r in rows], float)
    if len(set(labels.tolist())) < 2:
        return LineField(np.zeros(WIDTH), np.zeros((2, 2)), 0.0,
                         float(labels.mean()) if len(rows) else 1.0)
    x = np.vstack([chain_features(own) for _, own, _ in rows]).astype("f4")
    sizes = np.array([len(own) for _, own, _ in rows])
    lengths = np.concatenate([n for _, _, n in rows]).astype(float)
    y = np.repeat(labels, sizes)
    # Lines weigh by the root of their length, both labels the same in all.
    weight = np.sqrt(lengths + 1)
    for k in (0, 1):
        weight[y == k] /= weight[y == k].sum()
    first = _logistic(x, y, weight, 150, 1e-4)
    odds = x @ first
    # As good as the median line of good documents: good wherever it stands.
    y = np.where((y == 0) & (odds > np.median(odds[y == 1])), 1.0, y)
    chains, at = [], 0
    for n in sizes:
        chains += [slice(i, min(i + CHAIN, at + n)) for i in range(at, at + n, CHAIN)]
        at += n
    weights, moves = _fit_chain(x, y, chains, first, 80, 1e-4)
    field = LineField(weights, moves, 1.0, 0.0)
    means, at = np.empty(len(rows)), 0
    emission = (x @ weights).astype(float)
    for i, n in enumerate(sizes):
        p = field.marginals(emission[at:at + n])
        means[i] = np.dot(p, lengths[at:at + n] + 1) / (lengths[at:at + n] + 1).sum()
        at += n
    a, b = _logistic(np.column_stack([means, np.ones(len(means))]), labels,
                     np.ones(len(means)), 400, 1e-4)
    return LineField(weights, moves, float(a), float(b))


def train(docs: DataFrame, labels: DataFrame, admit: Column, rows: int = TRAIN_ROWS) -> LineField:
    """Fit on at most ``rows`` labelled documents for which ``admit`` holds."""
    return fitted(labelled_sample(docs, labels, "quality", admit, rows),
                  lambda got: fit([(y, *line_features(text)) for text, y in got]))


def score_documents(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id, score of every document."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batches:
            yield batch_of(doc_id=(keys, pa.int64()),
                           score=([field.score(t) for t in texts], pa.float64()))
    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, score double")


def label_lines(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id, line (from 0), good (boolean), p_good of every line."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batches:
            for key, text in zip(keys, texts):
                p, _ = field.lines(text)
                yield batch_of(doc_id=([key] * len(p), pa.int64()),
                               line=(list(range(len(p))), pa.int64()),
                               good=([v >= 0.5 for v in p], pa.bool_()), p_good=(p, pa.float64()))
    return map_rows(docs.select("doc_id", "text"), run,
                    "doc_id long, line long, good boolean, p_good double")


def keep_good(docs: DataFrame, field: LineField, threshold: float = 0.3) -> DataFrame:
    """The rows whose text scores at least ``threshold``, all columns unchanged.
    Scoring happens where the row is: nothing is joined or moved."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([field.score(t) >= threshold
                                     for t in b.column(at).to_pylist()], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
