"""Toxicity by multiple-instance learning.

A document is a bag of sentences; a sentence has a probability of being toxic
(logistic in its words), and a document is toxic unless none of its sentences
is: p = 1 - prod(1 - p_s), the noisy-or. The word weights are trained from
document labels alone, through the noisy-or, and then point at the sentences
that made a document toxic.

* Words are the runs of word characters, lower-cased; a word counts with its
  beginnings (``STEMS``), once per sentence. Only those of at least ``MIN_DOCS``
  training documents get a weight, and weights are kept sparse by a proximal
  step, so a document of rare words is not toxic by chance.
* Sentences end at . ! ? and line feeds and are cut after ``MAX_WORDS`` words,
  so text without marks cannot add up small weights without end.
* A sentence enters the noisy-or by itself only if its words raise its odds
  above the offset; all others count as one sentence at the offset, so a text's
  odds do not rise with its number of sentences alone.
* The model is fitted on a bounded sample of labelled rows (``TRAIN_ROWS``);
  every document is scored, whole. A closing logistic curve on the bag's
  log-odds puts scores on the labels' scale.

Inputs of a score are the text alone. Defined cases: NULL and empty texts have
no sentences and get the score of a bag with nothing toxic in it; without
labelled rows of both kinds every score is the share of toxic labels (0 without
any). Every row gets a row of its own, repeated rows too, and equal texts equal
scores (ties); a very long text is scored whole; an empty table gives an empty
result. Other columns are not read (``keep_clean`` hands them on), whatever their
names.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from meterline.llm.common import batch_of, map_rows
from meterline.llm.labels import fitted, labelled_sample

#: Labelled documents the model is fitted on, at most.
TRAIN_ROWS = 8000
MIN_DOCS = 4
MAX_WORDS = 40
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
#: A sentence at or above this probability is reported as offending.
OFFENDING = 0.5


#: Beginnings of a word that count beside the word itself.
STEMS = range(4, 9)
#: Words a worker remembers before it starts its table anew.
REMEMBERED = 400_000


def features(word: str) -> list[str]:
    """A word and its beginnings, so that forms of one stem share weight."""
    return [word, *("^" + word[:n] for n in STEMS if n < len(word))]


def instances(sentence: str) -> Iterator[list[str]]:
    """The distinct words of a lower-cased sentence, cut after MAX_WORDS."""
    words = WORD.findall(sentence)
    for i in range(0, len(words), MAX_WORDS):
        yield list(dict.fromkeys(words[i:i + MAX_WORDS]))


class Bags:
    """Feature weights, the sentence offset and the closing curve."""

    def __init__(self, weights: dict[str, float], offset: float, slope: float = 1.0,
                 shift: float = 0.0, flat: float | None = None):
        self.weights, self.offset, self.slope, self.shift = weights, offset, slope, shift
        self.flat = flat
        self.marks: dict[str, tuple[str, ...]] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "marks": {}}

    def _marks(self, word: str) -> tuple[str, ...]:
        """The word's features that have a weight."""
        if len(self.marks) >= REMEMBERED:
            self.marks.clear()
        got = self.marks[word] = tuple(f for f in features(word) if f in self.weights)
        return got

    def _odds(self, words: list[str]) -> float:
        marks = self.marks
        hit: set[str] = set()
        for w in words:
            m = marks.get(w)
            if m is None:
                m = self._marks(w)
            if m:
                hit.update(m)
        return self.offset + sum([self.weights[f] for f in hit]) if hit else self.offset

    def bag_odds(self, text: str | None) -> float:
        """Log-odds of the noisy-or over the text's raised sentences and the rest."""
        none = -math.log1p(math.exp(self.offset))   # log of the probability that no sentence is toxic
        for s in SENTENCE.findall((text or "").lower()):
            for words in instances(s):
                z = self._odds(words)
                if z > self.offset:
                    none -= math.log1p(math.exp(min(z, 40.0)))
        none = min(none, -1e-12)
        return math.log(-math.expm1(none)) - none

    def score(self, text: str | None) -> float:
        if self.flat is not None:
            return self.flat
        z = min(max(self.slope * self.bag_odds(text) + self.shift, -60.0), 60.0)
        return 1 / (1 + math.exp(-z))

    def sentences(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, probability) of each sentence, in characters."""
        out = []
        for m in SENTENCE.finditer(text or ""):
            z = max(map(self._odds, instances(m[0].lower())), default=None)
            if z is not None and self.flat is None:
                out.append((m.start(), m.end(), 1 / (1 + math.exp(-min(max(z, -60.0), 60.0)))))
        return out


def sentence_features(text: str | None) -> list[set[str]]:
    """The features of each instance of a text."""
    return [{f for w in words for f in features(w)}
            for s in SENTENCE.findall((text or "").lower()) for words in instances(s)]


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of least log-loss (Newton)."""
    w = np.array([1.0, 0.0])
    z = np.column_stack([x, np.ones(len(x))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(h, z.T @ (y - p) - 1e-3 * (w - [1.0, 0.0]))
    return max(float(w[0]), 1e-3), float(w[1])


Vocabulary = dict[str, tuple[int, int, int]]


def vocabulary(counts: list[tuple[str, int, int]]) -> Vocabulary:
    """(place, documents, toxic documents) of each feature of enough documents."""
    enough = sorted(c for c in counts if c[1] >= MIN_DOCS)
    return {f: (i, n, toxic) for i, (f, n, toxic) in enumerate(enough)}


def bag_of(text: str | None, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, int]:
    """(instance, feature) places of a text, and its number of instances."""
    bag = sentence_features(text)
    sent, word = array("I"), array("I")
    for k, s in enumerate(bag):
        got = sorted(vocab[f][0] for f in s if f in vocab)
        word.extend(got)
        sent.extend([k] * len(got))
    return np.frombuffer(sent, "<u4"), np.frombuffer(word, "<u4"), len(bag)


def fit(labels: list[int], bags: list[tuple[np.ndarray, np.ndarray, int]], vocab: Vocabulary,
        steps: int = 120, l1: float = 1e-4) -> Bags:
    """A model from whole documents' labels and bags (as ``bag_of`` makes them)."""
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return Bags({}, 0.0, flat=float(y.mean()) if labels else 0.0)
    sizes = np.array([n for *_, n in bags])
    first = np.concatenate([[0], np.cumsum(sizes)])
    k = int(first[-1])
    doc = np.repeat(np.arange(len(bags)), sizes)
    sent = np.concatenate([s.astype("i4") + first[i] for i, (s, _, _) in enumerate(bags)]).astype("i4")
    word = np.concatenate([w for _, w, _ in bags]).astype("i4")
    n1, n0 = y.sum(), len(y) - y.sum()
    # Start from each feature's log-odds, shrunk towards none.
    w = np.zeros(len(vocab))
    for i, n, toxic in vocab.values():
        w[i] = math.log((toxic + 0.5) / (n1 + 1)) - math.log((n - toxic + 0.5) / (n0 + 1))
    w = np.sign(w) * np.maximum(np.abs(w) - 1.5, 0.0)
    b = -5.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        up = np.bincount(sent, w[word], k)
        p = np.where(up > 0, 1 / (1 + np.exp(-np.clip(b + up, -40, 40))), 0.0)
        rest = 1 / (1 + math.exp(-min(max(b, -40.0), 40.0)))
        none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + math.log1p(-min(rest, 1 - 1e-9))
        bag = np.clip(-np.expm1(none), 1e-9, 1 - 1e-9)
        # d log-likelihood / dz of a sentence: p (y - bag) / bag
        pull = (y - bag) / bag
        g = p * pull[doc]
        gw, gb = np.bincount(word, g[sent], len(w)) / len(y), (g.sum() + rest * pull.sum()) / len(y)
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-4)
        w = w + rate * m / (1 - 0.9 ** t)
        w = np.sign(w) * np.maximum(np.abs(w) - l1 * rate, 0.0)
        b += 0.1 * (mb / (1 - 0.9 ** t)) / (math.sqrt(vb / (1 - 0.99 ** t)) + 1e-8)
    names = list(vocab)
    model = Bags({names[i]: float(w[i]) for i in np.flatnonzero(np.abs(w) > 1e-3)}, float(b))
    up = np.bincount(sent, w[word], k)
    none = np.bincount(doc, np.where(up > 0, -np.logaddexp(0, np.minimum(b + up, 40)), 0.0), len(y))
    none = none - math.log1p(math.exp(b))
    none = np.minimum(none, -1e-12)
    model.slope, model.shift = _curve(np.log(-np.expm1(none)) - none, y)
    return model


def fit_texts(rows: list[tuple[str, int]]) -> Bags:
    """A model from (text, label) of whole documents."""
    n, toxic = Counter(), Counter()
    for text, y in rows:
        own = set().union(*sentence_features(text))
        n.update(own)
        if y:
            toxic.update(own)
    vocab = vocabulary([(f, k, toxic[f]) for f, k in n.items() if k >= MIN_DOCS])
    del n, toxic
    return fit([y for _, y in rows], [bag_of(text, vocab) for text, _ in rows], vocab)


def train(docs: DataFrame, labels: DataFrame, admit: Column, rows: int = TRAIN_ROWS) -> Bags:
    """Fit on at most ``rows`` labelled documents for which ``admit`` holds."""
    return fitted(labelled_sample(docs, labels, "toxic", admit, rows), fit_texts)


def score_documents(docs: DataFrame, model: Bags) -> DataFrame:
    """doc_id, score of every document."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batches:
            yield batch_of(doc_id=(keys, pa.int64()),
                           score=([model.score(t) for t in texts], pa.float64()))
    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, score double")


def offending_sentences(docs: DataFrame, model: Bags, threshold: float = OFFENDING) -> DataFrame:
    """doc_id, start, end, p, text of every sentence found toxic."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batches:
            found = [(key, a, b, p, text[a:b]) for key, text in zip(keys, texts)
                     for a, b, p in model.sentences(text) if p >= threshold]
            cols = list(zip(*found)) or [()] * 5
            yield batch_of(doc_id=(cols[0], pa.int64()), start=(cols[1], pa.int64()),
                           end=(cols[2], pa.int64()), p=(cols[3], pa.float64()),
                           text=(cols[4], pa.string()))
    return map_rows(docs.select("doc_id", "text"), run,
                    "doc_id long, start long, end long, p double, text string")


def keep_clean(docs: DataFrame, model: Bags, threshold: float = 0.3) -> DataFrame:
    """The rows whose text scores below ``threshold``, all columns unchanged."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([model.score(t) < threshold
                                     for t in b.column(at).to_pylist()], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
