import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import quality, toxicity
from meterline.llm.labels import labelled_sample
from meterline.llm.queries import op3_quality, op10_toxicity
from tests.conftest import SF001, SF01
from tests.llm.helpers import LONG, awkward, empty, rows, stored

LABELS = "doc_id long, quality int, toxic int"


def held_out(spark, query, label, folds, held):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    got = query(spark, SF01).collect()
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    return [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]


def test_quality_of_held_out_documents(spark):
    pairs = held_out(spark, op3_quality, "quality", 5, 0)
    assert np.mean([a == b for a, b in pairs]) > 0.95
    assert np.mean([b for a, b in pairs if a == 1]) > 0.97


def test_toxicity_of_held_out_documents(spark):
    pairs = held_out(spark, op10_toxicity, "toxic", 4, 2)
    assert np.mean([a == b for a, b in pairs]) > 0.93
    assert np.mean([1 - b for a, b in pairs if a == 0]) > 0.97


def field():
    rnd = np.random.default_rng(3)
    return quality.LineField(rnd.normal(size=quality.WIDTH), rnd.normal(size=(2, 2)), 2.0, -1.0)


def test_marginals_equal_enumeration():
    f = field()
    odds = np.random.default_rng(4).normal(size=6) * 2
    weight = {}
    for ys in itertools.product((0, 1), repeat=6):
        s = sum(o for o, y in zip(odds, ys) if y) + sum(f.moves[a, b] for a, b in zip(ys, ys[1:]))
        weight[ys] = math.exp(s)
    total = sum(weight.values())
    want = [sum(w for ys, w in weight.items() if ys[t]) / total for t in range(6)]
    assert np.allclose(f.marginals(odds), want)


def test_neighbours_change_a_line_and_length_weighs():
    f = field()
    text = "One line of prose here.\n!!!! ####\nAnother line, quite like the first."
    own, _ = quality.line_features(text)
    assert np.allclose(f.lines(text)[0], f.marginals(quality.chain_features(own) @ f.weights), atol=1e-5)
    p, n = f.lines(text)
    assert f.mean(text) == pytest.approx(np.dot(p, n + 1) / (n + 1).sum())


def test_chain_gradient_raises_the_likelihood():
    docs = [(1, "Good words stand here in a row.\nMore of them follow.")] * 20 + \
           [(0, "A|| B|| C||\n### ### ###\n!!!")] * 20
    f = quality.fit([(y, *quality.line_features(t)) for y, t in docs])
    assert f.score(docs[0][1]) > 0.9 and f.score(docs[-1][1]) < 0.1
    assert f.moves[0, 0] + f.moves[1, 1] > f.moves[0, 1] + f.moves[1, 0]


def test_noisy_or_equals_its_definition():
    bags = toxicity.Bags({"bad": 3.0, "^awfu": 2.0}, -2.0)
    odds = [-2.0, 1.0, 0.0]
    p = 1 - math.prod(1 - 1 / (1 + math.exp(-z)) for z in odds)
    text = "Nothing here. This is bad! Such awfulness\n"
    assert bags.bag_odds(text) == pytest.approx(math.log(p / (1 - p)))
    assert [round(s[2], 6) for s in bags.sentences(text)] == [
        round(1 / (1 + math.exp(-z)), 6) for z in odds]


def test_offending_sentences_are_located(spark):
    texts = [(1, f"We walk to town {i}. You scum fool. Fine day.") for i in range(40)] + \
            [(0, f"We walk to town {i}. Fine day. Good soup.") for i in range(160)]
    model = toxicity.fit_texts([(t, y) for y, t in texts])
    text = "Fine day. You scum fool! Good soup."
    docs = spark.createDataFrame([(1, text), (2, "Good soup."), (3, None)], "doc_id long, text string")
    out = toxicity.offending_sentences(docs, model).collect()
    assert [(r["doc_id"], text[r["start"]:r["end"]]) for r in out] == [(1, " You scum fool")]


@pytest.mark.parametrize("query", [op3_quality, op10_toxicity])
def test_awkward_rows(spark, query):
    labels = [(i, q, 1 - q) for i, q in ((1, 1), (1, 0), (2, 1), (5, 0), (6, 1), (10, 0))]
    labels += [(None, 1, 1), (7, None, None), (77, 1, 0)]
    at = stored(spark, "labels", documents=awkward(spark), labels=spark.createDataFrame(labels, LABELS))
    got = query(spark, at).collect()
    assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(r[0]) for r in rows())
    assert all(0 <= r["score"] <= 1 for r in got)
    same = {r["score"] for r in got if r["doc_id"] in (3, 4)}
    assert len(same) == 1   # NULL and empty texts alike


@pytest.mark.parametrize("query", [op3_quality, op10_toxicity])
def test_no_labels_or_no_documents(spark, query):
    none = spark.createDataFrame([], LABELS)
    at = stored(spark, "nolabels", documents=awkward(spark), labels=none)
    flat = 1.0 if query is op3_quality else 0.0
    assert {r["score"] for r in query(spark, at).collect()} == {flat}
    assert query(spark, stored(spark, "nodocs", documents=empty(spark), labels=none)).count() == 0


def test_long_text_is_scored_whole():
    bags = toxicity.Bags({"bad": 6.0}, -6.0)
    assert bags.score(LONG + " bad bad. " + LONG) < bags.score(LONG + " bad. bad. " + LONG)
    assert bags.score(LONG) < bags.score(LONG + " bad")
    f = field()
    assert f.mean("Some prose.\n" * 5000 + "#" * 50_000) != f.mean("Some prose.\n" * 5000)


def test_length_alone_is_not_toxic():
    texts = [(f"We walk to town {i}. You scum fool. Fine day.", 1) for i in range(40)] + \
            [(f"We walk to town {i}. Fine day. Good soup.", 0) for i in range(160)]
    model = toxicity.fit_texts(texts)
    clean = [t for t, y in texts if not y]
    assert all(model.score(t) < 0.3 for t in clean)
    assert model.score(" ".join(clean * 200)) < 0.3
    assert model.score("Unknown words here. " * 100_000) == pytest.approx(model.score(None))
    assert model.score(" ".join(clean * 200) + " You scum fool.") > 0.5


def plain_quality(f, text):
    """The field's score by its definition: own and neighbours' features line by
    line, marginals from products of 2 x 2 matrices, the length-weighted mean."""
    own, lengths = quality.line_features(text)
    rows = quality.chain_features(own).astype(float)
    emit = [np.diag([1.0, math.exp(float(r @ f.weights))]) for r in rows]
    step = np.exp(f.moves)
    left, right = [np.ones(2)], [np.ones(2)]
    for e in emit[:-1]:
        v = left[-1] @ e @ step
        left.append(v / v.sum())
    for e in emit[:0:-1]:
        v = step @ e @ right[-1]
        right.append(v / v.sum())
    total = good = 0.0
    for a, e, b, n in zip(left, emit, reversed(right), lengths):
        bad_good = a * np.diag(e) * b
        good += (n + 1) * bad_good[1] / bad_good.sum()
        total += n + 1
    return 1 / (1 + math.exp(-(f.slope * good / total + f.offset)))


def test_quality_rows_equal_the_definition(spark, monkeypatch):
    fields = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda *a: fields.append(train(*a)) or fields[-1])
    got = op3_quality(spark, SF001).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        assert r["score"] == pytest.approx(plain_quality(fields[0], texts[r["doc_id"]]), abs=1e-4)


def plain_toxicity(m, text):
    """Noisy-or over the raised sentences and one at the offset, by its definition."""
    def p(z):
        return 1 / (1 + math.exp(-z))
    raised = []
    for words in (w for s in toxicity.SENTENCE.findall((text or "").lower()) for w in toxicity.instances(s)):
        z = m.offset + sum(m.weights.get(x, 0.0) for x in {x for w in words for x in toxicity.features(w)})
        raised += [z] if z > m.offset else []
    clean = math.prod(1 - p(z) for z in [m.offset, *raised])
    return p(m.slope * math.log((1 - clean) / clean) + m.shift)


def test_toxicity_rows_equal_the_definition(spark, monkeypatch):
    models = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *a: models.append(train(*a)) or models[-1])
    got = op10_toxicity(spark, SF001).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        assert r["score"] == pytest.approx(plain_toxicity(models[0], texts[r["doc_id"]]), abs=1e-6)


def test_an_id_on_many_rows_is_one_row_of_the_sample(spark):
    docs = spark.range(300).select(F.when(F.col("id") < 200, 1).otherwise(F.col("id")).alias("doc_id"),
                                   F.concat(F.lit("text "), F.col("id")).alias("text"))
    marks = docs.select("doc_id", F.lit(1).alias("toxic")).distinct()
    got = labelled_sample(docs, marks, "toxic", F.lit(True), 1000).collect()
    assert sorted(r["doc_id"] for r in got) == [1, *range(200, 300)]
    again = labelled_sample(docs.repartition(7), marks, "toxic", F.lit(True), 1000).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in got}
