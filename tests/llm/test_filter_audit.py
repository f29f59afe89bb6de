from collections import Counter, defaultdict
from itertools import permutations
import re

import numpy as np

from pyspark.sql import functions as F

import __spark_entry__ as E
from meterline.llm import filter_audit
from meterline.llm.queries import op11_filter_audit
from tests.conftest import SF001
from tests.llm.helpers import awkward, empty, stored
from tests.oracle_harness import compare, duck

LABELS = "doc_id long, quality int, toxic int, n long, l0 long"


def brute(docs, labels):
    """Every order walked document by document."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    parts = defaultdict(list)
    for i, t, lang in docs:
        t = t or ""
        w = [x for x in re.split("[ \x09-\x0d]+", t) if x]
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": re.search(r"[#$%&*|]", t) is not None,
                 "E": i is not None and t in first and first[t] < i}
        parts[lang or ""].append((i, {f for f, x in fails.items() if x}))
    out, shapley = {}, Counter()
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = sum(f in x for _, x in rows)
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(x == {f} for _, x in rows),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]):
           tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
           for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_its_sql(spark):
    r = compare(spark, "op11_filter_audit", SF001, duck(SF001))
    assert r["status"] == "ok" and not r.get("types"), r
    assert "op11_filter_audit" in E.oracle_sql()


def test_awkward_rows_against_every_order_walked(spark):
    long = " ".join(f"w{i}" for i in range(150))
    more = [(20, long, "de"), (21, long, "en"), (21, long, "en"), (19, long, None), (22, long + " $", "en"),
            (23, "SHOUT " * 120, "en"), (24, "a\x0bb\x0cc\td\ne\r" * 40, "en"), (None, long, "en"), (25, "\x85  ", "")]
    df = awkward(spark).unionByName(
        spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    labels = [(20, 1, 0), (21, 1, 1), (21, 0, None), (23, None, 1), (6, 1, 0), (None, 1, 1), (99, 1, 1)]
    at = stored(spark, "audit", documents=df,
                labels=spark.createDataFrame([(*r, 7, 7) for r in labels], LABELS))
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]
    got, want = found(op11_filter_audit(spark, at)), brute(docs, labels)
    assert got == want and len(got) == 600 * len({lang or "" for *_, lang in docs})


def test_paths_and_shapley_add_up():
    forward, backward = filter_audit.paths(4)
    assert forward[0b1111] == backward[0] == 24
    counts = np.random.default_rng(3).integers(0, 50, (1, 16))
    edges = list(filter_audit.edges_of(counts, 4))
    assert len(edges) == 4 * 8
    for level in range(4):     # every order crosses each level once
        assert sum(e["orders"] for s, _, e in edges if s.bit_count() == level) == 24
    # Efficiency: the figures of all filters add up to all rows that fail any, per order.
    assert sum(e["removed"] * e["orders"] for *_, e in edges) == 24 * counts[0, 1:].sum()


def test_other_filters_without_copies(spark):
    df = spark.createDataFrame([(1, "aa", "x"), (2, "bb", "x"), (3, None, None)], "id long, body string, k string")
    labels = spark.createDataFrame([(1, True)], "id long, keep boolean")
    got = filter_audit.audit(df, labels, {"p": F.col("text").contains("a"), "q": F.size("words") == 0},
                             F.col("k"), {"lost": F.col("keep")}, "id", "body").collect()
    assert {(r["part"], r["filter_order"], r["step"], r["kept"], r["removed"], r["lost"]) for r in got} == {
        ("x", "pq", 1, 1, 1, 1), ("x", "pq", 2, 1, 0, 0), ("x", "qp", 1, 2, 0, 0), ("x", "qp", 2, 1, 1, 1),
        ("", "pq", 1, 1, 0, 0), ("", "pq", 2, 0, 1, 0), ("", "qp", 1, 0, 1, 0), ("", "qp", 2, 0, 0, 0)}


def test_empty_tables(spark):
    at = stored(spark, "noaudit", documents=empty(spark), labels=spark.createDataFrame([], LABELS))
    assert op11_filter_audit(spark, at).count() == 0
    at = stored(spark, "nolabels", documents=awkward(spark), labels=spark.createDataFrame([], LABELS))
    assert op11_filter_audit(spark, at).agg(F.sum("good_lost")).first()[0] == 0
