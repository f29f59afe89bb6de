import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import suffix_tree as st
from meterline.llm.queries import op5_suffix_tree
from tests.conftest import SF001, SF01
from tests.llm.helpers import awkward, empty, stored


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows):
    """Scores by the definition, with plain counters."""
    docs = [(i, tokens(t), held(i)) for i, t in rows]
    c = Counter(w for _, ts, h in docs if not h for w in ts)
    n, v = sum(c.values()), len(c)
    min_context, min_symbol = max(64, math.ceil(st.SHARE * n)), max(8, math.ceil(st.SHARE / 10 * n))
    size = n + v + 1.0
    rare = sum(k + 1 for w, k in c.items() if k < min_symbol and w != b"") + 1.0
    if 0 < c[b""] < min_symbol:
        pass   # the end mark is always a symbol of its own

    def symbol(w):
        return w if w == b"" or c[w] >= min_symbol else None

    def p0(x):
        return rare / size if x is None else (c[x] + 1) / size

    one, two = Counter(), Counter()
    for _, ts, h in docs:
        if not h:
            before, last = None, b""
            for w in ts:
                x = symbol(w)
                one[last, x] += 1
                if before is not None:
                    two[before, last, x] += 1
                before, last = ((last,) if last is not None else (None,)), x
    total1 = Counter()
    for (u, _), k in one.items():
        total1[u] += k
    ok1 = {u for u in total1 if u is not None and c[u] >= min_context}

    def kept(counts, parent, prior):
        gain, tot = Counter(), Counter()
        for (*u, x), k in counts.items():
            gain[tuple(u)] += k * math.log((k - 1) / parent(u, x) + prior)
            tot[tuple(u)] += k
        return {u for u in gain if tot[u] > 1 and gain[u] - tot[u] * math.log(tot[u] - 1 + prior) > st.TEST}

    keep1 = {u[0] for u in kept({k: m for k, m in one.items() if k[0] in ok1}, lambda u, x: p0(x), st.PRIOR[1])}

    def p1(u, x):
        if u not in keep1:
            return p0(x)
        return (one[u, x] + st.PRIOR[1] * p0(x)) / (c[u] + st.PRIOR[1])

    wide = {(b[0], u): one[b[0], u] for (b, u, _) in two if b[0] in ok1 and u is not None
            and u in ok1 and one[b[0], u] >= min_context}
    keep2 = kept({(b[0], u, x): k for (b, u, x), k in two.items() if (b[0], u) in wide},
                 lambda u, x: p1(u[1], x), st.PRIOR[2])
    out = []
    for i, ts, h in docs:
        base = score = 0.0
        before, last = None, b""
        for w in ts:
            x = symbol(w)
            base += math.log10((c[w] + 1) / size)
            p = p1(last, x) if last is not None else p0(x)
            if before is not None and (before[0], last) in keep2:
                k = two[before, last, x]
                p = (k + st.PRIOR[2] * p) / (wide[before[0], last] + st.PRIOR[2])
            score += math.log10(p)
            if x is None:
                score += math.log10((c[w] + 1) / size / p0(None))
            before, last = (last,), x
        out.append((i, h, len(ts), sum(c[w] > 0 for w in ts), n, base, score))
    return out


def compare(got, want):
    got, want = (sorted(x, key=lambda r: (repr(r[0]), r[2], round(r[5], 6))) for x in (got, want))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-6)


def test_query_equals_plain_counters(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    compare([tuple(r) for r in op5_suffix_tree(spark, SF001).collect()], brute(rows))


def test_awkward_rows_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(st, "BLOCK", 500)
    monkeypatch.setattr(st, "ENTRIES", 300)
    at = stored(spark, "pst", documents=awkward(spark).unionByName(awkward(spark)))
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    got = [tuple(r) for r in op5_suffix_tree(spark, at).collect()]
    compare(got, brute(rows))


def test_contexts_help_held_out_documents(spark):
    out = [r for r in op5_suffix_tree(spark, SF01).collect() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_no_training_rows_and_empty_table(spark):
    docs = awkward(spark)
    none = st.score_documents(docs, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in none)
    assert st.score_documents(empty(spark), F.lit(False)).count() == 0


def test_a_states_distribution_sums_to_one():
    rnd = np.random.default_rng(2)
    base = rnd.dirichlet(np.ones(50))
    n = rnd.integers(0, 5, 50).astype(float)
    p = np.exp(st.log_state(n, np.full(50, n.sum()), 60.0, np.log(base)))
    assert p.sum() == pytest.approx(1.0)


def test_keys_tell_order_apart():
    a, b = np.arange(1000, dtype="u8"), np.arange(1000, dtype="u8")[::-1].copy()
    k = st.mix(a, b)
    assert len(set(k.tolist()) | set(st.mix(b, a).tolist())) == 1000 and len(set(k.tolist())) == 1000


def test_floors_do_not_follow_the_corpus(spark):
    """66 occurrences in seven million tokens are a context of their own."""
    filler = spark.range(70).select("id", F.expr("repeat('x ', 100000)").alias("text"))
    rare = spark.range(100, 166).select("id", F.lit("a b").alias("text"))
    docs = filler.unionByName(rare).withColumnRenamed("id", "doc_id")
    out = st.score_documents(docs, F.lit(False)).filter("doc_id >= 100").collect()
    assert len(out) == 66 and out[0]["train_tokens"] > 7_000_000
    assert all(r["score"] > r["base_score"] + 10 for r in out)


def test_a_keys_bucket_is_the_range_it_is_dealt_to(spark):
    keys = np.sort(np.random.default_rng(5).integers(0, 1 << 64, 500, "u8"))
    for buckets in (1, 8, 1003):
        dealt = st.dealt(0, keys, None, None, None, buckets)
        want = {int(k): b for b, packed in zip(dealt["bucket"].to_pylist(), dealt["keys"].to_pylist())
                for k in st.unpack_keys(packed).view("<i8")}
        rows = spark.createDataFrame([(k,) for k in want], "key long")
        got = rows.select("key", st.bucket_of(F.col("key"), buckets).alias("b")).collect()
        assert {r["key"]: r["b"] for r in got} == want


def test_tokens_of_texts_are_the_definitions():
    texts = [bytes(range(1, 128)).decode(), "", "  ", " a ", "\x0bA\x0c\x1c b\x1f\r\n", "\u00c9\x85x\xa0y\u3000Z",
             None, "a  b\t\tc", "\x00 \x00a"]
    got, counts = st.tokens_of(texts)
    want = [tokens(t) for t in texts]
    assert [w.encode() for w in got.to_pylist()] == [w for ws in want for w in ws]
    assert counts.tolist() == [len(ws) for ws in want]


def test_blocks_end_after_the_text_that_fills_them(spark, monkeypatch):
    monkeypatch.setattr(st, "BLOCK", 10)
    docs = spark.range(0, 9, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id as int))").alias("text"))
    out = st.blocks_of(docs, F.lit(False), "doc_id", "text").collect()
    assert sorted((r["doc_ids"], r["n_tokens"]) for r in out) == [
        ([0, 1, 2, 3], 10), ([4, 5], 11), ([6, 7], 15), ([8], 9)]


def test_a_range_of_triples_is_a_slice_of_the_blocks():
    for k in (1, 3, 1001):
        assert st.bounds(k * len(st.SLICES))[::k].tolist() == st.bounds(len(st.SLICES)).tolist()
