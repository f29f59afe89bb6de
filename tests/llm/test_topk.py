import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import topk
from meterline.llm.queries import op12_exact_topk
from tests.conftest import SF001
from tests.llm.helpers import stored
from tests.oracle_harness import compare, duck

SCHEMA = "vec_id long, embedding array<double>, label int, id long, dim int, shard long, part int, best long"


def brute(rows, k=10):
    best = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            best[i] = min(best.get(i, v), v)
    whole = {i: [int(x) * 1024 if abs(x) > 2 ** 52 else math.floor(1024 * x) for x in v] for i, v in best.items()}
    out = {}
    for q, v in whole.items():
        if q % 100 == 0:
            near = []
            for i, o in whole.items():
                if i != q and len(o) == len(v):
                    s = max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(o, v))))
                    near.append((-s, i))
            if near:
                out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_query_against_its_sql(spark):
    r = compare(spark, "op12_exact_topk", SF001, duck(SF001))
    assert r["status"] == "ok" and not r.get("types"), r


def awkward_vectors():
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(350)]
    rows += [(1000 + i, [0.25] * 8) for i in range(150)]                     # one vector many times
    rows += [(2001, None), (2002, []), (2100, []), (2003, [None] + [1.0] * 7), (2004, [math.nan] * 8),
             (2005, [math.inf] + [0.0] * 7), (None, [1.0] * 8), (2200, [0.0] * 8), (2300, [1.0, 2.0]),
             (2301, [2.0, 1.0]), (100, rows[100][1]), (200, [9.0] * 8), (2400, [5.0] * 3),
             (2500, [1e6, -1e6, 3.5]), (2501, [1e300, 2.0, -0.1]), (2502, [-1e300, 1e-5, 0.0]),
             (2600, [3e9, 1.0, -1.0, 2.0]), (2601, [2e9, 1.0, -1.0, 2.0]), (2602, [3e5, 1.0, -1.0, 2.0])]
    return rows


@pytest.mark.parametrize("tile, shard, spread, group, fan, lines", [(8192, 262_144, 64, 65_536, 16, 512),
                                                                   (16, 40, 64, 3, 2, 2)])
def test_awkward_vectors_however_tiled(spark, monkeypatch, tile, shard, spread, group, fan, lines):
    for name, v in dict(TILE=tile, SHARD=shard, SPREAD=spread, GROUP=group, FAN=fan, LINES=lines).items():
        monkeypatch.setattr(topk, name, v)
    rows = awkward_vectors()
    at = stored(spark, "topk", embeddings=spark.createDataFrame([(*r, 1, 1, 1, 1, 1, 1) for r in rows], SCHEMA))
    got, want = found(op12_exact_topk(spark, at)), brute(rows)
    assert got == want
    assert [i for i, _ in got[1000]][:3] != [1000] and len(got[2300]) == 1 and len(got[2100]) == 1


def test_products_stay_exact_at_every_size():
    rnd = np.random.default_rng(1)
    for top in (1000, 10 ** 7, 10 ** 9, 10 ** 12):
        q, x = (rnd.integers(-top, top, (5, 7)).astype("f8") for _ in "qx")
        got = topk.products(q, x)
        want = [[max(-2 ** 63, min(2 ** 63 - 1, sum(int(a) * int(b) for a, b in zip(u, v)))) for v in x] for u in q]
        assert got.tolist() == want


def test_columns_of_the_best():
    rnd = np.random.default_rng(2)
    for scale in (1, 2 ** 51):
        s = rnd.integers(-3, 3, (20, 30)) * scale
        out = np.array([np.arange(20), np.arange(20)])
        got = topk.best_columns(s, out, 6)
        for line, cols in enumerate(got):
            want = sorted((c for c in range(30) if c != line), key=lambda c: (-s[line, c], c))[:6]
            assert cols.tolist() == want


def test_empty_table_and_no_queries(spark):
    none = stored(spark, "notopk", embeddings=spark.createDataFrame([], SCHEMA))
    assert op12_exact_topk(spark, none).count() == 0
    one = spark.createDataFrame([(7, [1.0]), (8, [2.0])], "vec_id long, embedding array<double>")
    assert topk.search(one, F.col("id") % 100 == 0).count() == 0
