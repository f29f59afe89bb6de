import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import neighbours
from meterline.llm.queries import op2_neighbours
from tests.conftest import SF001
from tests.llm.helpers import stored

SCHEMA = "vec_id long, embedding array<float>, label int, id long, dim int, block long"


def brute(rows, k=20):
    """rows: (id, vector); exact lists of every id that 20 divides."""
    best = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        best[i] = min(best.get(i, v), v)
    out = {}
    for q, v in best.items():
        if q % 20 == 0:
            got = sorted((-float((np.float64(o) * np.float64(v)).sum()), i) for i, o in best.items()
                         if i != q and len(o) == len(v))
            out[q] = [(i, -s) for s, i in got[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(map(len, want.values()))


def test_query_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got, want = found(op2_neighbours(spark, SF001)), brute(rows)
    assert set(got) == set(want) and recall(got, want) >= 0.99
    for q, w in want.items():
        exact = dict(w)
        assert all(s == pytest.approx(exact[i], abs=1e-15) for i, s in got[q] if i in exact)


def test_awkward_vectors(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=16).astype("f4").tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 16) for i in range(100)]                      # one vector many times
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [None] + [1.0] * 15),
             (1004, [float("nan")] * 16), (1005, [float("inf")] + [0.0] * 15), (None, [1.0] * 16),
             (2000, [1.0, 2.0]), (2001, [2.0, 1.0]), (40, rows[40][1]), (20, [9.0] * 16), (4000, [1.0] * 5)]
    at = stored(spark, "vectors", embeddings=spark.createDataFrame([(*r, 1, 1, 1, 1) for r in rows], SCHEMA))
    got, want = found(op2_neighbours(spark, at)), brute(rows)
    want = {q: w for q, w in want.items() if w}
    assert set(got) == set(want) and recall(got, want) >= 0.95
    assert [i for i, _ in got[2000]] == [2001]
    # Equal vectors tie: the smaller ids first.
    ties = [i for i, _ in got[320] if i >= 300]
    assert ties == sorted(ties)


def test_estimates_stay_within_their_bounds():
    rnd = np.random.default_rng(6)
    x, q = rnd.normal(size=(2000, 64)), rnd.normal(size=(50, 64))
    centre, turn = x.mean(0), neighbours.rotation(64, 7)
    assert np.allclose(turn @ turn.T, np.eye(64))
    codes, r, f = neighbours.encode(x, centre, turn)
    assert codes.shape == (2000, 8)
    guess, bound = neighbours.estimate(codes, r, f, centre, turn, q)
    error = np.abs(guess - q @ x.T)
    assert (error <= bound).mean() > 0.985 and error.mean() < 0.5 * bound.mean()
    assert abs((guess - q @ x.T).mean()) < 0.05


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    whole = found(neighbours.search(df, F.col("id") % 20 == 0))
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    parts = found(neighbours.search(df, F.col("id") % 20 == 0))
    same = sum(a == b for q in whole for a, b in zip(whole[q], parts[q]))
    assert same / sum(map(len, whole.values())) > 0.98


def test_empty_table(spark):
    at = stored(spark, "novectors", embeddings=spark.createDataFrame([], SCHEMA))
    assert op2_neighbours(spark, at).count() == 0


def test_operators_built_before_either_runs_keep_the_session_setting(spark):
    from meterline.llm.queries import op3_quality, op5_suffix_tree
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "777")
    near, tree = op2_neighbours(spark, SF001), op5_suffix_tree(spark, SF001)
    assert spark.conf.get(key) == "777"
    quality = op3_quality(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert near.count() == 25 * 20 and tree.count() == quality.count() == docs
