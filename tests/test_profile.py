"""Profile aggregates against plain Python / numpy."""

import numpy as np
from pyspark.sql import functions as F

from meterline.operators import profile as P


def test_histogram_last_bin_closed(spark):
    vals = [0.0, 0.5, 1.0, 1.5, 2.0, 25.0, -1.0]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    h = {r.bin: r.trips for r in P.histogram(df, "d", 0.0, 20.0, 4).collect()}
    assert h == {0: 1, 1: 1, 2: 1, 3: 2}       # 2.0 (the max) lands in the last bin
    ref, _ = np.histogram([0.0, 0.5, 1.0, 1.5, 2.0], bins=4)
    assert [h.get(i, 0) for i in range(4)] == list(ref)


def test_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(1)
    vals = rnd.normal(10, 3, 501).round(2)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = {r.prob: r.value for r in P.quantiles(df, ["x"], [0.5, 0.9, 0.99]).collect()}
    for p, v in got.items():
        assert abs(v - np.quantile(vals, p)) < 1e-9


def test_null_profile_and_counts(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (3, 1.0, None), (4, 2.0, "a")],
                               "a int, b double, c string")
    got = {r.column_name: (r.null_count, r.null_pct) for r in P.null_profile(df).collect()}
    assert got == {"a": (1, 25.0), "b": (2, 50.0), "c": (1, 25.0)}
    vc = {(r.column_name, r.value): r.trips for r in P.value_counts(df, ["c"]).collect()}
    assert vc == {("c", "a"): 2, ("c", "b"): 1, ("c", None): 1}
    cc = P.conditional_counts(df, {"big": F.col("a") > 2, "none": F.col("a") > 100}).first()
    assert (cc.big, cc.none) == (2, 0)
    empty = P.conditional_counts(df.filter("false"), {"x": F.col("a") > 0}).first()
    assert empty.x == 0


def test_exact_quantiles_refine_with_ties_and_nulls(spark):
    """Brackets refined far below the data size (many rounds), with heavy
    ties, NULLs and an empty column: still exactly numpy's linear quantile."""
    rnd = np.random.default_rng(7)
    x = np.concatenate([rnd.integers(0, 50, 3000).astype(float),       # heavy ties
                        rnd.normal(100, 20, 2000).round(3)])
    rows = [(float(v), None if i % 5 == 0 else float(v) * 2, None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    probs = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    got = {(r.column_name, r.prob): r.value for r in P.quantiles(
        df, ["x", "y", "z"], probs, exact_accuracy=20, max_bracket_rows=40).collect()}
    y = np.array([r[1] for r in rows if r[1] is not None])
    for p in probs:
        assert abs(got[("x", p)] - np.quantile(x, p)) < 1e-9
        assert abs(got[("y", p)] - np.quantile(y, p)) < 1e-9
        assert got[("z", p)] is None


def test_exact_quantiles_read_their_input_once(spark):
    """every pass ran the input's own plan again."""
    runs = spark.sparkContext.accumulator(0)

    def through(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(1000).selectExpr("cast(id as double) x").mapInArrow(through, "x double")
    got = {r.prob: r.value for r in P.quantiles(df, ["x"], [0.5, 0.9], max_bracket_rows=10,
                                                exact_accuracy=100).collect()}
    assert got == {0.5: 499.5, 0.9: 999 * 0.9}
    assert runs.value == 1000
