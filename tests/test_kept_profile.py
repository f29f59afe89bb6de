"""The kept profile against the full scan of the same files."""

import math

import numpy as np
import pytest

from meterline.operators import kept_profile as K
from meterline.operators import profile as P

SPEC = K.Spec(columns=("d", "fare", "note"), numeric=("d", "fare"),
              parts={"all": (None, ("d",)), "paid": ("fare > 0", ("d", "fare"))})
PROBS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


def month_rows(seed, n):
    rnd = np.random.default_rng(seed)
    d = rnd.lognormal(1, 2, n).round(6)
    d[::7] = d[::7].round(0)
    fare = rnd.normal(20, 15, n)
    return [(None if i % 11 == 0 else float(a), float(b), None if i % 5 else "x")
            for i, (a, b) in enumerate(zip(d, fare))]


def read(spark, paths):
    from pyspark.sql import functions as F
    from meterline.sources.files import file_name_of
    schema = "d double, fare double, note string"
    if not paths:
        return spark.createDataFrame([], schema + ", source_file string")
    return spark.read.schema(schema).parquet(*paths).withColumn(
        "source_file", file_name_of(F.col("_metadata.file_path")))


def put(spark, base, month, rows):
    path = f"{base}/landing/trips_{month}.parquet"
    spark.createDataFrame(rows, "d double, fare double, note string").coalesce(2) \
         .write.mode("overwrite").parquet(path)
    return path


def plain(df):
    return sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()),
                  key=repr)


RANGES = ((0.0, 20.0, 40), (1.2345, 7.77777, 7), (-5.0, -1.0, 3), (2.0, 2.0, 4))


def assert_same(spark, kept, paths, max_rows=P.EXACT_BRACKET_MAX_ROWS, ranges=RANGES[1:2]):
    df = read(spark, paths)
    assert plain(K.null_profile(spark, kept)) == plain(P.null_profile(df.drop("source_file")))
    assert plain(K.numeric_summary(spark, kept)) == plain(P.numeric_summary(df, ["d", "fare"]))
    assert plain(K.quantiles(spark, kept, "paid", PROBS, accuracy=100, max_bracket_rows=max_rows)) == plain(
        P.quantiles(df.filter("fare > 0"), ["d", "fare"], PROBS))
    for lo, hi, bins in ranges:
        assert plain(K.histogram(spark, kept, "all", "d", lo, hi, bins)) == plain(P.histogram(df, "d", lo, hi, bins))


def test_new_changed_and_removed_files(spark, tmp_table_dir):
    seen = []

    def spied(s, paths):
        seen.append(sorted(p.rsplit("_", 1)[-1] for p in paths))
        return read(s, paths)

    kept = K.Kept(f"{tmp_table_dir}/profile", SPEC, spied)
    paths = [put(spark, tmp_table_dir, f"2023-0{i}", month_rows(i, 400)) for i in (1, 2)]
    K.refresh(spark, kept, paths)
    assert_same(spark, kept, paths)
    paths.append(put(spark, tmp_table_dir, "2023-03", month_rows(3, 2000)))
    seen.clear()
    assert K.refresh(spark, kept, paths) == paths[2:]
    assert seen == [["2023-03.parquet"]]
    assert_same(spark, kept, paths, max_rows=3, ranges=RANGES)
    put(spark, tmp_table_dir, "2023-01", month_rows(9, 300))
    assert K.refresh(spark, kept, paths) == paths[:1]
    assert_same(spark, kept, paths)
    assert K.refresh(spark, kept, paths) == []
    K.refresh(spark, kept, paths[1:])
    assert_same(spark, kept, paths[1:])
    put(spark, tmp_table_dir, "2023-02", [])
    K.refresh(spark, kept, paths[1:])
    assert_same(spark, kept, paths[1:])


def test_awkward_values(spark, tmp_table_dir):
    odd = [0.0, -0.0, 5e-324, 1e-300, 1e300, -1e300, 9.999999999, 10.0, 1000.0, 999.9999999999999,
           float("inf"), float("-inf"), float("nan"), float("nan"), None, -3.25, 2.0, 2.0, 2.0]
    kept = K.Kept(f"{tmp_table_dir}/profile", SPEC, read)
    paths = [put(spark, tmp_table_dir, "2023-01", [(v, 1.0, None) for v in odd]),
             put(spark, tmp_table_dir, "2023-02", [(v, v, "y") for v in odd[:10]])]
    K.refresh(spark, kept, paths)
    assert plain(K.numeric_summary(spark, kept)) == plain(P.numeric_summary(read(spark, paths), ["d", "fare"]))
    finite = K.Kept(f"{tmp_table_dir}/finite", SPEC, read)
    K.refresh(spark, finite, paths[1:])
    assert_same(spark, finite, paths[1:], ranges=RANGES)
    got = {r.prob: r.value for r in K.quantiles(spark, kept, "paid", [0.0, 1.0]).collect() if r.column_name == "d"}
    assert got[0.0] == float("-inf") and math.isnan(got[1.0])


def test_a_lost_run_shows_nothing_and_is_repaired(spark, tmp_table_dir, monkeypatch):
    kept = K.Kept(f"{tmp_table_dir}/profile", SPEC, read)
    paths = [put(spark, tmp_table_dir, "2023-01", month_rows(1, 100))]
    K.refresh(spark, kept, paths)
    paths.append(put(spark, tmp_table_dir, "2023-02", month_rows(2, 100)))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(K, "write_record", lost)
        with pytest.raises(RuntimeError):
            K.refresh(spark, kept, paths)
    assert_same(spark, kept, paths[:1])
    assert K.refresh(spark, kept, paths) == paths[1:]
    assert_same(spark, kept, paths)


def test_no_files_and_another_spec(spark, tmp_table_dir):
    kept = K.Kept(f"{tmp_table_dir}/profile", SPEC, read)
    K.refresh(spark, kept, [])
    assert_same(spark, kept, [])
    path = put(spark, tmp_table_dir, "2023-01", month_rows(1, 50))
    K.refresh(spark, kept, [path])
    other = K.Kept(kept.path, K.Spec(("d",), ("d", "fare"), SPEC.parts), read)
    assert K.refresh(spark, other, [path]) == [path]
    assert {r.column_name for r in K.null_profile(spark, other).collect()} == {"d"}
