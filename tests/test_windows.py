"""Split windows are exact: compare against the plain single-window form."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterline.operators.windows import lag_gap, pick_split, share_of_total, top_k


def _rows(n=600, keys=4, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2023, 1, 1)
    out = []
    for i in range(n):
        k = 0 if rnd.random() < 0.5 else rnd.randrange(1, keys)   # key 0 is hot
        out.append((k, base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 9))))
    out.append((None, base))
    out.append((1, None))
    return out


def _plain_gaps(df):
    w = Window.partitionBy("k").orderBy("t")
    return (df.filter(F.col("k").isNotNull() & F.col("t").isNotNull())
              .withColumn("prev", F.lag("t").over(w)).filter(F.col("prev").isNotNull())
              .select("k", "t", "prev"))


def test_lag_gap_split_matches_plain(spark):
    df = spark.createDataFrame(_rows(), "k int, t timestamp_ntz")
    for split in ("hour", "day", "month"):
        got = lag_gap(df, "k", "t", prev_col="prev", split=split).select("k", "t", "prev")
        assert sorted(got.collect()) == sorted(_plain_gaps(df).collect()), split


def _largest_buckets(rows):
    """Largest (key, bucket) count per unit, by plain Python truncation."""
    import collections

    def trunc(t, unit):
        if unit == "year":
            return t.replace(month=1, day=1, hour=0, minute=0, second=0, microsecond=0)
        if unit == "month":
            return t.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
        if unit == "week":
            d = t.replace(hour=0, minute=0, second=0, microsecond=0)
            return d - dt.timedelta(days=d.weekday())
        if unit == "day":
            return t.replace(hour=0, minute=0, second=0, microsecond=0)
        if unit == "hour":
            return t.replace(minute=0, second=0, microsecond=0)
        return t.replace(second=0, microsecond=0)
    out = {}
    for unit in ("year", "month", "week", "day", "hour", "minute"):
        c = collections.Counter((k, trunc(t, unit)) for k, t in rows
                                if k is not None and t is not None)
        out[unit] = max(c.values())
    return out


def test_pick_split_is_exact(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    largest = _largest_buckets(rows)
    units = ["year", "month", "week", "day", "hour", "minute"]
    for target in (1000, 100, 20, 5, 2, 1):
        want = next((u for u in units if largest[u] <= target), None)
        if want is None:     # finer than a minute: the densest minute's rate
            want = "second" if largest["minute"] / 60 <= target else "millisecond"
        assert pick_split(df, "k", "t", target_rows=target) == want, (target, largest)
    assert pick_split(df, "k", "t", target_rows=1000) == "year"   # no key needs cutting


def test_lag_gap_auto_split_exact(spark, monkeypatch):
    import meterline.operators.windows as W
    df = spark.createDataFrame(_rows(), "k int, t timestamp_ntz")
    monkeypatch.setattr(W, "BUCKET_TARGET_ROWS", 5)
    monkeypatch.setattr(W.pick_split, "__defaults__", (5,))
    got = lag_gap(df, "k", "t", prev_col="prev").select("k", "t", "prev")
    assert sorted(got.collect()) == sorted(_plain_gaps(df).collect())


def test_lag_gap_skips_empty_buckets(spark):
    d = dt.datetime(2023, 1, 1, 10, 0, 45)
    rows = [(1, d), (1, d + dt.timedelta(days=5, seconds=30))]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    r = lag_gap(df, "k", "t", prev_col="prev", split="day").first()
    assert r.prev == d and r.gap_minutes == 5 * 1440 + 1


def test_top_k_with_ties_and_split(spark):
    # gaps 10,9,8,7,6,6,6,1 -> rank<=5 keeps the three 6s (ranks 5,5,5)
    rows = [(1, g, i % 3) for i, g in enumerate([10, 9, 8, 7, 6, 6, 6, 1])]
    rows += [(2, 3, 0), (2, None, 1)]
    df = spark.createDataFrame(rows, "k int, g int, s int")
    order = F.col("g").desc_nulls_first()
    plain = top_k(df, "k", order, 5, "r").select("k", "g", "r")
    split = top_k(df, "k", order, 5, "r", split="s").select("k", "g", "r")
    assert sorted(plain.collect(), key=repr) == sorted(split.collect(), key=repr)
    k1 = sorted(r.g for r in plain.collect() if r.k == 1)
    assert k1 == [6, 6, 6, 7, 8, 9, 10]
    k2 = [(r.g, r.r) for r in plain.orderBy("r").collect() if r.k == 2]
    assert k2 == [(None, 1), (3, 2)]          # NULL sorts first in a descending rank


def test_top_k_split_random(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(3), rnd.randrange(20), rnd.randrange(6)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, g int, s int")
    order = F.col("g").desc()
    a = top_k(df, "k", order, 4, "r").select("k", "g", "s", "r")
    b = top_k(df, "k", order, 4, "r", split="s").select("k", "g", "s", "r")
    assert sorted(a.collect()) == sorted(b.collect())


def test_share_of_total_zero(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "g string, n bigint")
    got = share_of_total(df, "n", "pct", 2).collect()
    assert all(r.pct is None for r in got)
    df2 = spark.createDataFrame([("a", 1), ("b", 2)], "g string, n bigint")
    got2 = {r.g: r.pct for r in share_of_total(df2, "n", "pct", 2).collect()}
    assert got2 == {"a": 33.33, "b": 66.67}


def test_lag_gap_sub_minute_buckets_exact(spark, monkeypatch):
    """A hot key with many rows inside one minute forces second / millisecond
    buckets; the repaired lag still equals the plain window."""
    import meterline.operators.windows as W
    rnd = random.Random(11)
    base = dt.datetime(2023, 5, 1, 12, 0, 0)
    rows = [(0, base + dt.timedelta(microseconds=rnd.randrange(0, 50_000_000)))
            for _ in range(400)]
    rows += [(1, base + dt.timedelta(minutes=i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    assert W.pick_split(df, "k", "t", target_rows=50) == "second"
    assert W.pick_split(df, "k", "t", target_rows=5) == "millisecond"
    for target in (50, 5):
        monkeypatch.setattr(W.pick_split, "__defaults__", (target,))
        got = lag_gap(df, "k", "t", prev_col="prev").select("k", "t", "prev")
        assert sorted(got.collect()) == sorted(_plain_gaps(df).collect()), target
