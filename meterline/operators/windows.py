"""Window operators (W1-W6) written to survive one very hot key.

A zone can hold a third of all trips, so a window partitioned by zone alone
would sort that third in a single task. Both window operators here split each
key's rows by a second, data-derived column (a time bucket for ``lag_gap``,
any split column for ``top_k``) and repair the cut exactly:

* ``lag_gap``: the first row of each (key, bucket) takes the last time of the
  previous non-empty bucket of that key, found from a per-(key, bucket) max
  (partial aggregation, one row per bucket) and a ``lag`` over those rows.
* ``top_k``: rank <= k inside (key, split) first; a row's rank inside its
  split is never above its rank inside the whole key, so the second,
  per-key rank only sees the survivors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.exprs import minutes_between


# date_trunc units a bucket can take, coarsest first, with their length in
# seconds (an upper bound for month and year).
SPLIT_UNITS = [("year", 366 * 86400.0), ("month", 31 * 86400.0), ("week", 7 * 86400.0),
               ("day", 86400.0), ("hour", 3600.0), ("minute", 60.0), ("second", 1.0),
               ("millisecond", 0.001)]

# Rows one (key, bucket) window task should hold at most, on average.
BUCKET_TARGET_ROWS = 1_000_000


def _largest(counts: DataFrame, unit: str) -> int | None:
    """Most rows of any (key, ``unit`` bucket), from counts per (key, bucket)."""
    return (counts.groupBy("k", F.date_trunc(unit, F.col("b")).alias("u")).agg(F.sum("n").alias("n"))
                  .agg(F.max("n").alias("n")).first()["n"])


def _counts(df: DataFrame, key: str, ts: str, unit: str) -> DataFrame:
    return (df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
              .groupBy(F.col(key).alias("k"), F.date_trunc(unit, F.col(ts)).alias("b"))
              .agg(F.count(F.lit(1)).alias("n")))


def pick_split(df: DataFrame, key: str, ts: str,
               target_rows: int = BUCKET_TARGET_ROWS) -> str:
    """The coarsest time unit whose largest (key, bucket) holds at most
    ``target_rows`` rows: exact down to the minute; below a minute the densest
    minute's rate decides. The unit never changes results, only how the work
    is cut.

    One scan counts rows per (key, hour), at most one row per key and active
    hour, staged; coarser units sum those few rows, coarsest first, until one
    fits. Only if no hour fits are the hours above the target counted again by
    minute.
    """
    from meterline.operators.incremental import stage
    hours, _, _ = stage(df.sparkSession, _counts(df, key, ts, "hour"), "hours")
    for unit, length in SPLIT_UNITS:
        if length < 3600.0:
            break
        largest = _largest(hours, unit)
        if largest is None or largest <= target_rows:
            return unit
    full = hours.filter(F.col("n") > target_rows).select(
        F.col("k").alias("__k"), F.col("b").alias("__b"))
    dense = (df.withColumn("__h", F.date_trunc("hour", F.col(ts)))
               .join(full, (F.col(key) == F.col("__k")) & (F.col("__h") == F.col("__b")), "left_semi"))
    minute = _largest(_counts(dense, key, ts, "minute"), "minute")
    for unit, length in SPLIT_UNITS:
        if length < 3600.0 and minute * length / 60.0 <= target_rows:
            return unit
    return SPLIT_UNITS[-1][0]


def lag_gap(df: DataFrame, key: str, ts: str, prev_col: str = "prev_ts",
            gap_col: str = "gap_minutes", split: str = "auto",
            mode: str = "boundary", keep: Sequence[str] = ()) -> DataFrame:
    """Previous ``ts`` of the same ``key`` and the gap to it, per row.

    Rows without a previous row (the key's first) are dropped, as are rows
    whose key or time is NULL. ``split`` is the date_trunc unit of the bucket
    that bounds one window task ('hour', 'day', 'month', ...), or 'auto' to
    size it from the data (``pick_split``).
    """
    base = (df.select(key, ts, *keep)
              .filter(F.col(key).isNotNull() & F.col(ts).isNotNull()))
    if split == "auto":
        # Sizing, rows and carry each read these columns: the input's own plan
        # runs once.
        from meterline.operators.incremental import stage
        base, _, _ = stage(df.sparkSession, base, "lag")
        split = pick_split(base, key, ts)
    base = base.withColumn("__bucket", F.date_trunc(split, F.col(ts)))
    w_local = Window.partitionBy(key, "__bucket").orderBy(F.col(ts).asc())
    local = base.withColumn("__prev_local", F.lag(ts).over(w_local))

    # Last time of the previous non-empty bucket of the same key. Catalyst
    # prunes the window away from this branch, so it is a second scan of the
    # two columns, collapsed map-side to one row per (key, bucket); the lag
    # then runs over those few rows per key, and the join back is broadcast
    # by AQE when the measured carry table is small; otherwise only the carry
    # table is shuffled (the rows keep their (key, bucket) partitioning).
    per_bucket = local.groupBy(key, "__bucket").agg(F.max(ts).alias("__bucket_max"))
    w_b = Window.partitionBy(key).orderBy(F.col("__bucket").asc())
    carry = per_bucket.select(key, "__bucket",
                              F.lag("__bucket_max").over(w_b).alias("__carry"))

    out = (local.join(carry, [key, "__bucket"], "left")
                .withColumn(prev_col, F.coalesce("__prev_local", "__carry"))
                .filter(F.col(prev_col).isNotNull())
                .withColumn(gap_col, minutes_between(prev_col, ts, mode)))
    return out.drop("__prev_local", "__carry")


def top_k(df: DataFrame, key: Sequence[str] | str, order: Column, k: int,
          rank_col: str = "rank", split: Sequence[str] | str = ()) -> DataFrame:
    """Rows with ``rank() <= k`` per key under ``order`` (W2/W4; ties kept).

    ``split`` names extra columns that cut each key into pieces for a first,
    local top-k (see module doc). Without it this is a single ranked window,
    which Catalyst plans with a WindowGroupLimit before the shuffle sort.
    """
    key = [key] if isinstance(key, str) else list(key)
    split = [split] if isinstance(split, str) else list(split)
    cur = df
    if split:
        w1 = Window.partitionBy(*key, *split).orderBy(order)
        cur = cur.withColumn("__r1", F.rank().over(w1)).filter(F.col("__r1") <= k).drop("__r1")
    w = Window.partitionBy(*key).orderBy(order)
    return cur.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= k)


def share_of_total(agg: DataFrame, count_col: str, out_col: str,
                   digits: int | None = 2) -> DataFrame:
    """Percent of the grand total per row of an already-aggregated table.

    Only for small aggregates: the grand total is a window over all rows,
    which Spark evaluates in one partition.
    """
    from meterline.functions.exprs import pct, round_half_away
    total = F.sum(count_col).over(Window.partitionBy())
    v = pct(F.col(count_col), total)
    return agg.withColumn(out_col, round_half_away(v, digits) if digits is not None else v)
