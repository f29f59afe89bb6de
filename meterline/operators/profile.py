"""Profiling aggregates.

Each is a single aggregation pass (partial + final hash aggregate) returning a
small DataFrame; wide one-row results are turned into rows with ``unpivot``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.exprs import exact_avg, pct, round_half_away


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: how many rows meet each named condition.

    ``count_if`` gives 0 on empty input and counts a NULL condition as not met.
    """
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n)
                    for n, c in conditions.items()])


def null_profile(df: DataFrame, digits: int = 3) -> DataFrame:
    """Null count and percent for every column with at least one NULL (A10).

    One pass: a ``count_if(isnull)`` per column of the schema plus the row
    count, then unpivoted to (column_name, null_count, null_pct).
    """
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot(["__n"], cols, "column_name", "null_count")
    return (long.filter(F.col("null_count") > 0)
                .select("column_name", F.col("null_count").cast("bigint").alias("null_count"),
                        round_half_away(pct("null_count", "__n"), digits).alias("null_pct")))


def numeric_summary(df: DataFrame, cols: Sequence[str], avg_digits: int = 2) -> DataFrame:
    """min / max / rounded mean per numeric column as rows (A8 + A12):
    (column_name, avg, min, max)."""
    aggs = []
    for c in cols:
        aggs += [exact_avg(F.col(c).cast("double")).alias(f"{c}__avg"),
                 F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 round_half_away(F.col(f"{c}__avg"), avg_digits).alias("avg_value"),
                 F.col(f"{c}__min").alias("min_value"),
                 F.col(f"{c}__max").alias("max_value"))
        for c in cols])).alias("s"))
    return stacked.select("s.*")


# Most rows the final, exact ranking step sorts in one task per bracket.
EXACT_BRACKET_MAX_ROWS = 100_000


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              accuracy: int | None = None, exact_accuracy: int = 10_000,
              max_bracket_rows: int = EXACT_BRACKET_MAX_ROWS) -> DataFrame:
    """Interpolated quantiles per column as (column_name, prob, value).

    ``accuracy`` given: the bounded-memory ``percentile_approx`` sketch.
    Otherwise exact (SQL ``quantile_cont``: the value at fractional rank
    h = (n - 1) * p, interpolated as lo + (hi - lo) * (h - floor(h))), and no
    task ever sorts more than ``max_bracket_rows`` values:

    * each needed rank (floor(h), ceil(h)) owns a value interval that is known
      to contain it, with the exact count of rows below and inside it;
    * while an interval holds more than ``max_bracket_rows`` rows, one pass
      sketches the rows inside it (``percentile_approx``, rank error at most
      1 / ``exact_accuracy`` of them) around the rank, and a second pass
      counts (partial aggregates only) the rows below the sketch's bracket,
      inside it and on its two ends; a rank on an end is resolved at once,
      otherwise its interval becomes the open gap between the ends or the
      side the counts show it is on. Each round shrinks the interval by a
      factor of about ``exact_accuracy`` / 6 (10^12 rows need two rounds) and
      the result never depends on the sketch being right;
    * finally the distinct values of each small interval are counted,
      shuffled by interval and ranked by a running sum.
    The first pass also counts each column, so data below the bound costs two
    passes in all. All passes read the staged columns, not ``df``'s own plan.
    """
    probs = [float(p) for p in probs]
    if accuracy:
        arr = F.array(*[F.lit(p) for p in probs])
        wide = df.agg(*[F.percentile_approx(F.col(c).cast("double"), arr, accuracy).alias(c)
                        for c in cols])
        rows = wide.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("q")) for c in cols
        ])).alias("s"))
        return (rows.select("s.column_name", F.posexplode("s.q").alias("i", "value"))
                    .select("column_name",
                            F.element_at(arr, F.col("i") + 1).alias("prob"),
                            F.col("value").cast("double").alias("value")))
    return _exact_quantiles(df, list(cols), probs, exact_accuracy, max_bracket_rows)


class _Rank:
    """One wanted rank of one column and the value interval known to hold it.

    Bounds are (value, open) pairs or None for unbounded; ``below`` counts
    the column's values under the interval, ``size`` the values inside it.
    ``q`` is the quantile the rank serves: the two ranks of one quantile move
    together while they share an interval.
    """

    def __init__(self, col: str, rank: int, size: int, q: int):
        self.col, self.rank, self.size, self.below, self.q = col, rank, size, 0, q
        self.lo = self.hi = None
        self.value = None          # set when the rank is known to sit on a tie
        self.stuck = False

    def inside(self, v: Column) -> Column:
        pred = v.isNotNull()
        if self.lo is not None:
            pred = pred & ((v > F.lit(self.lo[0])) if self.lo[1] else (v >= F.lit(self.lo[0])))
        if self.hi is not None:
            pred = pred & ((v < F.lit(self.hi[0])) if self.hi[1] else (v <= F.lit(self.hi[0])))
        return pred

    def interval(self) -> tuple:
        return (self.col, self.lo, self.hi)


def _exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     accuracy: int, max_rows: int) -> DataFrame:
    import math
    from meterline.operators.incremental import stage
    spark = df.sparkSession
    eps = 3.0 / accuracy
    # Several passes read these columns: the input's own plan runs once.
    df, _, _ = stage(spark, df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]),
                     "quantiles")
    vals = {c: F.col(f"v{i}") for i, c in enumerate(cols)}

    def around(lo: float, hi: float) -> Column:
        return F.array(F.lit(max(0.0, lo - eps)), F.lit(min(1.0, hi + eps)))

    first = df.agg(*[F.count(vals[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                   *[F.percentile_approx(vals[c], F.flatten(F.array(*[
                       around(p, p) for p in probs])), accuracy).alias(f"q{i}")
                     for i, c in enumerate(cols)]).first()
    ranks: dict[tuple, _Rank] = {}
    plan = []                                  # (column, prob, rank lo, rank hi, d)
    brackets: dict[tuple, tuple] = {}          # (interval, quantile) -> sketch bracket
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        sk = first[f"q{i}"] or []
        for j, p in enumerate(probs):
            if n == 0:
                plan.append((c, p, None, None, None))
                continue
            h = (n - 1) * p
            lo, hi = math.floor(h), math.ceil(h)
            plan.append((c, p, lo, hi, h - lo))
            for r in (lo, hi):
                if (c, r) not in ranks:
                    ranks[(c, r)] = _Rank(c, r, n, (i, j))
            if len(sk) == 2 * len(probs):
                brackets[((c, None, None), (i, j))] = (sk[2 * j], sk[2 * j + 1])
    found = values_at_ranks(df, list(ranks.values()), vals, accuracy, max_rows, brackets)
    return spark.createDataFrame([(c, p, interpolated(found, c, lo, hi, d)) for c, p, lo, hi, d in plan],
                                 "column_name string, prob double, value double")


def interpolated(found: dict, col: str, lo: int | None, hi: int | None, d: float | None) -> float | None:
    """Value a share ``d`` of the way between the values at two ranks."""
    if lo is None:
        return None
    x_lo, x_hi = found[(col, lo)], found[(col, hi)]
    return x_lo if x_lo == x_hi else x_lo + (x_hi - x_lo) * d


def values_at_ranks(df: DataFrame, ranks: list[_Rank], vals: dict[str, Column], accuracy: int,
                    max_rows: int, brackets: dict[tuple, tuple]) -> dict[tuple, float]:
    """(column, rank) -> value: intervals are narrowed until they are small (see
    ``quantiles``), then ranked. ``brackets`` may hold first sketch brackets."""
    eps = 3.0 / accuracy

    def around(lo: float, hi: float) -> Column:
        return F.array(F.lit(max(0.0, lo - eps)), F.lit(min(1.0, hi + eps)))

    while True:
        groups: dict[tuple, list[_Rank]] = {}
        for t in ranks:
            if t.value is None and t.size > max_rows and not t.stuck:
                groups.setdefault((t.interval(), t.q), []).append(t)
        if not groups:
            break
        todo = list(groups.items())
        need = [(k, g) for k, (key, g) in enumerate(todo) if key not in brackets]
        if need:
            # Sketch the rows inside each interval around its ranks' place there.
            row = df.agg(*[F.percentile_approx(
                F.when(g[0].inside(vals[g[0].col]), vals[g[0].col]),
                around(min(t.rank - t.below for t in g) / max(1, g[0].size - 1),
                       max(t.rank - t.below for t in g) / max(1, g[0].size - 1)),
                accuracy).alias(f"s{k}") for k, g in need]).first()
            for k, g in need:
                brackets[todo[k][0]] = tuple(row[f"s{k}"])
        # Count, exactly, the interval's rows below the sketch bracket, inside
        # it, and on each of its two ends.
        aggs = []
        for k, (key, g) in enumerate(todo):
            v, (qa, qb) = vals[g[0].col], brackets[key]
            inside = g[0].inside(v)
            aggs += [F.count_if(inside & (v < F.lit(qa))).alias(f"lt{k}"),
                     F.count_if(inside & v.between(qa, qb)).alias(f"in{k}"),
                     F.count_if(inside & (v == F.lit(qa))).alias(f"ea{k}"),
                     F.count_if(inside & (v == F.lit(qb))).alias(f"eb{k}")]
        row = df.agg(*aggs).first()
        for k, (key, g) in enumerate(todo):
            qa, qb = brackets.pop(key)
            lt, inside, ea, eb = (row[f"{x}{k}"] for x in ("lt", "in", "ea", "eb"))
            for t in g:
                size, at = t.size, t.rank - t.below
                if at < lt:                                 # left of the bracket
                    t.hi, t.size = (qa, True), lt
                elif at < lt + ea:                          # on its lower end
                    t.value, t.size = qa, 0
                elif at >= lt + inside:                     # right of it
                    t.lo, t.below = (qb, True), t.below + lt + inside
                    t.size = size - lt - inside
                elif at >= lt + inside - eb:                # on its upper end
                    t.value, t.size = qb, 0
                else:                                       # strictly between the ends
                    t.lo, t.hi = (qa, True), (qb, True)
                    t.below, t.size = t.below + lt + ea, inside - ea - eb
                t.stuck = t.size >= size  # no progress (not expected): rank it as is

    found = {(t.col, t.rank): t.value for t in ranks if t.value is not None}
    found.update(_resolve(df, [t for t in ranks if t.value is None], vals))
    return found


def _resolve(df: DataFrame, ranks: list, vals: dict) -> dict:
    """Value at each rank: the distinct values of each (small) interval with
    their counts, ranked per interval by a running sum; ranks sharing an
    interval share the work."""
    from pyspark.sql import Window
    if not ranks:
        return {}
    spark = df.sparkSession
    ids: dict[tuple, int] = {}
    for t in ranks:
        ids.setdefault(t.interval(), len(ids))
    owner = {b: next(t for t in ranks if t.interval() == iv) for iv, b in ids.items()}
    pairs = df.select(F.explode(F.array(*[
        F.when(t.inside(vals[t.col]), F.struct(F.lit(b).alias("b"), vals[t.col].alias("v")))
        for b, t in owner.items()])).alias("e")).filter(F.col("e").isNotNull()).select("e.*")
    counted = pairs.groupBy("b", "v").agg(F.count(F.lit(1)).alias("k"))
    w = (Window.partitionBy("b").orderBy(F.col("v").asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("cum", F.sum("k").over(w))
    want = spark.createDataFrame(
        [(ids[t.interval()], t.col, t.rank, t.rank - t.below) for t in ranks],
        "b int, col string, rank bigint, local bigint")
    # ``want`` has one row per wanted rank (two per quantile): a fixed bound.
    hits = (ranked.join(F.broadcast(want), "b")
                  .filter((F.col("cum") - F.col("k") <= F.col("local"))
                          & (F.col("local") < F.col("cum"))))
    return {(r.col, r.rank): r.v for r in hits.select("col", "rank", "v").collect()}


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width histogram of ``col`` clipped to [lo, hi] (F7 + A11).

    Bin edges span the clipped data's own min..max (like a plotting histogram);
    the last bin is closed. Two passes: a one-row min/max, then one grouped
    count. Output: (bin, bin_lo, bin_hi, trips).
    """
    clipped = df.filter(F.col(col).between(lo, hi)).select(F.col(col).cast("double").alias("x"))
    mm = clipped.agg(F.min("x").alias("mn"), F.max("x").alias("mx")).first()
    if mm is None or mm["mn"] is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, bin_lo double, bin_hi double, trips bigint")
    mn, mx = float(mm["mn"]), float(mm["mx"])
    width = (mx - mn) / bins if mx > mn else 1.0
    b = F.least(F.floor((F.col("x") - F.lit(mn)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = clipped.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("trips"))
    return counts.select(
        "bin",
        (F.lit(mn) + F.col("bin").cast("double") * F.lit(width)).alias("bin_lo"),
        (F.lit(mn) + (F.col("bin") + 1).cast("double") * F.lit(width)).alias("bin_hi"),
        "trips")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts per value for several columns in one shuffle (E10):
    (column_name, value, trips), value as text, NULL kept as a value."""
    tall = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column_name", "value")
    return tall.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("trips"))


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows (E3): (column_name, column_type, position)."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("column_name", T.StringType()),
        T.StructField("column_type", T.StringType()),
        T.StructField("position", T.IntegerType()),
    ]))
