"""A profile kept by file (A8-A11): new files are scanned once, old ones never again.

Every file leaves two small sets of rows, which merge by adding up:

* counts   rows, and per column the NULLs; per numeric column also the exact
           sum, the least and the greatest value
* buckets  per numeric column the number, the least and the greatest of the
           values that share their first ``DIGITS`` significant digits. A column
           has at most 1.1 million buckets (900 a decade and sign), however many
           rows there are; money below ten units has one bucket a cent

``refresh`` profiles the files whose listing (parts, bytes, time of change)
differs from what is kept. Row and NULL counts, means and extremes come from the
kept rows alone. A bucket knows its own range exactly, so the merged buckets give
each wanted rank an interval with exact counts below and inside it, and each
histogram bin all values but those of the buckets on an edge: only for these is
the data read again, by a pushed-down range of one column. Results equal the
full scan's (``profile.null_profile``, ``numeric_summary``, ``quantiles``,
``histogram``); nothing depends on how a value is put in its bucket.

Rows carry the stamp of the listing they were counted under, and readers take
only rows whose stamp is recorded, so a run lost midway shows no half-written
file and is repaired by the next. Files are told apart by name. Without any file
the results are those of an empty table; NaN counts as greatest, as in Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.functions.exprs import exact_sum_parts, merged_sum, pct, round_half_away
from meterline.operators import profile as P
from meterline.sources.files import file_stamps, read_trip_files, write_partitioned
from meterline.sources.storage import exists, read_record, write_record

#: Significant digits that the values of a bucket share.
DIGITS = 3

COUNTS = ("stamp string, column_name string, rows bigint, nulls bigint, total decimal(38,10), rest double, "
          "low double, high double, source_file string")
BUCKETS = ("stamp string, part string, column_name string, bucket double, n bigint, low double, high double, "
           "source_file string")


@dataclass(frozen=True)
class Spec:
    """What is kept. ``columns``: NULL counts; ``numeric``: mean, least, greatest;
    ``parts``: name -> (SQL condition on the rows or None, numeric columns), the
    populations that quantiles and histograms are asked of."""
    columns: tuple[str, ...]
    numeric: tuple[str, ...]
    parts: dict[str, tuple[str | None, tuple[str, ...]]] = field(default_factory=dict)

    def record(self) -> list:
        return [list(self.columns), list(self.numeric),
                sorted([k, where, list(cols)] for k, (where, cols) in self.parts.items()), DIGITS]


@dataclass(frozen=True)
class Kept:
    """A kept profile: its folder, what it keeps, and how files are read (rows with
    a ``source_file`` column)."""
    path: str
    spec: Spec
    read: Callable[[SparkSession, Sequence[str]], DataFrame] = read_trip_files

    @property
    def files_record(self) -> str:
        return f"{self.path}/files.json"


def bucket_of(x) -> F.Column:
    """The value cut to ``DIGITS`` significant digits; zero, NaN, infinities and
    values too small to scale stand for themselves or for zero."""
    size = F.abs(x)
    plain = (size >= F.lit(1e-290)) & (size < F.lit(float("inf")))
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.when(plain, size))) - F.lit(DIGITS - 1))
    cut = F.floor(x / scale).cast("double") * scale
    return F.when(plain, cut).when(size < F.lit(1.0), F.lit(0.0)).otherwise(x)


def file_counts(rows: DataFrame, spec: Spec) -> DataFrame:
    """The counts of every file of ``rows``: one aggregate, then a row per column."""
    every = list(dict.fromkeys([*spec.columns, *spec.numeric]))
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(every):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nulls{i}"))
        if c in spec.numeric:
            v = F.col(c).cast("double")
            total, rest = exact_sum_parts(v)
            aggs += [total.alias(f"total{i}"), rest.alias(f"rest{i}"),
                     F.min(v).alias(f"low{i}"), F.max(v).alias(f"high{i}")]

    def cell(name: str, kind: str, i: int, c: str) -> F.Column:
        return (F.col(f"{name}{i}") if c in spec.numeric else F.lit(None)).cast(kind).alias(name)

    found = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("rows"), F.col(f"nulls{i}").alias("nulls"),
        cell("total", "decimal(38,10)", i, c), cell("rest", "double", i, c),
        cell("low", "double", i, c), cell("high", "double", i, c)) for i, c in enumerate(every)])
    return rows.groupBy("source_file").agg(*aggs).select("source_file", F.explode(found).alias("r")) \
               .select("source_file", "r.*")


def file_buckets(rows: DataFrame, spec: Spec) -> DataFrame:
    """The buckets of every file of ``rows``, counted map-side first."""
    values = [F.struct(F.lit(part).alias("part"), F.lit(c).alias("column_name"),
                       F.when(F.expr(where) if where else F.lit(True), F.col(c).cast("double")).alias("x"))
              for part, (where, cols) in spec.parts.items() for c in cols]
    tall = rows.select("source_file", F.explode(F.array(*values)).alias("v")).select("source_file", "v.*")
    return (tall.filter(F.col("x").isNotNull())
                .groupBy("source_file", "part", "column_name", bucket_of(F.col("x")).alias("bucket"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")))


def refresh(spark: SparkSession, kept: Kept, paths: Sequence[str]) -> list[str]:
    """Bring the profile to the files ``paths``; returns the paths it had to read.
    Files no longer among them leave it. The driver holds one entry per file."""
    now = {p.rstrip("/").rsplit("/", 1)[-1]: [p, stamp] for p, stamp in file_stamps(spark, paths).items()}
    known = _files(spark, kept)
    new = [name for name, (_, stamp) in now.items() if name not in known or known[name][1] != stamp]
    if new:
        rows = kept.read(spark, [now[n][0] for n in new])
        stamps = spark.createDataFrame([(n, now[n][1]) for n in new], "source_file string, stamp string")
        for found, to in ((file_counts(rows, kept.spec), "counts"),
                          *([(file_buckets(rows, kept.spec), "buckets")] if kept.spec.parts else [])):
            write_partitioned(found.join(stamps, "source_file"), f"{kept.path}/{to}", ["source_file"], dynamic=True)
    write_record(spark, kept.files_record, {"spec": kept.spec.record(), "files": now})
    return [now[n][0] for n in new]


def _files(spark: SparkSession, kept: Kept) -> dict[str, list[str]]:
    """Name -> [path, stamp] of the files in the profile; none under another spec."""
    if not exists(spark, kept.files_record):
        return {}
    record = read_record(spark, kept.files_record)
    return record["files"] if record["spec"] == kept.spec.record() else {}


def _kept_rows(spark: SparkSession, kept: Kept, what: str, schema: str) -> DataFrame:
    files = _files(spark, kept)
    path = f"{kept.path}/{what}"
    if not files or not exists(spark, path):
        return spark.createDataFrame([], schema)
    current = spark.createDataFrame([(n, s) for n, (_, s) in files.items()], "source_file string, stamp string")
    return spark.read.schema(schema).parquet(path).join(current, ["source_file", "stamp"])


def null_profile(spark: SparkSession, kept: Kept, digits: int = 3) -> DataFrame:
    """``profile.null_profile`` of all files, from the kept counts."""
    rows = _kept_rows(spark, kept, "counts", COUNTS).filter(F.col("column_name").isin(list(kept.spec.columns)))
    return (rows.groupBy("column_name").agg(F.sum("nulls").alias("null_count"), F.sum("rows").alias("n"))
                .filter("null_count > 0")
                .select("column_name", "null_count", round_half_away(pct("null_count", "n"), digits).alias("null_pct")))


def numeric_summary(spark: SparkSession, kept: Kept, avg_digits: int = 2) -> DataFrame:
    """``profile.numeric_summary`` of all files, from the kept counts."""
    rows = _kept_rows(spark, kept, "counts", COUNTS)
    names = spark.createDataFrame([(c,) for c in kept.spec.numeric], "column_name string")
    merged = rows.groupBy("column_name").agg(
        F.sum(F.col("rows") - F.col("nulls")).alias("n"), merged_sum("total", "rest").alias("total"),
        F.min("low").alias("min_value"), F.max("high").alias("max_value"))
    mean = F.try_divide(F.col("total"), F.col("n").cast("double"))
    return names.join(merged, "column_name", "left").select(
        "column_name", round_half_away(mean, avg_digits).alias("avg_value"), "min_value", "max_value")


def _cells(spark: SparkSession, kept: Kept, part: str) -> DataFrame:
    """column_name, low, high, n, upto, total: the merged buckets as disjoint value
    ranges in order (buckets that touch are one range), with the values up to each
    and in all. The windows order buckets, never rows."""
    merged = (_kept_rows(spark, kept, "buckets", BUCKETS).filter(F.col("part") == part)
              .groupBy("column_name", "bucket")
              .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")))
    order = Window.partitionBy("column_name").orderBy("low", "high", "bucket")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (before < F.col("low")), 1).otherwise(0)
    ranged = (merged.withColumn("starts", starts)
                    .withColumn("cell", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
                    .groupBy("column_name", "cell")
                    .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")))
    by_cell = Window.partitionBy("column_name").orderBy("cell")
    return (ranged.withColumn("upto", F.sum("n").over(by_cell))
                  .withColumn("total", F.sum("n").over(Window.partitionBy("column_name"))))


def quantiles(spark: SparkSession, kept: Kept, part: str, probs: Sequence[float], accuracy: int = 10_000,
              max_bracket_rows: int = P.EXACT_BRACKET_MAX_ROWS) -> DataFrame:
    """``profile.quantiles`` (exact) of the columns of ``part``. The driver holds the
    wanted ranks; the data are read only inside the ranges of their cells, and only
    if a cell has more than one value."""
    probs = [float(p) for p in probs]
    where, cols = kept.spec.parts[part]
    wanted = F.explode(F.array(*[F.lit(p) for p in probs])).alias("prob")
    at = (F.col("total") - 1).cast("double") * F.col("prob")
    held = (_cells(spark, kept, part).select("*", wanted)
            .select("*", F.floor(at).alias("lo"), F.ceil(at).alias("hi"), at.alias("at"),
                    (F.col("upto") - F.col("n")).alias("below"))
            .filter("(below <= lo and lo < upto) or (below <= hi and hi < upto)").collect())
    found, open_ranks, plan = {}, {}, {}
    for r in held:
        plan[(r.column_name, r.prob)] = (r.lo, r.hi, r["at"] - r.lo)
        for rank in (r.lo, r.hi):
            if not r.below <= rank < r.upto:
                continue
            if r.low == r.high or r.low != r.low:
                found[(r.column_name, rank)] = r.low
            elif (r.column_name, rank) not in open_ranks:
                t = P._Rank(r.column_name, rank, r.n, (cols.index(r.column_name), probs.index(r.prob)))
                t.lo, t.hi, t.below = (r.low, False), (r.high, False), r.below
                open_ranks[(r.column_name, rank)] = t
    if open_ranks:
        vals = {c: F.col(c).cast("double") for c in cols}
        ranks = list(open_ranks.values())
        rows = _read_back(spark, kept, where).filter(_any([t.inside(vals[t.col]) for t in ranks]))
        found.update(P.values_at_ranks(rows.select(*cols), ranks, vals, accuracy, max_bracket_rows, {}))
    nothing = (None, None, None)
    return spark.createDataFrame(
        [(c, p, P.interpolated(found, c, *plan.get((c, p), nothing))) for c in cols for p in probs],
        "column_name string, prob double, value double")


def histogram(spark: SparkSession, kept: Kept, part: str, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """``profile.histogram`` of a column of ``part``. Cells inside one bin are added
    up; the values of the others, at most one for every bin edge and clip bound, are
    counted from the data."""
    where = kept.spec.parts[part][0]
    x = F.col(col).cast("double")
    cells = (_cells(spark, kept, part).filter(F.col("column_name") == col)
             .filter((F.col("high") >= lo) & (F.col("low") <= hi)).select("low", "high", "n"))
    whole = (F.col("low") >= lo) & (F.col("high") <= hi)
    ends = cells.agg(F.min(F.when(whole, F.col("low"))).alias("mn"), F.max(F.when(whole, F.col("high"))).alias("mx"),
                     F.collect_list(F.when(~whole, F.struct("low", "high"))).alias("cut")).first()
    rows = _read_back(spark, kept, where).select(x.alias("x")).filter(F.col("x").between(lo, hi))

    def within(ranges) -> F.Column:
        return _any([F.col("x").between(r["low"], r["high"]) for r in ranges])

    known = [v for v in (ends["mn"], ends["mx"]) if v is not None]
    if ends["cut"]:
        near = rows.filter(within(ends["cut"])).agg(F.min("x").alias("mn"), F.max("x").alias("mx")).first()
        known += [v for v in near if v is not None]
    if not known:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, trips bigint")
    mn, mx = min(known), max(known)
    width = (mx - mn) / bins if mx > mn else 1.0

    def bin_of(v: F.Column) -> F.Column:
        return F.least(F.floor((v - F.lit(mn)) / F.lit(width)).cast("int"), F.lit(bins - 1))

    # Binning is monotone, so the values of a cell whose ends share a bin are all in it.
    settled = F.when(whole, bin_of(F.col("low")) == bin_of(F.col("high"))).otherwise(F.lit(False))
    counts = cells.filter(settled).groupBy(bin_of(F.col("low")).alias("bin")).agg(F.sum("n").alias("trips"))
    split = cells.filter(~settled).select("low", "high").collect()
    if split:
        counts = counts.unionByName(rows.filter(within(split)).groupBy(bin_of(F.col("x")).alias("bin"))
                                        .agg(F.count(F.lit(1)).alias("trips")))
    return counts.groupBy("bin").agg(F.sum("trips").alias("trips")).select(
        "bin", (F.lit(mn) + F.col("bin").cast("double") * F.lit(width)).alias("bin_lo"),
        (F.lit(mn) + (F.col("bin") + 1).cast("double") * F.lit(width)).alias("bin_hi"), "trips")


def _any(conditions: Sequence[F.Column]) -> F.Column:
    return reduce(lambda a, b: a | b, conditions)


def _read_back(spark: SparkSession, kept: Kept, where: str | None) -> DataFrame:
    rows = kept.read(spark, [path for path, _ in _files(spark, kept).values()])
    return rows.filter(where) if where else rows
