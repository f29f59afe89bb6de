"""Readers and writers.

* ``file_groups``       monthly files grouped by their footers' types
* ``file_columns``      the same catalogue as rows: file, column, type
* ``read_trip_files``   typed Parquet scan of monthly files with provenance
* ``read_months``       the files of a chosen month list, in one scan
* ``land_columns``      the typed landing projection (raw-table shape)
* ``ingest_files``      idempotent batch load: files already in the ledger
                        are skipped, new ones appended (plus the ledger rows)
* ``read_zone_csv``     typed CSV dimension
* ``write_partitioned``  partitioned overwrite
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.exprs import month_from_name
from meterline.sources.storage import located

# Columns of a monthly trip file, in order (fixed values of the source's data
# dictionary), with the types we give them. Files differ in how wide they store
# numbers; ``read_trip_files`` reads each by its own footer and casts.
TRIP_FILE_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.DoubleType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
])

# Columns landed in the raw table, in order (fixed values of its contract).
RAW_COLUMNS = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "PULocationID", "DOLocationID", "payment_type",
    "fare_amount", "tip_amount", "total_amount", "source_file", "file_month",
    "_loaded_at",
]

ZONE_CSV_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

# Monthly file naming (fixed value of the source layout).
FILE_PATTERN = "yellow_tripdata_{month}.parquet"
MONTH_IN_NAME = r"[0-9]{4}-[0-9]{2}"


def month_paths(base_dir: str, months: Iterable[str]) -> list[str]:
    """Paths of the monthly files for 'YYYY-MM' months (comma list or iterable)."""
    if isinstance(months, str):
        months = [m.strip() for m in months.split(",") if m.strip()]
    return [f"{base_dir.rstrip('/')}/{FILE_PATTERN.format(month=m)}" for m in months]


# Last path element carrying a YYYY-MM month and ending in .parquet, skipping
# Spark part files (their UUIDs can contain digit runs).
_MONTH_FILE_RE = r".*/((?!part-)[^/]*[0-9]{4}-[0-9]{2}[^/]*\.parquet)(?:/[^/]*)?$"


def file_name_of(path_col) -> F.Column:
    """The monthly file name from a full file path.

    When a 'file' is itself a Spark output directory the last path element is
    a part file, so take the path element that carries the month pattern;
    otherwise the last element. One codegen'd regex per row.
    """
    named = F.regexp_extract(path_col, _MONTH_FILE_RE, 1)
    last = F.regexp_extract(path_col, r"[^/]*$", 0)
    return F.when(named != "", named).otherwise(last)


def _footer_files(spark: SparkSession, paths: Sequence[str]):
    """Status of the file that stands for each path: itself, or the first part
    of a folder (None for a folder without any)."""
    for path in paths:
        fs, at = located(spark, path)
        status = fs.getFileStatus(at)
        if status.isDirectory():
            parts = {st.getPath().getName(): st for st in fs.listStatus(at)}
            parts = {n: st for n, st in parts.items() if n[0] not in "_."}
            status = parts[min(parts)] if parts else None
        yield status


def file_stamps(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Path -> what a listing says of the file, or of the parts of a folder: number,
    bytes and latest change. A rewritten file has another stamp."""
    stamps = {}
    for path in paths:
        fs, at = located(spark, path)
        parts = [st for st in fs.listStatus(at) if st.getPath().getName()[0] not in "_."]
        stamps[path] = "-".join(str(v) for v in (
            len(parts), sum(st.getLen() for st in parts),
            max((st.getModificationTime() for st in parts), default=0)))
    return stamps


def file_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files grouped by what their footers declare: (schema, paths).

    The footers are read in parallel by the Parquet library in one call; Spark
    itself opens one file of each group. The driver holds one short text per
    file. A folder of part files has the schema of its first part; a folder
    without parts has no rows and is left out.
    """
    jvm = spark.sparkContext._jvm
    known, statuses = [], jvm.java.util.ArrayList()
    for path, status in zip(paths, _footer_files(spark, paths)):
        if status is not None:
            known.append(path)
            statuses.add(status)
    found = jvm.org.apache.parquet.hadoop.ParquetFileReader.readAllFootersInParallel(
        spark.sparkContext._jsc.hadoopConfiguration(), statuses, True)
    groups: dict[str, list[str]] = {}
    for path, footer in zip(known, found):
        text = footer.getParquetMetadata().getFileMetaData().getSchema().toString()
        groups.setdefault(text, []).append(path)
    return [(spark.read.parquet(same[0]).schema, same) for same in groups.values()]


def file_columns(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The footer catalogue as rows: source_file, column_name, column_type of
    every column of every file."""
    groups = file_groups(spark, paths)
    files = spark.createDataFrame([(i, p) for i, (_, same) in enumerate(groups) for p in same],
                                  "group int, path string")
    columns = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, (own, _) in enumerate(groups) for f in own.fields],
        "group int, column_name string, column_type string")
    return files.join(columns, "group").select(
        file_name_of(F.col("path")).alias("source_file"), "column_name", "column_type")


def read_trip_files(spark: SparkSession, paths: Sequence[str] | str,
                    schema: T.StructType = TRIP_FILE_SCHEMA) -> DataFrame:
    """Typed scan of monthly files with the source file name attached.

    Files are grouped by their footers' types (``file_groups``); each group is
    one scan, cast to ``schema``, with NULL for columns it lacks. So an id
    stored as INT32 in one month and INT64 in the next, or a count stored as a
    double, loads alike, and timestamps arrive as TIMESTAMP_NTZ. Names match
    whatever their case.
    """
    if isinstance(paths, str):
        paths = [paths]
    out = None
    for own, same in file_groups(spark, paths):
        have = {f.name.lower(): f.name for f in own.fields}
        cols = [(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
                .cast(f.dataType).alias(f.name) for f in schema.fields]
        part = spark.read.schema(own).parquet(*same).select(
            *cols, file_name_of(F.col("_metadata.file_path")).alias("source_file"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema).withColumn("source_file", F.lit("").cast("string"))
    return out


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted (a listing: one entry per file)."""
    fs, at = located(spark, pattern)
    found = fs.globStatus(at)
    return sorted(st.getPath().toString() for st in found or [])


def read_months(spark: SparkSession, base_dir: str, months) -> DataFrame:
    """The chosen months' files in one parallel scan (S3)."""
    return read_trip_files(spark, month_paths(base_dir, months))


def land_columns(df: DataFrame, loaded_at: str, keep: Sequence[str] = ()) -> DataFrame:
    """Typed landing projection (S1, S4-S6, S8): the raw-table shape.

    Counts and ids are rounded then cast to int; ``file_month`` comes from the
    month in the file name (NULL when absent or invalid); ``_loaded_at`` is a
    literal per batch so a retried task stamps the same value.
    """
    def to_int(c):
        return F.round(F.col(c)).cast("int")

    return df.select(
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        to_int("passenger_count").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        to_int("PULocationID").alias("PULocationID"),
        to_int("DOLocationID").alias("DOLocationID"),
        to_int("payment_type").alias("payment_type"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("tip_amount").cast("double").alias("tip_amount"),
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("source_file"),
        month_from_name(F.col("source_file")).alias("file_month"),
        F.lit(loaded_at).cast("timestamp_ntz").alias("_loaded_at"),
        *[F.col(k) for k in keep],
    )


# ------------------------------------------------------------------ ledger load

LEDGER_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("_loaded_at", T.TimestampNTZType()),
])


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # missing path: an empty table
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def ingest_files(spark: SparkSession, paths: Sequence[str], raw_path: str,
                 ledger_path: str, loaded_at: str) -> DataFrame:
    """Idempotent batch landing.

    Files whose name is already in the ledger are skipped; the new files are
    read in one scan per footer type, landed into the raw table, then recorded
    in the ledger. Returns per-file loaded counts of this run (possibly empty).

    Raw table and ledger are partitioned by file and written with dynamic
    overwrite: a load replaces only its own files' rows, whatever stamp other
    loads carry, and a run that failed after the raw write replaces its rows
    when it is run again. The driver holds one entry per listed file.
    """
    ledger = _read_or_empty(spark, ledger_path, LEDGER_SCHEMA)
    names = [p.rstrip("/").split("/")[-1] for p in paths]
    listing = spark.createDataFrame([(n, p) for n, p in zip(names, paths)],
                                    "source_file string, path string")
    new = [r.path for r in listing.join(ledger, "source_file", "left_anti")
           .select("path").collect()]
    if not new:
        return spark.createDataFrame([], "source_file string, rows bigint")
    new_names = [p.rstrip("/").split("/")[-1] for p in new]
    _by_file(land_columns(read_trip_files(spark, new), loaded_at), raw_path)
    counts = (spark.read.parquet(raw_path).filter(F.col("source_file").isin(new_names))
              .groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")))
    _by_file(spark.createDataFrame([(n,) for n in new_names], "source_file string")
             .withColumn("_loaded_at", F.lit(loaded_at).cast("timestamp_ntz")), ledger_path)
    return counts


def _by_file(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, ["source_file"], dynamic=True, rebalance=False)


def file_counts(raw: DataFrame) -> DataFrame:
    """Rows per source file plus nothing else (S10); total is ``sum(rows)``."""
    return raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------ dimension

def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed CSV dimension (S11). 'N/A' stays a string."""
    return spark.read.option("header", True).schema(ZONE_CSV_SCHEMA).csv(path)


# ------------------------------------------------------------------ sinks

def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` dealt by the partition columns for a partitioned write: adaptive
    execution cuts a heavy partition's rows into several tasks (files) of the
    advisory size and puts small partitions together in one task, one file each.
    Without it every task writes a file for every partition it holds."""
    return df.hint("rebalance", *by)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str],
                      dynamic: bool = False, rebalance: bool = True,
                      compression: str | None = None) -> None:
    """Partitioned Parquet overwrite (S12), by default in the session's compression.

    Rows are rebalanced by the partition columns first: a month holding a third
    of all rows is written by many tasks, months of a few rows are one file each.
    ``rebalance=False`` for rows that already lie together by partition (the
    scan of one file per partition). ``dynamic=True`` replaces only the
    partitions present in ``df``.
    """
    mode = "dynamic" if dynamic else "static"
    if rebalance:
        df = rebalanced(df, by)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", mode)
       .partitionBy(*by)
       .parquet(path, compression=compression))
