"""Trip-shaped inputs derived from the driver's TPC-H-like tables.

The driver ships no trip files, so the trip source is a view over
lineitem x orders x customer x supplier x part (all inner joins), and the zone
dimension is nation x region. The mapping is fixed (see FIXTURES.md):

    pickup / dropoff time   o_orderdate / l_shipdate
    passenger_count         l_quantity, with 7 made NULL (exercises NULL rules)
    trip_distance           double(p_size)
    fare / tip / total      l_extendedprice, l_extendedprice * l_tax,
                            l_extendedprice * (1 - l_discount) * (1 + l_tax)
    PU / DO location        c_nationkey / s_nationkey
    payment_type            l_linenumber
    file_month, source_file month of o_orderdate

The joins are left to Catalyst + AQE: at scale customer, part and orders are
not small, so nothing here is forced to broadcast. Customers meet the orders, not
the much longer lineitem. A query that takes several batches of these rows joins
them once (``staged_rows``) and passes them on as ``rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.exprs import json_extract
from meterline.session import dropped_shuffles, open_files, scratch_path
from meterline.sources.files import TRIP_FILE_SCHEMA, land_columns, write_partitioned

# Fixed load time of the base view (a batch literal, deterministic on retry).
BASE_LOADED_AT = "2024-01-01 00:00:00"

TRIP_SOURCE_COLUMNS = TRIP_FILE_SCHEMA.names


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Just the trip-file columns (the profile's input)."""
    return trip_file_rows(spark, sf_dir).select(*TRIP_SOURCE_COLUMNS)


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's columns that make up a trip, one row per line item, and the
    month the row's file belongs to (``_file_ym``, 'YYYY-MM')."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    p = table(spark, sf_dir, "part")
    j = (li.join(s, li.l_suppkey == s.s_suppkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey))
    return j.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                    "l_tax", "l_linestatus", "l_shipdate", "o_orderdate", "c_nationkey", "s_nationkey", "p_size",
                    F.date_format(F.col("o_orderdate"), "yyyy-MM").alias("_file_ym"))


def staged_rows(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """``source_rows`` joined once into the shared folder, for queries that take
    several batches of them; with ``by_month`` stored by their file month."""
    from meterline.operators.incremental import OPEN_FILES, stage
    rows = source_rows(spark, sf_dir)
    if not by_month:
        return stage(spark, rows, "trip-rows")[0]
    path = scratch_path(spark, "trip-rows")
    with dropped_shuffles(spark), open_files(spark, OPEN_FILES):
        write_partitioned(rows, path, ["_file_ym"], compression="zstd")
    return spark.read.schema(rows.schema).parquet(path)


def trip_file_rows(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Rows shaped like a monthly trip file (all 19 columns) plus ``_file_ym``;
    ``rows`` are the source rows if they are staged."""
    j = source_rows(spark, sf_dir) if rows is None else rows
    price = F.col("l_extendedprice")
    return j.select(
        (F.lit(1) + F.col("l_suppkey") % 2).cast("int").alias("VendorID"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.nullif(F.col("l_quantity"), F.lit(7.0)).alias("passenger_count"),
        F.col("p_size").cast("double").alias("trip_distance"),
        F.when(F.col("l_linenumber") == 7, F.lit(99.0))
         .otherwise(F.col("l_linenumber").cast("double")).alias("RatecodeID"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        F.col("c_nationkey").cast("int").alias("PULocationID"),
        F.col("s_nationkey").cast("int").alias("DOLocationID"),
        F.col("l_linenumber").cast("int").alias("payment_type"),
        price.alias("fare_amount"),
        (F.col("l_discount") * F.lit(10.0)).alias("extra"),
        F.when(F.col("l_linenumber") == 7, F.lit(-0.5)).otherwise(F.lit(0.5)).alias("mta_tax"),
        (price * F.col("l_tax")).alias("tip_amount"),
        (price * (F.lit(1.0) - F.col("l_discount")) * (F.lit(1.0) + F.col("l_tax")))
        .alias("total_amount"),
        (F.col("l_tax") * F.lit(100.0)).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        # Blank where the passenger count is, as in the source's files.
        F.when(F.col("l_quantity") != 7, F.lit(2.5)).alias("congestion_surcharge"),
        F.when(F.col("l_quantity") != 7, F.when(F.col("l_linenumber") == 1, F.lit(1.25))
               .otherwise(F.lit(0.0))).alias("airport_fee"),
        F.col("_file_ym"), F.col("l_orderkey"), F.col("l_linenumber"),
    )


def raw_trips(spark: SparkSession, sf_dir: str,
              loaded_at: str = BASE_LOADED_AT, rows: DataFrame | None = None) -> DataFrame:
    """The landed raw table (S1-S6 applied to the file rows in place).

    Typed like the raw table: counts and ids are int (rounded), money double,
    plus source_file, file_month and one _loaded_at literal per batch.
    Keeps l_orderkey / l_linenumber for batch splitting and dedupe fixtures.
    """
    rows = trip_file_rows(spark, sf_dir, rows)
    source_file = F.concat(F.lit("yellow_tripdata_"), F.col("_file_ym"), F.lit(".parquet"))
    return land_columns(rows.withColumn("source_file", source_file), loaded_at,
                        keep=["l_orderkey", "l_linenumber"])


def zone_seed(spark: SparkSession, sf_dir: str, partial: bool = False) -> DataFrame:
    """Zone lookup shaped like the seed CSV: LocationID, Borough, Zone, service_zone.

    ``partial=True`` keeps n_nationkey < 20 only, leaving pickup keys 20..24
    without a dimension row (orphan-key and unmatched left-join cases).
    """
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    z = n.join(r, n.n_regionkey == r.r_regionkey)
    if partial:
        z = z.filter(F.col("n_nationkey") < 20)
    return z.select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("Zone "), F.col("n_regionkey").cast("string")).alias("service_zone"),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact-shaped trips from ``events`` for time-of-day work.

    pickup_datetime = ts (sub-second), pickup_location_id = user_id,
    fare_amount = value, payment label = event_type, trip_distance = the
    ``k`` field of the JSON ``props`` column.
    """
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("user_id").alias("pickup_location_id"),
        F.col("value").alias("fare_amount"),
        F.col("event_type").alias("payment_label"),
        json_extract(F.col("props"), "$.k", "double").alias("trip_distance"),
        F.col("props"),
    )


def widened(rows: DataFrame) -> DataFrame:
    """The rows as another month's files store them: 64-bit integers."""
    return rows.withColumns({c: F.col(c).cast("bigint") for c in
                             ("VendorID", "passenger_count", "PULocationID", "DOLocationID",
                              "payment_type")})


def write_month_files(spark: SparkSession, sf_dir: str, base_dir: str,
                      where=None, wide: bool = False, rows: DataFrame | None = None) -> list[str]:
    """Write the trip-file rows as monthly files ``yellow_tripdata_YYYY-MM.parquet``
    under ``base_dir`` (each a Parquet folder); returns the written paths.

    One partitioned write (no per-month jobs), then each ``_file_ym=...``
    folder is renamed to the monthly file name: a metadata operation.
    """
    rows = trip_file_rows(spark, sf_dir, rows)
    if where is not None:
        rows = rows.filter(where)
    if wide:
        rows = widened(rows)
    stage = f"{base_dir.rstrip('/')}/_stage"
    rows.select(*TRIP_SOURCE_COLUMNS, "_file_ym").write.mode("overwrite") \
        .partitionBy("_file_ym").parquet(stage)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stage_path = jvm.org.apache.hadoop.fs.Path(stage)
    fs = stage_path.getFileSystem(conf)
    out = []
    for st in fs.listStatus(stage_path):
        name = st.getPath().getName()
        if not name.startswith("_file_ym="):
            continue
        ym = name.split("=", 1)[1]
        dst = f"{base_dir.rstrip('/')}/yellow_tripdata_{ym}.parquet"
        fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(dst))
        out.append(dst)
    return sorted(out)
