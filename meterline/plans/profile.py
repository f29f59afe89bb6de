"""Exploratory profile of trip files (E1-E16), each a small aggregate.

The inputs are file-shaped trip rows (``tpep_*`` names, file-only columns such
as VendorID / RatecodeID / store_and_fwd_flag) and the zone lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.exprs import (day_name, exact_avg, label, minutes_between,
                                       round_half_away, share_flag)
from meterline.operators import kept_profile as K
from meterline.operators import profile as P
from meterline.operators.joins import lookup
from meterline.operators.windows import share_of_total
from meterline.sources.files import TRIP_FILE_SCHEMA

# Dictionary labels of the profile (fixed values).
PAYMENT_MIX_LABELS = {0: "(0) undocumented", 1: "Credit card", 2: "Cash", 3: "No charge",
                      4: "Dispute", 5: "Unknown", 6: "Voided"}
RATE_CODE_LABELS = {1: "Standard", 2: "JFK", 3: "Newark", 4: "Nassau/Westchester",
                    5: "Negotiated", 6: "Group", 99: "(99) unknown"}

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def row_range(trips: DataFrame) -> DataFrame:
    """Row count and pickup range."""
    return trips.agg(F.count(F.lit(1)).alias("rows"), F.min(PICKUP).alias("min_pickup"),
                     F.max(PICKUP).alias("max_pickup"))


def rows_per_year(trips: DataFrame) -> DataFrame:
    """Rows per pickup year with share (4 places)."""
    g = trips.groupBy(F.year(PICKUP).alias("pickup_year")).agg(
        F.count(F.lit(1)).alias("trips"))
    return share_of_total(g, "trips", "pct", 4).orderBy(F.col("pickup_year").asc_nulls_last())


def null_profile(trips: DataFrame) -> DataFrame:
    """Columns with NULLs, count and percent (3 places)."""
    return P.null_profile(trips, 3)


def numeric_summary(trips: DataFrame) -> DataFrame:
    """E5: mean / min / max of distance, fare, total and passengers."""
    return P.numeric_summary(trips, ["trip_distance", "fare_amount", "total_amount",
                                     "passenger_count"])


def quantile_summary(trips: DataFrame, accuracy: int | None = None) -> DataFrame:
    """p50 / p90 / p99 of distance, fare and total on rows with fare > 0."""
    return P.quantiles(trips.filter(F.col("fare_amount") > 0),
                       ["trip_distance", "fare_amount", "total_amount"],
                       [0.5, 0.9, 0.99], accuracy)


def distance_histogram(trips: DataFrame, lo: float = 0.0, hi: float = 20.0,
                       bins: int = 40) -> DataFrame:
    """Histogram data of trip distance clipped to [lo, hi]."""
    return P.histogram(trips, "trip_distance", lo, hi, bins)


def payment_mix(trips: DataFrame) -> DataFrame:
    """Payment codes with labels, counts and share (2 places)."""
    g = trips.groupBy("payment_type", label("payment_type", PAYMENT_MIX_LABELS, "???")
                      .alias("label")).agg(F.count(F.lit(1)).alias("trips"))
    return share_of_total(g, "trips", "pct", 2).orderBy(F.col("trips").desc())


def rate_code_mix(trips: DataFrame) -> DataFrame:
    """Rate codes with labels and counts."""
    return (trips.groupBy("RatecodeID", label("RatecodeID", RATE_CODE_LABELS, "null")
                          .alias("label"))
                 .agg(F.count(F.lit(1)).alias("trips")).orderBy(F.col("trips").desc()))


def value_counts(trips: DataFrame, cols=("VendorID", "store_and_fwd_flag")) -> DataFrame:
    """Value counts of chosen columns, one shuffle for all of them."""
    return P.value_counts(trips, list(cols))


def red_flags(trips: DataFrame, year: int, max_minutes: float = 180) -> DataFrame:
    """Rows raising each red flag, one scan."""
    pc = F.col("passenger_count")
    return P.conditional_counts(trips, {
        "fare_le_0": F.col("fare_amount") <= 0,
        "dist_le_0": F.col("trip_distance") <= 0,
        "total_lt_fare": F.col("total_amount") < F.col("fare_amount"),
        "dropoff_le_pickup": F.col(DROPOFF) <= F.col(PICKUP),
        "pax_out_of_range": pc.isNull() | (pc < 1) | (pc > 6),
        "over_max_minutes": minutes_between(PICKUP, DROPOFF) > F.lit(max_minutes),
        "not_trip_year": F.year(PICKUP) != F.lit(year),
    })


def borough_share(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Pickups per borough (inner join to the lookup), share (1 place).

    Counted per pickup id first, then joined: the lookup key is unique, so the
    join sees one row per id instead of one per trip.
    """
    per_id = trips.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"))
    j = lookup(per_id, zones, "PULocationID", "location_id", {"borough": "borough"},
               how="inner")
    g = j.groupBy("borough").agg(F.sum("n").alias("trips"))
    return share_of_total(g, "trips", "pct", 1).orderBy(F.col("trips").desc())


def unknown_geography(trips: DataFrame, zones: DataFrame, ids=(264, 265)) -> DataFrame:
    """Trips whose pickup id is one of the 'unknown' sentinel ids."""
    f = trips.filter(F.col("PULocationID").isin(list(ids)))
    per_id = f.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"))
    j = lookup(per_id, zones, "PULocationID", "location_id",
               {"borough": "borough", "zone_name": "zone"}, how="inner")
    return (j.groupBy("borough", "zone").agg(F.sum("n").alias("trips"))
             .orderBy(F.col("trips").desc()))


def trips_by_hour(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Trips per hour of day."""
    return (trips.groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("trips"))
                 .orderBy("hour"))


def day_of_week(trips: DataFrame, ts: str = PICKUP, fare: str = "fare_amount") -> DataFrame:
    """Trips and mean fare per weekday name (fare > 0)."""
    return (trips.filter(F.col(fare) > 0)
                 .groupBy(day_name(ts).alias("dow"))
                 .agg(F.count(F.lit(1)).alias("trips"),
                      round_half_away(exact_avg(fare), 2).alias("avg_fare"))
                 .orderBy(F.col("trips").desc()))


def tipping_by_type(trips: DataFrame) -> DataFrame:
    """Tipping per payment type (fare > 0)."""
    return (trips.filter(F.col("fare_amount") > 0)
                 .groupBy("payment_type")
                 .agg(F.count(F.lit(1)).alias("trips"),
                      round_half_away(exact_avg("tip_amount"), 2).alias("avg_tip"),
                      round_half_away(F.lit(100.0) * F.avg(share_flag(F.col("tip_amount") > 0)),
                                      1).alias("pct_tipped"))
                 .orderBy(F.col("trips").desc()))


def schema(trips: DataFrame) -> DataFrame:
    """Describe the columns."""
    return P.schema_rows(trips)


def file_schema(columns: DataFrame) -> DataFrame:
    """E3 over many files: each column and type of ``sources.files.file_columns``
    with the number of files that have it so, the first and the last of them. A
    column that differs in one month shows as a second row."""
    return (columns.groupBy("column_name", "column_type")
                   .agg(F.count(F.lit(1)).alias("files"), F.min("source_file").alias("first_file"),
                        F.max("source_file").alias("last_file")))


# E4-E7 as kept by file: the fare rule of E6 is a population of its own.
KEPT_SPEC = K.Spec(
    columns=tuple(TRIP_FILE_SCHEMA.names),
    numeric=("trip_distance", "fare_amount", "total_amount", "passenger_count"),
    parts={"all": (None, ("trip_distance",)),
           "paid": ("fare_amount > 0", ("trip_distance", "fare_amount", "total_amount"))})


def kept_profile_rows(spark: SparkSession, kept: K.Kept) -> DataFrame:
    """E4-E7 of all files in the kept profile as (part, column_name, place, value):
    NULL counts at their percent, means and extremes, quantiles at their share,
    bins at their lower edge."""
    def rows(df, part, place, value):
        return df.select(F.lit(part).alias("part"), "column_name", F.lit(place).cast("double").alias("place")
                         if place is None else F.col(place).alias("place"),
                         F.col(value).cast("double").alias("value"))

    summary = K.numeric_summary(spark, kept)
    bins = K.histogram(spark, kept, "all", "trip_distance", 0.0, 20.0, 40) \
        .withColumn("column_name", F.lit("trip_distance"))
    out = rows(K.null_profile(spark, kept), "nulls", "null_pct", "null_count")
    for name in ("avg_value", "min_value", "max_value"):
        out = out.unionByName(rows(summary, name, None, name))
    return (out.unionByName(rows(K.quantiles(spark, kept, "paid", [0.5, 0.9, 0.99]), "quantile", "prob", "value"))
               .unionByName(rows(bins, "histogram", "bin_lo", "trips")))
