"""Reports over the fact and the zone mart.

Every top-N carries tie-breakers to a total order, so a limit never picks an
arbitrary subset of tied rows. Global shares are windows over an aggregate
(a few dozen rows), never over trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.exprs import (exact_avg, exact_sum, label, pct,
                                       round_half_away, share_flag)
from meterline.operators.joins import lookup
from meterline.operators.windows import lag_gap, share_of_total, top_k

# Payment codes of the trip dictionary (fixed values).
PAYMENT_LABELS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute"}


def top_zones_by_revenue(zp: DataFrame, n: int = 10, month: str | None = None) -> DataFrame:
    """Q1: best revenue ranks. Without ``month`` ranks of all months compete
    (ties broken by month, then zone id); with ``month`` one month's top n."""
    src = zp if month is None else zp.filter(F.col("file_month") == F.lit(month).cast("date"))
    return (src.select("file_month", "pickup_location_id", "revenue_rank", "borough",
                       "zone_name", "total_trips", "avg_fare", "total_revenue",
                       "is_high_volume_zone")
               .orderBy(F.col("revenue_rank").asc_nulls_last(), F.col("file_month").asc(),
                        F.col("pickup_location_id").asc())
               .limit(n))


def top_zones_by_trips(zp: DataFrame, n: int = 15) -> DataFrame:
    """Zone-months with the most trips."""
    return (zp.select("file_month", "pickup_location_id", "revenue_rank", "borough",
                      "zone_name", "total_trips", "avg_trip_distance", "avg_fare",
                      "total_revenue", "is_high_volume_zone")
              .orderBy(F.col("total_trips").desc(), F.col("total_revenue").desc_nulls_first(),
                       F.col("file_month").asc(), F.col("pickup_location_id").asc())
              .limit(n))


def zone_all_time(zp: DataFrame) -> DataFrame:
    """The monthly zone mart rolled up to one row per zone."""
    g = zp.groupBy("pickup_location_id", "borough", "zone_name").agg(
        F.count(F.lit(1)).alias("months_observed"),
        F.sum("total_trips").alias("total_trips"),
        round_half_away(exact_sum("total_revenue"), 2).alias("total_revenue"),
        F.min("revenue_rank").alias("best_month_rank"),
        F.count_if(F.col("is_high_volume_zone")).alias("high_volume_months"))
    from pyspark.sql import Window
    w = Window.orderBy(F.col("total_revenue").desc_nulls_first())
    # One row per zone: a global rank over a table bounded by the zone count.
    return g.withColumn("all_time_rank", F.rank().over(w))


def hour_of_day(fct: DataFrame) -> DataFrame:
    """Q2: trips, average fare and distance per pickup hour, share of trips."""
    g = fct.groupBy(F.hour("pickup_datetime").alias("pickup_hour")).agg(
        F.count(F.lit(1)).alias("total_trips"),
        round_half_away(exact_avg("fare_amount"), 2).alias("avg_fare"),
        round_half_away(exact_avg("trip_distance"), 2).alias("avg_distance"))
    return share_of_total(g, "total_trips", "pct_of_trips", 2).orderBy("pickup_hour")


def hour_profile(fct: DataFrame) -> DataFrame:
    """Hour profile with average duration."""
    g = fct.groupBy(F.hour("pickup_datetime").alias("pickup_hour")).agg(
        F.count(F.lit(1)).alias("trips"),
        round_half_away(exact_avg("fare_amount"), 2).alias("avg_fare"),
        round_half_away(exact_avg("trip_distance"), 2).alias("avg_miles"),
        round_half_away(exact_avg("trip_duration_minutes"), 1).alias("avg_duration_min"))
    return share_of_total(g, "trips", "pct_of_trips", 2).orderBy("pickup_hour")


def idle_gaps(fct: DataFrame, zones: DataFrame, k: int = 5, split: str = "auto",
              key: str = "pickup_location_id", ts: str = "pickup_datetime") -> DataFrame:
    """Q3: the k longest idle gaps (boundary minutes) between consecutive
    pickups of each zone, ties kept, with the zone name.

    One hash exchange on (zone, time bucket) serves the lag, the bucket
    carry-over and the first, local top-k; only the survivors are shuffled by
    zone for the final rank, and only those meet the dimension. ``split``
    'auto' sizes the bucket so no (zone, bucket) holds more than
    ``BUCKET_TARGET_ROWS`` rows (one extra scan of the two columns).
    """
    gaps = lag_gap(fct, key, ts, prev_col="prev_pickup_datetime",
                   gap_col="gap_minutes", split=split)
    return longest_gaps(gaps, zones, k, key, ts, split="__bucket")


def longest_gaps(gaps: DataFrame, zones: DataFrame, k: int = 5, key: str = "pickup_location_id",
                 ts: str = "pickup_datetime", split: str | None = None) -> DataFrame:
    """Q3 from gaps, such as the kept ones (``models.kept_gaps``), whose zone is cut
    by the pickup's month for the first, local top-k."""
    if split is None:
        gaps, split = gaps.withColumn("__bucket", F.date_trunc("month", F.col(ts))), "__bucket"
    top = top_k(gaps, key, F.col("gap_minutes").desc_nulls_first(), k,
                rank_col="gap_rank", split=split)
    named = lookup(top, zones, key, "location_id", {"zone_name": "zone_name"})
    return (named.select(key, "zone_name", "prev_pickup_datetime", ts, "gap_minutes",
                         "gap_rank")
                 .orderBy(F.col(key).asc(), F.col("gap_rank").asc(), F.col(ts).asc()))


def volume_by_month(fct: DataFrame) -> DataFrame:
    """Trips and economics per pickup month."""
    g = fct.groupBy(F.month("pickup_datetime").alias("month")).agg(
        F.count(F.lit(1)).alias("trips"),
        round_half_away(exact_avg("trip_distance"), 2).alias("avg_miles"),
        round_half_away(exact_avg("fare_amount"), 2).alias("avg_fare"),
        round_half_away(exact_avg("total_amount"), 2).alias("avg_total"),
        round_half_away(exact_sum("total_amount") / F.lit(1e6), 1).alias("revenue_millions"))
    return g.orderBy("month")


def dq_audit(raw: DataFrame, year: int) -> DataFrame:
    """How many raw rows fail each rule, in one scan."""
    from meterline.operators.profile import conditional_counts
    pc = F.col("passenger_count")
    return conditional_counts(raw, {
        "raw_rows": F.lit(True),
        "bad_fare": F.col("fare_amount") <= 0,
        "bad_distance": F.col("trip_distance") <= 0,
        "bad_time": F.col("tpep_dropoff_datetime") <= F.col("tpep_pickup_datetime"),
        "bad_passengers": pc.isNull() | (pc < 1) | (pc > 6),
        "year_leakage": F.year("tpep_pickup_datetime") != F.lit(year),
    })


def payment_tipping(fct: DataFrame) -> DataFrame:
    """Payment mix and tipping per payment type."""
    g = fct.groupBy("payment_type", label("payment_type", PAYMENT_LABELS, "Other")
                    .alias("label")).agg(
        F.count(F.lit(1)).alias("trips"),
        round_half_away(exact_avg("tip_amount"), 2).alias("avg_tip"),
        round_half_away(F.lit(100.0) * F.avg(share_flag(F.col("tip_amount") > 0)), 1)
        .alias("pct_trips_tipped"),
        round_half_away(pct(exact_sum("tip_amount"), exact_sum("fare_amount")), 1)
        .alias("tip_pct_of_fare"))
    return (share_of_total(g, "trips", "pct_of_trips", 1)
            .orderBy(F.col("trips").desc(), F.col("payment_type").asc_nulls_last()))


def borough_flow(fct: DataFrame, n: int = 15) -> DataFrame:
    """Pickup -> dropoff borough pairs by volume (top n)."""
    g = (fct.filter(F.col("pickup_borough").isNotNull() & F.col("dropoff_borough").isNotNull())
            .groupBy("pickup_borough", "dropoff_borough").agg(
                F.count(F.lit(1)).alias("trips"),
                round_half_away(exact_avg("trip_distance"), 2).alias("avg_miles"),
                round_half_away(exact_avg("total_amount"), 2).alias("avg_total")))
    return (share_of_total(g, "trips", "pct_of_trips", 1)
            .orderBy(F.col("trips").desc(), "pickup_borough", "dropoff_borough").limit(n))


def run_date_lookup(daily: DataFrame, ds: str) -> DataFrame:
    """The run date's trips and fare revenue (zero or one row)."""
    return (daily.filter(F.col("revenue_date") == F.lit(ds).cast("date"))
                 .select("revenue_date", "total_trips", "total_fare"))
