"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each builds on the driver tables through the fixture views (see fixtures.py)
with the fixture parameters of ``FIXTURE_CONFIG``. ``oracle.py`` holds the
independent SQL for each name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.plans import fixtures as X
from meterline.plans import models as M
from meterline.plans import profile as P
from meterline.plans import reports as R

CFG = M.FIXTURE_CONFIG


# ------------------------------------------------------------------ shared views

def raw(spark, d):
    return X.raw_trips(spark, d)


def stg(spark, d, mode="boundary"):
    return M.stage_trips(raw(spark, d), mode)


def zones(spark, d, partial=False):
    return M.stage_zones(X.zone_seed(spark, d, partial))


def enriched(spark, d):
    return M.enrich_trips(stg(spark, d), zones(spark, d), CFG)


def fct(spark, d):
    return M.fact_trips(enriched(spark, d))


def zone_perf(spark, d):
    return M.zone_performance(fct(spark, d), M.dim_zones(zones(spark, d)),
                              CFG.high_volume_trips)


def event_fact(spark, d):
    return X.event_trips(spark, d)


# ------------------------------------------------------------------ queries

def q_idle_gaps(spark, d):
    return R.idle_gaps(event_fact(spark, d), zones(spark, d), k=5)


def q_idle_gaps_fact(spark, d):
    return R.idle_gaps(fct(spark, d), zones(spark, d), k=5)


def q_stage_trips(spark, d):
    return stg(spark, d)


def q_enriched_trips(spark, d):
    return enriched(spark, d)


def q_fact_trips(spark, d):
    """Two loads that share trips: the later load's copy of a trip stays."""
    first = batch(spark, d, LOAD_1, F.lit(True))
    again = batch(spark, d, LOAD_2, F.col("l_linenumber") >= 3).withColumn(
        "tip_amount", F.col("tip_amount") * F.lit(2.0))
    return M.fact_trips(M.enrich_trips(M.stage_trips(first.unionByName(again)),
                                       zones(spark, d), CFG))


def q_daily_revenue(spark, d):
    return M.daily_revenue(fct(spark, d))


def q_zone_month_performance(spark, d):
    return zone_perf(spark, d)



# ------------------------------------------------------------------ expressions

def files(spark, d):
    return X.trip_files(spark, d)


def event_pairs(spark, d):
    """Consecutive events as (start, end) pairs: sub-second durations."""
    e = X.table(spark, d, "events")
    a = e.select(F.col("event_id"), F.col("ts").alias("start_ts"))
    b = e.select((F.col("event_id") - 1).alias("event_id"), F.col("ts").alias("end_ts"))
    return a.join(b, "event_id")


def q_duration_boundary(spark, d):
    from meterline.functions.exprs import minutes_between
    return event_pairs(spark, d).select(
        "event_id", "start_ts", "end_ts",
        minutes_between("start_ts", "end_ts", "boundary").alias("minutes"))


def q_duration_fractional(spark, d):
    from meterline.functions.exprs import minutes_between
    return event_pairs(spark, d).select(
        "event_id", "start_ts", "end_ts",
        minutes_between("start_ts", "end_ts", "fractional").alias("minutes"))


def q_date_parts(spark, d):
    from meterline.functions.exprs import day_name
    e = event_fact(spark, d)
    ts = F.col("pickup_datetime")
    return e.select("trip_id", F.year(ts).alias("pickup_year"), F.month(ts).alias("pickup_month"),
                    F.hour(ts).alias("pickup_hour"), ts.cast("date").alias("pickup_date"),
                    day_name(ts).alias("day_name"))


def q_json_extract(spark, d):
    from meterline.functions.exprs import json_extract
    e = X.table(spark, d, "events")
    return e.select("event_id", json_extract(F.col("props"), "$.k", "int").alias("k"))


def q_json_fields(spark, d):
    """Several fields of nested rows, parsed once; every seventh is cut off."""
    from meterline.functions.exprs import json_fields
    e = X.table(spark, d, "events")
    text = F.concat(F.lit('{"a": '), F.col("props"), F.lit(', "b": ["x", '), F.col("event_id").cast("string"),
                    F.lit(']}'))
    rows = e.select("event_id", F.when(F.col("event_id") % 7 == 0, F.substring(text, 1, 9)).otherwise(text)
                    .alias("row"))
    return json_fields(rows, "row", {"k": ("$.a.k", "int"), "k_text": ("$.a.k", "string"),
                                     "id": ("$.b[1]", "bigint"), "x": ("$.b[0]", "string"),
                                     "no_number": ("$.b[0]", "int"), "missing": ("$.a.z", "double")}).drop("row")


def q_label_codes(spark, d):
    from meterline.functions.exprs import label
    return raw(spark, d).select(
        "l_orderkey", "l_linenumber", "payment_type",
        label("payment_type", R.PAYMENT_LABELS, "Other").alias("label"))


# ------------------------------------------------------------------ filters and joins

def q_clean_trips(spark, d):
    from meterline.operators.clean import clean
    return clean(stg(spark, d), CFG.rules())


def q_reject_reasons(spark, d):
    from meterline.operators.clean import rejects
    r = rejects(stg(spark, d), CFG.rules())
    return r.select("trip_id", F.array_join("reject_reasons", ",").alias("reject_reasons"))


def q_year_filter(spark, d):
    from meterline.functions.exprs import year_range
    return stg(spark, d).filter(year_range("pickup_datetime", CFG.trip_year)).select(
        "trip_id", "pickup_datetime")


def q_in_filter(spark, d):
    from meterline.operators.clean import in_set
    return in_set(raw(spark, d), "PULocationID", [1, 3, 5]).select(
        "l_orderkey", "l_linenumber", "PULocationID")


def q_left_join_dim(spark, d):
    from meterline.operators.joins import lookup
    return lookup(stg(spark, d), zones(spark, d, partial=True), "pickup_location_id",
                  "location_id", {"borough": "borough", "zone_name": "zone_name"}).select(
        "trip_id", "pickup_location_id", "borough", "zone_name")


def q_inner_join_dim(spark, d):
    from meterline.operators.joins import lookup
    return lookup(stg(spark, d), zones(spark, d, partial=True), "pickup_location_id",
                  "location_id", {"borough": "borough"}, how="inner").select(
        "trip_id", "pickup_location_id", "borough")


def q_enrich_two_roles(spark, d):
    return M.enrich_trips(stg(spark, d), zones(spark, d, partial=True), CFG)


def q_orphan_keys(spark, d):
    from meterline.operators.joins import orphans
    return orphans(stg(spark, d), "pickup_location_id", zones(spark, d, partial=True),
                   "location_id").select("trip_id", "pickup_location_id")


def q_borough_not_null(spark, d):
    from meterline.operators.clean import not_null
    f = M.enrich_trips(stg(spark, d), zones(spark, d, partial=True), CFG)
    return not_null(f, "pickup_borough", "dropoff_borough").select(
        "trip_id", "pickup_borough", "dropoff_borough")


# ------------------------------------------------------------------ marts and reports

def daily(spark, d):
    return M.daily_revenue(fct(spark, d))


def q_dim_zones(spark, d):
    return M.dim_zones(zones(spark, d))


def q_volume_by_month(spark, d):
    return R.volume_by_month(fct(spark, d))


def q_zone_all_time(spark, d):
    return R.zone_all_time(zone_perf(spark, d))


def q_run_date_lookup(spark, d):
    return R.run_date_lookup(daily(spark, d), RUN_DATE)


def q_payment_tipping(spark, d):
    return R.payment_tipping(fct(spark, d))


def q_borough_flow(spark, d):
    return R.borough_flow(fct(spark, d), 15)


def q_hour_of_day(spark, d):
    return R.hour_of_day(event_fact(spark, d))


def q_hour_profile(spark, d):
    """Timed pickups; the minute stands in for the duration."""
    timed = event_fact(spark, d).withColumn("trip_duration_minutes",
                                            F.minute("pickup_datetime").cast("bigint"))
    return R.hour_profile(timed)


def q_top_zones_by_revenue(spark, d):
    return R.top_zones_by_revenue(zone_perf(spark, d), 10)


def q_top_zones_month(spark, d):
    return R.top_zones_by_revenue(zone_perf(spark, d), 10, month=RUN_MONTH)


def q_top_zones_by_trips(spark, d):
    return R.top_zones_by_trips(zone_perf(spark, d), 15)


def q_dq_audit(spark, d):
    return R.dq_audit(raw(spark, d), CFG.trip_year)


# ------------------------------------------------------------------ profile

def q_row_range(spark, d):
    return P.row_range(files(spark, d))


def q_rows_per_year(spark, d):
    return P.rows_per_year(files(spark, d))


def q_null_profile(spark, d):
    return P.null_profile(files(spark, d))


def q_numeric_summary(spark, d):
    return P.numeric_summary(files(spark, d))


def q_quantiles(spark, d):
    return P.quantile_summary(files(spark, d))


def q_histogram(spark, d):
    return P.distance_histogram(files(spark, d), 0.0, 20.0, 40)


def q_payment_mix(spark, d):
    return P.payment_mix(files(spark, d))


def q_rate_code_mix(spark, d):
    return P.rate_code_mix(files(spark, d))


def q_value_counts(spark, d):
    return P.value_counts(files(spark, d))


def q_red_flags(spark, d):
    return P.red_flags(files(spark, d), CFG.trip_year, CFG.max_duration)


def q_borough_share(spark, d):
    return P.borough_share(files(spark, d), zones(spark, d))


def q_unknown_geography(spark, d):
    return P.unknown_geography(files(spark, d), zones(spark, d), UNKNOWN_IDS)


def q_trips_by_hour(spark, d):
    return P.trips_by_hour(event_fact(spark, d), "pickup_datetime")


def q_day_of_week(spark, d):
    return P.day_of_week(event_fact(spark, d), "pickup_datetime")


def q_tipping_by_type(spark, d):
    return P.tipping_by_type(files(spark, d))


# ------------------------------------------------------------------ incremental

def batch(spark, d, loaded_at, cond, rows=None):
    return X.raw_trips(spark, d, loaded_at, rows).filter(cond)


def q_dedupe_latest(spark, d):
    from meterline.operators.incremental import dedupe_latest
    r = raw(spark, d).select(
        "l_orderkey", "l_linenumber",
        (F.lit(X.BASE_LOADED_AT).cast("timestamp_ntz")
         + F.make_interval(days=(F.col("l_orderkey") % 3).cast("int"))).alias("_loaded_at"),
        "fare_amount", "tip_amount", "PULocationID", "tpep_pickup_datetime")
    return dedupe_latest(r, ["l_orderkey", "l_linenumber"], ["_loaded_at"])


def q_incremental_slice(spark, d):
    from meterline.operators.incremental import new_rows
    r = raw(spark, d)
    target = r.filter(F.col("file_month") <= F.lit(SLICE_MONTH).cast("date"))
    return new_rows(r, target, "tpep_pickup_datetime").select(
        "l_orderkey", "l_linenumber", "tpep_pickup_datetime")


def q_upsert_two_batches(spark, d):
    from meterline.operators.incremental import upsert_frame
    b1 = M.stage_trips(batch(spark, d, LOAD_1, F.col("l_linenumber") <= 4))
    b2 = M.stage_trips(batch(spark, d, LOAD_2, F.col("l_linenumber") >= 3)
                       .withColumn("tip_amount", F.col("tip_amount") * F.lit(2.0)))
    return upsert_frame(b1, b2, "trip_id")


def _late_month(spark, d, watermark_col):
    from meterline.operators.incremental import new_rows, stage, upsert_frame
    z, rows = zones(spark, d), X.staged_rows(spark, d)
    late = F.lit(LATE_MONTH).cast("date")
    first = M.enrich_trips(M.stage_trips(batch(spark, d, LOAD_1, F.col("file_month") > late, rows)),
                           z, CFG)
    second = M.enrich_trips(M.stage_trips(batch(spark, d, LOAD_2, F.col("file_month") == late, rows)),
                            z, CFG)
    fct1, _, _ = stage(spark, M.fact_trips(first), "late-fact")
    slice2 = new_rows(second, fct1, watermark_col)
    return upsert_frame(fct1, M.fact_trips(slice2), "trip_id")


def q_late_month_reference(spark, d):
    return _late_month(spark, d, "pickup_datetime")


def q_late_month_safe(spark, d):
    return _late_month(spark, d, "_loaded_at")


def q_schema_sync(spark, d):
    from meterline.operators.incremental import upsert_frame
    old = (M.stage_trips(batch(spark, d, LOAD_1, F.col("l_linenumber") <= 4))
           .drop("tip_amount").withColumn("vendor_note", F.lit("v1")))
    new = M.stage_trips(batch(spark, d, LOAD_2, F.col("l_linenumber") >= 3))
    return upsert_frame(old, new, "trip_id")


def q_touched_partitions(spark, d):
    from meterline.operators.joins import touched
    target = stg(spark, d)
    b = batch(spark, d, LOAD_2, F.col("file_month").isin(
        [F.lit(m).cast("date") for m in TOUCH_MONTHS]))
    return touched(target, b, ["file_month"]).select("trip_id", "file_month")


# ------------------------------------------------------------------ checks

def _check_results(spark, d):
    """All model tests over one staged fact; the dimension lacks five zones."""
    from meterline.operators import checks as C
    from meterline.operators.incremental import stage
    e, _, _ = stage(spark, enriched(spark, d), "check-enriched")
    f, _, _ = stage(spark, M.fact_trips(e), "check-fact")
    z = zones(spark, d, partial=True)
    dim = M.dim_zones(z)
    zp = M.zone_performance(f, dim, CFG.high_volume_trips)
    return C.check_counts(M.staging_checks(stg(spark, d), z, e)
                          + M.fact_checks(f, dim, M.daily_revenue(f), zp, CFG))


def q_check_suite(spark, d):
    return _check_results(spark, d)


def q_gate_findings(spark, d):
    """What the gate would stop on."""
    from meterline.operators import checks as C
    return C.findings(_check_results(spark, d)).select("check", "column_name", "failures")


def q_freshness_status(spark, d):
    """D6 on row stamps that differ, at four points in time, and on no rows."""
    from meterline.operators import checks as C
    r = event_fact(spark, d).select(F.date_trunc("second", "pickup_datetime")
                                     .cast("timestamp_ntz").alias("_loaded_at"))
    newest = r.agg(F.max("_loaded_at").alias("m")).first()["m"]
    out = None
    for case, hours in FRESHNESS_CASES.items():
        src = r.filter(F.lit(False)) if case == "empty" else r
        now = (newest + dt.timedelta(hours=hours)).isoformat(sep=" ")
        row = C.freshness(src, "_loaded_at", now, 36, 72).withColumn("case", F.lit(case))
        out = row if out is None else out.unionByName(row)
    return out


def q_month_presence(spark, d):
    from meterline.operators import checks as C
    return C.source_present(raw(spark, d), "file_month", RUN_DATE)


# ------------------------------------------------------------------ sources

def _landed_counts(spark, raw_path):
    r = spark.read.parquet(raw_path)
    return r.groupBy("source_file", "file_month", "_loaded_at").agg(
        F.count(F.lit(1)).alias("rows"))


def q_file_ingest(spark, d):
    """Three ledger runs: early months, then all months, then all again."""
    from meterline.session import scratch_path
    from meterline.sources.files import ingest_files
    base = scratch_path(spark, "file-ingest")
    paths = X.write_month_files(spark, d, f"{base}/landing")
    early = [p for p in paths if p.rsplit("_", 1)[-1][:7] < INGEST_CUTOFF]
    for run, (load, ps) in enumerate([(LOAD_1, early), (LOAD_2, paths), (LOAD_3, paths)]):
        ingest_files(spark, ps, f"{base}/raw", f"{base}/ledger", load)
    return _landed_counts(spark, f"{base}/raw")


def q_stream_ingest(spark, d):
    """availableNow runs as files arrive: early months, the rest, then nothing new."""
    from meterline.session import scratch_path
    from meterline.streaming.ingest import stream_ingest
    base = scratch_path(spark, "stream-ingest")
    glob = f"{base}/landing/yellow_tripdata_*.parquet/*.parquet"
    ckpt = f"{base}/checkpoint"
    X.write_month_files(spark, d, f"{base}/landing", F.col("_file_ym") < INGEST_CUTOFF)
    stream_ingest(spark, glob, f"{base}/raw", ckpt, LOAD_1)
    X.write_month_files(spark, d, f"{base}/landing", F.col("_file_ym") >= INGEST_CUTOFF)
    stream_ingest(spark, glob, f"{base}/raw", ckpt, LOAD_2)
    stream_ingest(spark, glob, f"{base}/raw", ckpt, LOAD_3)
    return _landed_counts(spark, f"{base}/raw")


def q_csv_dimension(spark, d):
    from meterline.session import scratch_path
    from meterline.sources.files import read_zone_csv
    path = scratch_path(spark, "zones-csv")
    X.zone_seed(spark, d).write.option("header", True).mode("overwrite").csv(path)
    return M.stage_zones(read_zone_csv(spark, path))


def q_ingest_same_stamp(spark, d):
    """Two loads with one stamp: the early months, then all months."""
    from meterline.session import scratch_path
    from meterline.sources.files import ingest_files
    base = scratch_path(spark, "same-stamp")
    paths = X.write_month_files(spark, d, f"{base}/landing")
    early = [p for p in paths if p.rsplit("_", 1)[-1][:7] < INGEST_CUTOFF]
    for ps in (early, paths):
        ingest_files(spark, ps, f"{base}/raw", f"{base}/ledger", LOAD_1)
    return _landed_counts(spark, f"{base}/raw")


def q_ingest_mixed_widths(spark, d):
    """One load over files that store ids and counts as 32-bit or double and
    files that store them as 64-bit integers."""
    from meterline.session import scratch_path
    from meterline.sources.files import RAW_COLUMNS, ingest_files
    base = scratch_path(spark, "widths")
    early = F.col("_file_ym") < INGEST_CUTOFF
    paths = (X.write_month_files(spark, d, f"{base}/landing", early)
             + X.write_month_files(spark, d, f"{base}/landing", ~early, wide=True))
    ingest_files(spark, paths, f"{base}/raw", f"{base}/ledger", LOAD_1)
    return spark.read.parquet(f"{base}/raw").select(*RAW_COLUMNS)


def q_historical_clean(spark, d):
    from meterline.plans.historical import process_historical
    from meterline.session import scratch_path
    base = scratch_path(spark, "historical")
    X.write_month_files(spark, d, f"{base}/landing")
    out = f"{base}/clean"
    process_historical(spark, f"{base}/landing/yellow_tripdata_{CFG.trip_year}-*.parquet", out,
                       CFG.trip_year, CFG.min_duration, CFG.max_duration)
    return spark.read.parquet(out)


def _safe_cfg():
    import dataclasses
    return dataclasses.replace(CFG, fact_watermark_col="_loaded_at")


def q_layered_run(spark, d):
    """M9 on disk: all months but one, then the late month; the zone mart."""
    from meterline.session import scratch_path
    tables = M.Tables(scratch_path(spark, "layered"))
    seed, rows = X.zone_seed(spark, d), X.staged_rows(spark, d)
    late = F.lit(LATE_MONTH).cast("date")
    layers = ("staging", "intermediate", "marts")
    M.run_pipeline(spark, batch(spark, d, LOAD_1, F.col("file_month") != late, rows), seed, tables,
                   _safe_cfg(), layers)
    M.run_pipeline(spark, batch(spark, d, LOAD_2, F.col("file_month") == late, rows), seed, tables,
                   _safe_cfg(), layers)
    return spark.read.parquet(tables.zone_perf)


def q_backfill_month(spark, d):
    """I8: the run date's monthly file through the models into fresh tables."""
    from meterline.plans.runs import backfill
    from meterline.session import scratch_path
    base = scratch_path(spark, "backfill")
    X.write_month_files(spark, d, f"{base}/landing")
    tables = M.Tables(f"{base}/tables")
    for _ in range(2):   # run twice: the second changes nothing
        backfill(spark, f"{base}/landing", RUN_DATE, X.zone_seed(spark, d), tables, CFG, LOAD_1)
    return spark.read.parquet(tables.fct).select(*M.ENRICHED_COLUMNS)


def q_stream_models(spark, d):
    """S7 -> I2 in foreachBatch: two availableNow runs as files arrive."""
    from meterline.session import scratch_path
    from meterline.streaming.ingest import stream_trips
    base = scratch_path(spark, "stream-models")
    glob = f"{base}/landing/yellow_tripdata_*.parquet/*.parquet"
    tables = M.Tables(f"{base}/tables")
    seed, rows = X.zone_seed(spark, d), X.staged_rows(spark, d)
    for load, cond in [(LOAD_1, F.col("_file_ym") >= STREAM_SPLIT),
                       (LOAD_2, F.col("_file_ym") < STREAM_SPLIT)]:
        X.write_month_files(spark, d, f"{base}/landing", cond, rows=rows)
        stream_trips(spark, glob, f"{base}/raw", f"{base}/checkpoint", load, seed, tables,
                     _safe_cfg())
    return spark.read.parquet(tables.fct).select(
        *[c for c in M.ENRICHED_COLUMNS if c != "_loaded_at"])


def q_idle_gaps_kept(spark, d):
    """Q3 from the kept gap table: all months but two, one of them, then the other,
    which lies before it."""
    from meterline.session import scratch_path
    tables, z = M.Tables(scratch_path(spark, "gaps")), zones(spark, d)
    rows, month = X.staged_rows(spark, d), F.col("file_month")
    second, late = (month == F.lit(m).cast("date") for m in (RUN_MONTH, LATE_MONTH))
    for load, cond in ((LOAD_1, ~second & ~late), (LOAD_2, second), (LOAD_3, late)):
        M.load_intermediate(spark, M.stage_trips(batch(spark, d, load, cond, rows)), z, tables, _safe_cfg())
        M.load_fact(spark, tables, _safe_cfg())
        M.refresh_gaps(spark, tables)
    return R.longest_gaps(M.kept_gaps(spark, tables), z, k=5)


def q_check_counts_kept(spark, d):
    """D1-D5 kept by month: the tests after a first run and after a later batch
    that reloads one month and adds another."""
    from meterline.operators import checks as C
    from meterline.session import scratch_path
    tables, z = M.Tables(scratch_path(spark, "kept-checks")), zones(spark, d, partial=True)
    rows, month = X.staged_rows(spark, d), F.col("file_month")
    late, again = (month == F.lit(m).cast("date") for m in (LATE_MONTH, RUN_MONTH))
    for load, cond in ((LOAD_1, ~late), (LOAD_2, late | again)):
        M.load_intermediate(spark, M.stage_trips(batch(spark, d, load, cond, rows)), z, tables, _safe_cfg())
        M.load_fact(spark, tables, _safe_cfg())
        counts = M.fact_counts(spark, tables, M.dim_zones(z), _safe_cfg())
        counts.write.format("noop").mode("overwrite").save()
    return C.check_counts([C.Counted(counts)])


class _Stop(Exception):
    """Thrown inside a micro-batch to stand for a lost driver."""


def q_stream_replay(spark, d):
    """The monthly files in about four micro-batches; the run dies in its third
    after the raw write and is started again with the same stamp."""
    from meterline.operators.incremental import read_table
    from meterline.session import scratch_path
    from meterline.sources.files import matching_paths
    from meterline.streaming.ingest import BATCH_COL, stream_ingest, stream_trips
    base = scratch_path(spark, "stream-replay")
    glob = f"{base}/landing/yellow_tripdata_*.parquet/*.parquet"
    tables, seed = M.Tables(f"{base}/tables"), X.zone_seed(spark, d)
    X.write_month_files(spark, d, f"{base}/landing")
    per_batch = max(1, len(matching_paths(spark, glob)) // REPLAY_BATCHES)

    def models_until(landed, batch_id):
        if batch_id == 2:
            raise _Stop("driver lost")
        M.run_pipeline(spark, landed.drop(BATCH_COL), seed, tables, CFG, ("intermediate", "marts"))

    try:
        stream_ingest(spark, glob, f"{base}/raw", f"{base}/checkpoint", LOAD_1, per_batch, models_until)
    except Exception as e:
        if "driver lost" not in str(e):
            raise
    stream_trips(spark, glob, f"{base}/raw", f"{base}/checkpoint", LOAD_1, seed, tables, CFG, per_batch)
    return read_table(spark, tables.fct).select(*[c for c in M.ENRICHED_COLUMNS if c != "_loaded_at"])


def q_marts_recovery(spark, d):
    """Both marts after a run that died between the fact's write and the marts
    and a later run with another batch."""
    from meterline.session import scratch_path
    tables, seed = M.Tables(scratch_path(spark, "recovery")), X.zone_seed(spark, d)
    rows, month = X.staged_rows(spark, d), F.col("file_month")
    lost = month == F.lit(RUN_MONTH).cast("date")
    last = month == F.lit(LATE_MONTH).cast("date")
    layers = ("staging", "intermediate", "marts")
    M.run_pipeline(spark, batch(spark, d, LOAD_1, ~lost & ~last, rows), seed, tables, _safe_cfg(), layers)
    M.load_intermediate(spark, M.stage_trips(batch(spark, d, LOAD_2, lost, rows)), zones(spark, d), tables,
                        _safe_cfg())
    M.load_fact(spark, tables, _safe_cfg())          # the driver is lost here
    M.run_pipeline(spark, batch(spark, d, LOAD_3, last, rows), seed, tables, _safe_cfg(), layers)
    daily_mart = spark.read.parquet(tables.daily).select(
        F.lit("daily").alias("mart"), F.col("revenue_date").cast("string").alias("grain"),
        F.col("total_trips").alias("trips"), F.col("total_fare").alias("amount"))
    return daily_mart.unionByName(spark.read.parquet(tables.zone_perf).select(
        F.lit("zone_month").alias("mart"), F.col("zone_month_key").alias("grain"),
        F.col("total_trips").alias("trips"), F.col("total_revenue").alias("amount")))


def _upserted(spark, d, name, *batches, **how):
    """Batches of staged trips, lying by month, through the on-disk upsert, by trip
    and month."""
    from meterline.operators.incremental import read_table, upsert
    from meterline.session import scratch_path
    path = scratch_path(spark, name)
    for i, b in enumerate(batches):
        upsert(spark, path, M.with_pickup_month(b), "trip_id", [M.PARTITION_COL],
               watermark_cols=M.WATERMARK_COLS, full_refresh=how.get("refresh") == i, clustered=True)
    return read_table(spark, path).drop(M.PARTITION_COL)


def _overlap(spark, d):
    rows = X.staged_rows(spark, d, by_month=True)
    first = M.stage_trips(batch(spark, d, LOAD_1, F.col("l_linenumber") <= 4, rows))
    second = M.stage_trips(batch(spark, d, LOAD_2, F.col("l_linenumber") >= 3, rows).withColumn(
        "tip_amount", F.col("tip_amount") * F.lit(2.0)))
    return first, second


def q_upsert_disk_overlap(spark, d):
    """I2 on disk: the batches share keys, and the second is run twice."""
    first, second = _overlap(spark, d)
    return _upserted(spark, d, "overlap", first, second, second)


def q_full_refresh(spark, d):
    """I4 on disk: a refresh leaves only its own rows."""
    first, second = _overlap(spark, d)
    return _upserted(spark, d, "refresh", first, second, refresh=1)


def q_schema_sync_disk(spark, d):
    """I5 on disk, three batches by month: the second adds a column, the third
    drops one; months that a batch does not touch are read back too."""
    rows, month = X.staged_rows(spark, d, by_month=True), F.col("file_month")
    first = M.stage_trips(batch(spark, d, LOAD_1, F.lit(True), rows)).withColumn("vendor_note", F.lit("v1"))
    second = (M.stage_trips(batch(spark, d, LOAD_2, month == F.lit(RUN_MONTH).cast("date"), rows))
              .withColumn("vendor_note", F.lit("v2")).withColumn("extra", F.lit(7)))
    third = (M.stage_trips(batch(spark, d, LOAD_3, (month == F.lit(RUN_MONTH).cast("date"))
                                 & (F.col("l_linenumber") == 1), rows))
             .withColumn("extra", F.lit(8)))
    return _upserted(spark, d, "sync", first, second, third)


def q_schema_rows(spark, d):
    """The columns and types of all trip files, the later ones with 64-bit
    numbers, by the files' footers."""
    from meterline.session import scratch_path
    from meterline.sources.files import file_columns
    base, rows = scratch_path(spark, "schema"), X.staged_rows(spark, d)
    early = F.col("_file_ym") < INGEST_CUTOFF
    paths = (X.write_month_files(spark, d, f"{base}/landing", early, rows=rows)
             + X.write_month_files(spark, d, f"{base}/landing", ~early, wide=True, rows=rows))
    return P.file_schema(file_columns(spark, paths))


def q_profile_kept(spark, d):
    """E4-E7 kept by file: first the early months but one, then all files; the
    second run reads only the files that are new to it."""
    from meterline.operators import kept_profile as K
    from meterline.session import scratch_path
    from meterline.sources.files import matching_paths
    base = scratch_path(spark, "kept-profile")
    landing, kept = f"{base}/landing", K.Kept(f"{base}/profile", P.KEPT_SPEC)
    month, run_month = F.col("_file_ym"), F.lit(RUN_MONTH[:7])
    X.write_month_files(spark, d, landing, (month < INGEST_CUTOFF) & (month != run_month))
    K.refresh(spark, kept, matching_paths(spark, f"{landing}/yellow_tripdata_*.parquet"))
    X.write_month_files(spark, d, landing, (month >= INGEST_CUTOFF) | (month == run_month), wide=True)
    K.refresh(spark, kept, matching_paths(spark, f"{landing}/yellow_tripdata_*.parquet"))
    return P.kept_profile_rows(spark, kept)


# Fixed parameters of the registered queries.
STREAM_SPLIT = "1997-06"
INGEST_CUTOFF = "1998-01"
LOAD_3 = "2024-01-03 00:00:00"
RUN_DATE = "1997-03-10"
RUN_MONTH = "1997-03-01"
SLICE_MONTH = "1996-12-01"
LATE_MONTH = "1997-01-01"
TOUCH_MONTHS = ["1996-05-01", "1997-02-01"]
UNKNOWN_IDS = (23, 24)
LOAD_1 = "2024-01-01 00:00:00"
LOAD_2 = "2024-01-02 00:00:00"
FRESHNESS_CASES = {"new": 36, "late": 37, "edge": 72, "stale": 73, "empty": 0}
REPLAY_BATCHES = 4

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "idle_gaps": q_idle_gaps,
    "idle_gaps_fact": q_idle_gaps_fact,
    "stage_trips": q_stage_trips,
    "enriched_trips": q_enriched_trips,
    "fact_trips": q_fact_trips,
    "daily_revenue": q_daily_revenue,
    "zone_month_performance": q_zone_month_performance,

    "duration_boundary": q_duration_boundary,
    "duration_fractional": q_duration_fractional,
    "date_parts": q_date_parts,
    "json_extract": q_json_extract,
    "json_fields": q_json_fields,
    "label_codes": q_label_codes,
    "clean_trips": q_clean_trips,
    "reject_reasons": q_reject_reasons,
    "year_filter": q_year_filter,
    "in_filter": q_in_filter,
    "left_join_dim": q_left_join_dim,
    "inner_join_dim": q_inner_join_dim,
    "enrich_two_roles": q_enrich_two_roles,
    "orphan_keys": q_orphan_keys,
    "borough_not_null": q_borough_not_null,
    "dim_zones": q_dim_zones,
    "volume_by_month": q_volume_by_month,
    "zone_all_time": q_zone_all_time,
    "run_date_lookup": q_run_date_lookup,
    "payment_tipping": q_payment_tipping,
    "borough_flow": q_borough_flow,
    "hour_of_day": q_hour_of_day,
    "hour_profile": q_hour_profile,
    "top_zones_by_revenue": q_top_zones_by_revenue,
    "top_zones_month": q_top_zones_month,
    "top_zones_by_trips": q_top_zones_by_trips,
    "dq_audit": q_dq_audit,
    "row_range": q_row_range,
    "rows_per_year": q_rows_per_year,
    "null_profile": q_null_profile,
    "numeric_summary": q_numeric_summary,
    "quantiles": q_quantiles,
    "histogram": q_histogram,
    "payment_mix": q_payment_mix,
    "rate_code_mix": q_rate_code_mix,
    "value_counts": q_value_counts,
    "red_flags": q_red_flags,
    "borough_share": q_borough_share,
    "unknown_geography": q_unknown_geography,
    "trips_by_hour": q_trips_by_hour,
    "day_of_week": q_day_of_week,
    "tipping_by_type": q_tipping_by_type,
    "dedupe_latest": q_dedupe_latest,
    "incremental_slice": q_incremental_slice,
    "upsert_two_batches": q_upsert_two_batches,
    "late_month_reference": q_late_month_reference,
    "late_month_safe": q_late_month_safe,
    "schema_sync": q_schema_sync,
    "touched_partitions": q_touched_partitions,
    "check_suite": q_check_suite,
    "freshness_status": q_freshness_status,
    "month_presence": q_month_presence,
    "file_ingest": q_file_ingest,
    "stream_ingest": q_stream_ingest,
    "csv_dimension": q_csv_dimension,
    "historical_clean": q_historical_clean,
    "layered_run": q_layered_run,
    "backfill_month": q_backfill_month,
    "stream_models": q_stream_models,
    "stream_replay": q_stream_replay,
    "marts_recovery": q_marts_recovery,
    "idle_gaps_kept": q_idle_gaps_kept,
    "check_counts_kept": q_check_counts_kept,
    "ingest_same_stamp": q_ingest_same_stamp,
    "ingest_mixed_widths": q_ingest_mixed_widths,
    "upsert_disk_overlap": q_upsert_disk_overlap,
    "full_refresh": q_full_refresh,
    "schema_sync_disk": q_schema_sync_disk,
    "schema_rows": q_schema_rows,
    "profile_kept": q_profile_kept,
    "gate_findings": q_gate_findings,
}
