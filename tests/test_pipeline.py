"""Layered run on disk: two batches, late month, rerun, gate."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from meterline.operators.checks import QualityGateError
from meterline.operators.incremental import read_table
from meterline.plans import fixtures as X
from meterline.plans import models as M

CFG = M.FIXTURE_CONFIG
LATE = "1997-01-01"


def batches(spark):
    raw1 = X.raw_trips(spark, SF001, "2024-01-01 00:00:00").filter(
        F.col("file_month") > F.lit(LATE).cast("date")).drop("l_orderkey", "l_linenumber")
    raw2 = X.raw_trips(spark, SF001, "2024-01-02 00:00:00").filter(
        F.col("file_month") == F.lit(LATE).cast("date")).drop("l_orderkey", "l_linenumber")
    return raw1, raw2


def ids(df):
    return sorted(r.trip_id for r in df.select("trip_id").collect())


@pytest.mark.parametrize("mode", ["_loaded_at", "pickup_datetime"])
def test_two_batches_late_month(spark, tmp_table_dir, mode):
    cfg = dataclasses.replace(CFG, fact_watermark_col=mode)
    tables = M.Tables(tmp_table_dir)
    seed = X.zone_seed(spark, SF001)
    raw1, raw2 = batches(spark)
    layers = ("staging", "intermediate", "marts")
    M.run_pipeline(spark, raw1, seed, tables, cfg, layers)
    M.run_pipeline(spark, raw2, seed, tables, cfg, layers)
    fct = spark.read.parquet(tables.fct)
    full = M.fact_trips(M.enrich_trips(M.stage_trips(raw1.unionByName(raw2)),
                                       M.stage_zones(seed), cfg))
    first_only = M.fact_trips(M.enrich_trips(M.stage_trips(raw1), M.stage_zones(seed), cfg))
    assert ids(spark.read.parquet(tables.int_trips)) == ids(full)
    if mode == "_loaded_at":
        assert ids(fct) == ids(full)               # late month admitted
    else:
        assert ids(fct) == ids(first_only)         # late month dropped (original behaviour)
    before = sorted(tuple(r) for r in spark.read.parquet(tables.daily).collect())
    M.run_pipeline(spark, raw2, seed, tables, cfg, layers)   # rerun: nothing changes
    assert ids(spark.read.parquet(tables.fct)) == ids(fct)
    assert sorted(tuple(r) for r in spark.read.parquet(tables.daily).collect()) == before


def test_full_refresh_and_gate(spark, tmp_table_dir):
    tables = M.Tables(tmp_table_dir)
    seed = X.zone_seed(spark, SF001)
    raw1, raw2 = batches(spark)
    with pytest.raises(QualityGateError) as e:
        M.run_pipeline(spark, raw1.unionByName(raw2), seed, tables, CFG, full_refresh=True)
    # the generated fares have discount > tax on many rows: only that rule fails
    assert "expression_holds" in str(e.value)
    res = M.model_checks(spark, M.stage_trips(raw1.unionByName(raw2)), M.stage_zones(seed), tables, CFG)
    assert res.count() == 22
    failing = {r.check for r in res.filter("status = 'fail'").collect()}
    assert failing == {"expression_holds"}
    zp = spark.read.parquet(tables.zone_perf)
    assert zp.count() == zp.select("zone_month_key").distinct().count()


def test_incremental_marts_equal_full_rebuild(spark, tmp_table_dir):
    """A reload moves every trip of one file month to another file month: the
    refreshed marts equal a rebuild from the final fact, and the emptied
    month leaves the zone mart."""
    cfg = dataclasses.replace(CFG, fact_watermark_col="_loaded_at")
    tables = M.Tables(tmp_table_dir)
    seed = X.zone_seed(spark, SF001)
    raw = X.raw_trips(spark, SF001, "2024-01-01 00:00:00").drop("l_orderkey", "l_linenumber")
    moved_from, moved_to = "1997-03-01", "1997-04-01"
    reload = (raw.filter(F.col("file_month") == F.lit(moved_from).cast("date"))
                 .withColumn("file_month", F.lit(moved_to).cast("date"))
                 .withColumn("source_file", F.lit("yellow_tripdata_1997-04.parquet"))
                 .withColumn("_loaded_at", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")))
    layers = ("staging", "intermediate", "marts")
    M.run_pipeline(spark, raw, seed, tables, cfg, layers)
    zp0 = spark.read.parquet(tables.zone_perf)
    assert zp0.filter(F.col("file_month") == F.lit(moved_from).cast("date")).count() > 0
    M.run_pipeline(spark, reload, seed, tables, cfg, layers)

    fct = spark.read.parquet(tables.fct)
    assert fct.filter(F.col("file_month") == F.lit(moved_from).cast("date")).count() == 0
    dim = spark.read.parquet(tables.dim)
    cols = ["zone_month_key", "file_month", "pickup_location_id", "borough", "zone_name",
            "total_trips", "avg_trip_distance", "avg_fare", "total_revenue", "revenue_rank",
            "is_high_volume_zone"]
    want_zp = sorted(tuple(r) for r in M.zone_performance(fct, dim, cfg.high_volume_trips)
                     .select(*cols).collect())
    got_zp = sorted(tuple(r) for r in spark.read.parquet(tables.zone_perf).select(*cols)
                    .collect())
    assert got_zp == want_zp
    dcols = ["revenue_date", "total_trips", "total_fare", "avg_fare", "total_tips",
             "tip_rate_pct"]
    want_d = sorted(tuple(r) for r in M.daily_revenue(fct).select(*dcols).collect())
    got_d = sorted(tuple(r) for r in spark.read.parquet(tables.daily).select(*dcols).collect())
    assert got_d == want_d


def test_incremental_marts_null_file_month(spark, tmp_table_dir):
    """Trips reloaded from a file name without a month (NULL file_month) and
    then from a proper file: the NULL zone-month group appears, then leaves."""
    cfg = dataclasses.replace(CFG, fact_watermark_col="_loaded_at")
    tables = M.Tables(tmp_table_dir)
    seed = X.zone_seed(spark, SF001)
    raw = X.raw_trips(spark, SF001, "2024-01-01 00:00:00").drop("l_orderkey", "l_linenumber")
    march = raw.filter(F.col("file_month") == F.lit("1997-03-01").cast("date"))

    def reload(month, name, stamp):
        return (march.withColumn("file_month", F.lit(month).cast("date"))
                     .withColumn("source_file", F.lit(name))
                     .withColumn("_loaded_at", F.lit(stamp).cast("timestamp_ntz")))

    def marts_match():
        fct = spark.read.parquet(tables.fct)
        dim = spark.read.parquet(tables.dim)
        cols = ["zone_month_key", "file_month", "pickup_location_id", "total_trips",
                "total_revenue", "revenue_rank"]
        want = sorted(M.zone_performance(fct, dim, cfg.high_volume_trips).select(*cols)
                      .collect(), key=repr)
        got = sorted(spark.read.parquet(tables.zone_perf).select(*cols).collect(), key=repr)
        assert got == want
        return sum(1 for r in got if r.file_month is None)

    layers = ("staging", "intermediate", "marts")
    M.run_pipeline(spark, raw, seed, tables, cfg, layers)
    M.run_pipeline(spark, reload(None, "yellow_tripdata_bad.parquet", "2024-01-02 00:00:00"),
                   seed, tables, cfg, layers)
    assert marts_match() > 0
    M.run_pipeline(spark, reload("1997-04-01", "yellow_tripdata_1997-04.parquet",
                                 "2024-01-03 00:00:00"), seed, tables, cfg, layers)
    assert marts_match() == 0


def test_empty_first_batch_builds_all_tables(spark, tmp_table_dir):
    tables, seed = M.Tables(tmp_table_dir), X.zone_seed(spark, SF001)
    raw1, raw2 = batches(spark)
    M.run_pipeline(spark, raw1.filter(F.lit(False)), seed, tables, CFG)     # all checks pass
    assert read_table(spark, tables.fct).count() == 0
    M.run_pipeline(spark, raw1, seed, tables, CFG, ("intermediate", "marts"))
    full = M.fact_trips(M.enrich_trips(M.stage_trips(raw1), M.stage_zones(seed), CFG))
    assert ids(read_table(spark, tables.fct)) == ids(full)
    assert len(M.staging_checks(M.stage_trips(raw1), M.stage_zones(seed), full)) == 4


def test_default_watermark_takes_late_months():
    assert M.PipelineConfig().fact_watermark_col == "_loaded_at"


def marts_of(spark, tables):
    return [sorted(map(repr, spark.read.parquet(t).drop("revenue_month").select(*cols).collect()))
            for t, cols in ((tables.daily, ["revenue_date", "total_trips", "total_fare", "tip_rate_pct"]),
                            (tables.zone_perf, ["zone_month_key", "total_trips", "total_revenue", "revenue_rank"]))]


def rebuilt(spark, tables, cfg):
    fct = read_table(spark, tables.fct)
    daily = M.daily_revenue(fct).select("revenue_date", "total_trips", "total_fare", "tip_rate_pct")
    zp = M.zone_performance(fct, spark.read.parquet(tables.dim), cfg.high_volume_trips).select(
        "zone_month_key", "total_trips", "total_revenue", "revenue_rank")
    return [sorted(map(repr, df.collect())) for df in (daily, zp)]


@pytest.mark.parametrize("broken", ["refresh_marts", "record_applied"])
def test_marts_heal_after_a_lost_run(spark, tmp_table_dir, monkeypatch, broken):
    """Die after the fact's write, or between the marts: the rerun equals a full
    rebuild."""
    tables, seed = M.Tables(tmp_table_dir), X.zone_seed(spark, SF001)
    raw1, raw2 = batches(spark)
    layers = ("staging", "intermediate", "marts")
    M.run_pipeline(spark, raw1, seed, tables, CFG, layers)

    def dies(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(M, broken, dies)
        with pytest.raises(RuntimeError):
            M.run_pipeline(spark, raw2, seed, tables, CFG, layers)
    stale = marts_of(spark, tables)
    M.run_pipeline(spark, raw2, seed, tables, CFG, layers)
    assert marts_of(spark, tables) == rebuilt(spark, tables, CFG)
    if broken == "refresh_marts":
        assert stale != rebuilt(spark, tables, CFG)


def test_marts_heal_after_a_lost_stream_batch(spark, tmp_table_dir, monkeypatch):
    from meterline.streaming.ingest import stream_trips
    tables, seed = M.Tables(tmp_table_dir + "/tables"), X.zone_seed(spark, SF001)
    glob = tmp_table_dir + "/landing/yellow_tripdata_*.parquet/*.parquet"

    def run(stamp):
        stream_trips(spark, glob, tmp_table_dir + "/raw", tmp_table_dir + "/checkpoint", stamp, seed, tables, CFG)

    X.write_month_files(spark, SF001, tmp_table_dir + "/landing", F.col("_file_ym") < "1997-06")
    run("2024-01-01 00:00:00")
    X.write_month_files(spark, SF001, tmp_table_dir + "/landing", F.col("_file_ym") >= "1997-06")

    def dies(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(M, "refresh_marts", dies)
        with pytest.raises(Exception, match="lost"):
            run("2024-01-02 00:00:00")
    run("2024-01-02 00:00:00")
    full = M.fact_trips(M.enrich_trips(M.stage_trips(X.raw_trips(spark, SF001)), M.stage_zones(seed), CFG))
    assert ids(read_table(spark, tables.fct)) == ids(full)
    assert marts_of(spark, tables) == rebuilt(spark, tables, CFG)


def test_a_half_written_first_mart_is_built_again(spark, tmp_table_dir, monkeypatch):
    tables, seed = M.Tables(tmp_table_dir), X.zone_seed(spark, SF001)
    raw1, _ = batches(spark)
    write = M._write_mart

    def half(mart, path, by, full):
        write(mart.limit(3), path, by, full)
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(M, "_write_mart", half)
        with pytest.raises(RuntimeError):
            M.run_pipeline(spark, raw1, seed, tables, CFG, ("intermediate", "marts"))
    M.run_pipeline(spark, raw1, seed, tables, CFG, ("intermediate", "marts"))
    assert marts_of(spark, tables) == rebuilt(spark, tables, CFG)
