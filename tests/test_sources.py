"""File landing: ledger and availableNow ingest, stream-fed models, backfill, CSV, M8."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from meterline.operators.incremental import read_table
from meterline.plans import catalog as C
from meterline.plans import fixtures as X
from meterline.plans import models as M
from meterline.plans.historical import process_historical
from meterline.plans.runs import backfill, month_available
from meterline.sources.files import (TRIP_FILE_SCHEMA, file_counts, file_name_of, ingest_files,
                                     matching_paths, read_months, read_trip_files, read_zone_csv)
from meterline.streaming.ingest import stream_ingest, stream_trips

CFG = dataclasses.replace(M.FIXTURE_CONFIG, fact_watermark_col="_loaded_at")


def counts(df):
    return sorted((r.source_file, r.rows) for r in file_counts(df).collect())


def expected(spark, months=None):
    rows = X.trip_file_rows(spark, SF001)
    if months is not None:
        rows = rows.filter(F.col("_file_ym").isin(months))
    return sorted((f"yellow_tripdata_{r._file_ym}.parquet", r.n) for r in
                  rows.groupBy("_file_ym").agg(F.count(F.lit(1)).alias("n")).collect())


def test_ledger_ingest_loads_each_file_once(spark, tmp_table_dir):
    paths = X.write_month_files(spark, SF001, tmp_table_dir + "/landing")
    raw, ledger = tmp_table_dir + "/raw", tmp_table_dir + "/ledger"
    first = ingest_files(spark, paths[:5], raw, ledger, "2024-01-01 00:00:00")
    assert first.count() == 5
    again = ingest_files(spark, paths[:5], raw, ledger, "2024-01-02 00:00:00")
    assert again.count() == 0
    ingest_files(spark, paths, raw, ledger, "2024-01-03 00:00:00")
    assert counts(spark.read.parquet(raw)) == expected(spark)


def test_ingest_rerun_after_lost_ledger_write(spark, tmp_table_dir):
    """The raw write committed but the ledger write did not: rerunning the
    load replaces its own files' rows, never doubles them."""
    paths = X.write_month_files(spark, SF001, tmp_table_dir + "/landing")
    raw, ledger = tmp_table_dir + "/raw", tmp_table_dir + "/ledger"
    ingest_files(spark, paths[:3], raw, ledger, "2024-01-01 00:00:00")
    ingest_files(spark, paths, raw, ledger, "2024-01-02 00:00:00")
    # Lose the second load's ledger entries, as if that write had failed.
    spark.read.parquet(ledger).filter("_loaded_at = '2024-01-01'").write.partitionBy(
        "source_file").parquet(tmp_table_dir + "/ledger2")
    ingest_files(spark, paths, raw, tmp_table_dir + "/ledger2", "2024-01-02 00:00:00")
    assert counts(spark.read.parquet(raw)) == expected(spark)


def test_two_loads_with_one_stamp_keep_both(spark, tmp_table_dir):
    paths = X.write_month_files(spark, SF001, tmp_table_dir + "/landing")
    raw, ledger = tmp_table_dir + "/raw", tmp_table_dir + "/ledger"
    for ps in (paths[:4], paths):
        ingest_files(spark, ps, raw, ledger, "2024-01-01 00:00:00")
    assert counts(spark.read.parquet(raw)) == expected(spark)
    assert spark.read.parquet(ledger).count() == len(paths)


def test_mixed_integer_widths_load_alike(spark, tmp_table_dir):
    early = F.col("_file_ym") < "1996-01"
    land = tmp_table_dir + "/landing"
    paths = (X.write_month_files(spark, SF001, land, early)
             + X.write_month_files(spark, SF001, land, ~early, wide=True))
    got = read_trip_files(spark, paths)
    assert got.drop("source_file").schema == TRIP_FILE_SCHEMA
    want = X.trip_files(spark, SF001)
    key = ["PULocationID", "passenger_count", "payment_type", "tolls_amount"]
    assert sorted(map(tuple, got.select(*key).collect()), key=repr) == sorted(
        map(tuple, want.select(*key).collect()), key=repr)


def test_missing_and_differently_cased_columns_read_as_declared(spark, tmp_table_dir):
    path = tmp_table_dir + "/yellow_tripdata_2023-01.parquet"
    spark.createDataFrame([(1, 2.5)], "vendorid bigint, Airport_fee double").write.parquet(path)
    row = read_trip_files(spark, path).first()
    assert (row["VendorID"], row["airport_fee"], row["fare_amount"]) == (1, 2.5, None)


def test_stream_replay_reaches_the_models(spark, tmp_table_dir):
    """A run dies in a middle batch and is started again with its stamp: no
    batch is lost to the models."""
    land, tables = tmp_table_dir + "/landing", M.Tables(tmp_table_dir + "/tables")
    seed = X.zone_seed(spark, SF001)
    files = X.write_month_files(spark, SF001, land)
    glob = land + "/yellow_tripdata_*.parquet/*.parquet"
    per_batch = -(-len(matching_paths(spark, glob)) // 4)
    assert len(files) >= 60
    args = (spark, glob, tmp_table_dir + "/raw", tmp_table_dir + "/ckpt",
            "2024-01-01 00:00:00")

    def dies(landed, batch_id):
        if batch_id == 2:
            raise RuntimeError("lost")
        M.run_pipeline(spark, landed.drop("_ingest_batch"), seed, tables, CFG, ("intermediate", "marts"))

    with pytest.raises(Exception):
        stream_ingest(*args, per_batch, dies)
    stream_trips(*args, seed, tables, CFG, per_batch)
    raw = spark.read.parquet(tmp_table_dir + "/raw")
    assert raw.select("_loaded_at").distinct().count() == raw.select("_ingest_batch").distinct().count() == 4
    full = M.fact_trips(M.enrich_trips(M.stage_trips(raw.drop("_ingest_batch")), M.stage_zones(seed), CFG))
    got = sorted(r.trip_id for r in read_table(spark, tables.fct).select("trip_id").collect())
    assert got == sorted(r.trip_id for r in full.select("trip_id").collect()) and len(got) > 0


def test_stream_ingest_exactly_once(spark, tmp_table_dir):
    land = tmp_table_dir + "/landing"
    glob = land + "/yellow_tripdata_*.parquet/*.parquet"
    raw, ckpt = tmp_table_dir + "/raw", tmp_table_dir + "/ckpt"
    X.write_month_files(spark, SF001, land, F.col("_file_ym") < "1996-01")
    stream_ingest(spark, glob, raw, ckpt, "2024-01-01 00:00:00", max_files_per_trigger=7)
    stream_ingest(spark, glob, raw, ckpt, "2024-01-02 00:00:00")        # nothing new
    X.write_month_files(spark, SF001, land, F.col("_file_ym") >= "1996-01")
    stream_ingest(spark, glob, raw, ckpt, "2024-01-03 00:00:00")
    df = spark.read.parquet(raw)
    assert counts(df) == expected(spark)
    # one distinct stamp per micro-batch, strictly increasing with the batch id
    stamps = sorted((r._ingest_batch, r._loaded_at) for r in
                    df.select("_ingest_batch", "_loaded_at").distinct().collect())
    assert [s for _, s in stamps] == sorted(s for _, s in stamps)
    assert len({s for _, s in stamps}) == len(stamps)


def test_stream_fed_models_match_full_refresh(spark, tmp_table_dir):
    land = tmp_table_dir + "/landing"
    glob = land + "/yellow_tripdata_*.parquet/*.parquet"
    tables = M.Tables(tmp_table_dir + "/tables")
    seed = X.zone_seed(spark, SF001)
    X.write_month_files(spark, SF001, land, F.col("_file_ym") >= "1997-02")
    stream_trips(spark, glob, tmp_table_dir + "/raw", tmp_table_dir + "/ckpt",
                 "2024-01-01 00:00:00", seed, tables, CFG)
    X.write_month_files(spark, SF001, land, F.col("_file_ym") < "1997-02")   # late months
    stream_trips(spark, glob, tmp_table_dir + "/raw", tmp_table_dir + "/ckpt",
                 "2024-01-02 00:00:00", seed, tables, CFG)
    full = M.fact_trips(M.enrich_trips(M.stage_trips(X.raw_trips(spark, SF001)),
                                       M.stage_zones(seed), CFG))
    got = sorted(r.trip_id for r in spark.read.parquet(tables.fct).select("trip_id").collect())
    assert got == sorted(r.trip_id for r in full.select("trip_id").collect())


def test_backfill_and_month_available(spark, tmp_table_dir):
    land = tmp_table_dir + "/landing"
    X.write_month_files(spark, SF001, land, F.col("_file_ym") == "1997-03")
    assert month_available(spark, land, "1997-03-10")
    assert not month_available(spark, land, "1997-04-10")
    tables = M.Tables(tmp_table_dir + "/tables")
    seed = X.zone_seed(spark, SF001)
    backfill(spark, land, "1997-03-10", seed, tables, CFG, "2024-01-01 00:00:00")
    n = spark.read.parquet(tables.fct).count()
    backfill(spark, land, "1997-03-31", seed, tables, CFG, "2024-01-05 00:00:00")   # rerun
    assert spark.read.parquet(tables.fct).count() == n > 0
    with pytest.raises(FileNotFoundError):
        backfill(spark, land, "1997-04-01", seed, tables, CFG, "2024-01-06 00:00:00")


def test_read_months_provenance(spark, tmp_table_dir):
    land = tmp_table_dir + "/landing"
    X.write_month_files(spark, SF001, land, F.col("_file_ym").isin("1996-01", "1996-02"))
    df = read_months(spark, land, "1996-01,1996-02")
    assert sorted(r.source_file for r in df.select("source_file").distinct().collect()) == [
        "yellow_tripdata_1996-01.parquet", "yellow_tripdata_1996-02.parquet"]


def test_file_name_of_paths(spark):
    df = spark.createDataFrame([("file:/a/b/yellow_tripdata_2023-01.parquet",),
                                ("file:/a/yellow_tripdata_2023-02.parquet/part-0000-x.snappy.parquet",),
                                ("file:/a/b/other.parquet",)], "p string")
    got = [r.n for r in df.select(file_name_of(F.col("p")).alias("n")).collect()]
    assert got == ["yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-02.parquet",
                   "other.parquet"]


def test_zone_csv_keeps_na_text(spark, tmp_table_dir):
    path = tmp_table_dir + "/zones"
    spark.createDataFrame([(264, "Unknown", "N/A", "N/A"), (1, "EWR", "Newark Airport", "EWR")],
                          "LocationID int, Borough string, Zone string, service_zone string") \
        .write.option("header", True).csv(path)
    z = {r.LocationID: r for r in read_zone_csv(spark, path).collect()}
    assert z[264].Zone == "N/A" and z[264].service_zone == "N/A"


def test_historical_counts_rows_once(spark, tmp_table_dir):
    land = tmp_table_dir + "/landing"
    X.write_month_files(spark, SF001, land)
    n = process_historical(spark, land + "/yellow_tripdata_1997-*.parquet", tmp_table_dir + "/out",
                           1997, CFG.min_duration, CFG.max_duration)
    out = spark.read.parquet(tmp_table_dir + "/out")
    assert out.count() == n
    assert {r.pickup_year for r in out.select("pickup_year").distinct().collect()} <= {1997}


def test_small_dimension_is_broadcast_without_a_hint(spark):
    df = C.q_left_join_dim(spark, SF001)
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from meterline.session import shared_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn", setCheckpointDir=lambda d: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError):
        shared_dir(fake)


def test_rebalanced_writes_cut_heavy_months_and_join_small_ones(spark, tmp_table_dir):
    """A month with most rows becomes several files, each small one a single one."""
    from meterline.sources.files import rebalanced, write_partitioned
    rows = spark.range(0, 300_000, 1, 8).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("x"),
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 40).alias("m"))
    how = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m", "spark.sql.shuffle.partitions": "200"}
    before = {k: spark.conf.get(k) for k in how}
    for k, v in how.items():
        spark.conf.set(k, v)
    try:
        write_partitioned(rows, tmp_table_dir + "/t", ["m"])
        assert "REBALANCE_PARTITIONS_BY_COL" in rebalanced(rows, ["m"])._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {}
    for f in spark.read.parquet(tmp_table_dir + "/t").inputFiles():
        m = int(f.split("/m=")[1].split("/")[0])
        files[m] = files.get(m, 0) + 1
    # Only a month that shares the heavy one's hash partition may be cut with it.
    assert files[0] > 2 and len(files) == 40 and sum(n > 1 for n in files.values()) <= 3
    assert spark.read.parquet(tmp_table_dir + "/t").count() == 300_000


def test_footer_catalogue_groups_files_and_reads_one_of_each(spark, tmp_table_dir, monkeypatch):
    from pyspark.sql import DataFrameReader

    from meterline.sources.files import file_columns, file_groups
    paths = []
    for i in range(6):
        kind = "bigint" if i == 4 else "int"
        paths.append(f"{tmp_table_dir}/f/yellow_tripdata_2023-0{i + 1}.parquet")
        spark.range(3).select(F.col("id").cast(kind).alias("PULocationID"), F.lit("y").alias("flag")) \
             .write.parquet(paths[-1])
    opened, parquet = [], DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *a, **k: (opened.append(a), parquet(self, *a, **k))[1])
    groups = file_groups(spark, paths)
    assert [len(same) for _, same in groups] == [5, 1] and len(opened) == 2
    odd = {r.source_file for r in file_columns(spark, paths).collect() if r.column_type == "bigint"}
    assert odd == {"yellow_tripdata_2023-05.parquet"}
    assert file_groups(spark, []) == [] and read_trip_files(spark, []).count() == 0
