"""Physical-plan properties the design relies on."""

import pytest

from tests.conftest import SF001, SF01
from meterline.plans import catalog as C


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_idle_gaps_plan(spark):
    p = plan(C.q_idle_gaps(spark, SF01))
    assert "WindowGroupLimit" in p                      # top-k cut before the per-zone shuffle
    assert "BroadcastHashJoin" in p                     # zone names from the small dimension
    # Two columns of the staged input, no more.
    assert "ReadSchema: struct<pickup_location_id:bigint,pickup_datetime:timestamp_ntz>" in p


def test_year_rule_reaches_scan(spark):
    p = plan(C.q_enriched_trips(spark, SF01))
    # rules on trip columns land on the scans of the tables they come from
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in p
    assert "GreaterThan(l_extendedprice,0.0)" in p
    assert "GreaterThan(p_size,0)" in p


def test_file_month_is_read_from_the_name_once(spark):
    """every staged row went through the pattern twice and a date format."""
    p = plan(C.q_stage_trips(spark, SF01))
    assert p.count("regexp_extract(") == 1 and "try_to_date" not in p


def test_dedupe_is_partial_aggregate(spark):
    p = plan(C.q_dedupe_latest(spark, SF01))
    assert "partial_max" in p and "Window" not in p


def test_zone_performance_aggregates_before_join(spark):
    p = plan(C.q_zone_month_performance(spark, SF01))
    j = p.index("BroadcastHashJoin [pickup_location_id")
    assert p.index("HashAggregate", j) > j              # the aggregate is below the join


def test_lag_reads_its_input_once(spark):
    """Sizing, rows and carry read the staged columns, not the fact's chain."""
    p = plan(C.q_idle_gaps_fact(spark, SF01))
    assert "lineitem" not in p and p.count("FileScan parquet") <= 4


def test_dedupe_holds_each_column_once(spark):
    p = plan(C.q_dedupe_latest(spark, SF01))
    # Once read, once in the partial and once in the final aggregate's struct.
    struct = p[p.index("partial_max(") + len("partial_max("):]
    assert struct[:struct.index(")]")].count("fare_amount") == 1


def test_incremental_slices_prune_partitions(spark, tmp_table_dir):
    """The fact's slice and the zone mart's source read only the months that
    the late batch touched."""
    from pyspark.sql import functions as F

    from meterline.operators.incremental import in_partitions, partitions_with, read_table
    from meterline.plans import fixtures as X
    from meterline.plans import models as M
    tables, seed = M.Tables(tmp_table_dir), X.zone_seed(spark, SF001)
    late = F.col("file_month") == F.lit("1997-03-01").cast("date")
    raw = X.raw_trips(spark, SF001, "2024-01-01 00:00:00").drop("l_orderkey", "l_linenumber")
    again = X.raw_trips(spark, SF001, "2024-01-02 00:00:00").drop("l_orderkey", "l_linenumber")
    M.run_pipeline(spark, raw, seed, tables, C.CFG, ("intermediate", "marts"))
    M.run_pipeline(spark, again.filter(late), seed, tables, C.CFG, ("intermediate",))
    sliced = M.fact_slice(spark, read_table(spark, tables.int_trips), read_table(spark, tables.fct),
                          tables, C.CFG)
    p = plan(sliced)
    filters = p[p.index("PartitionFilters: ["):].split("]")[0]
    assert "1997-03-01" in filters or "pickup_month" in filters
    assert {r[0].isoformat() for r in sliced.select("pickup_month").distinct().collect()} == {"1997-03-01"}
    import datetime as dt
    parts = partitions_with(spark, tables.fct, [dt.date(1997, 3, 1)])
    assert parts == ["1997-03-01"]
    zone_source = read_table(spark, tables.fct).filter(in_partitions("pickup_month", "date", parts))
    assert "PartitionFilters: [isnotnull" in plan(zone_source)


@pytest.mark.parametrize("name", ["upsert_disk_overlap", "idle_gaps_kept", "marts_recovery",
                                  "late_month_safe", "late_month_reference", "schema_sync_disk",
                                  "stream_models", "check_counts_kept", "layered_run", "schema_rows",
                                  "full_refresh"])
def test_batches_of_one_source_join_it_once(spark, monkeypatch, name):
    """Every batch, and every use of one, joined the tables again."""
    from meterline.plans import fixtures as X
    joined, source = [], X.source_rows
    monkeypatch.setattr(X, "source_rows", lambda *a: joined.append(1) or source(*a))
    C.QUERIES[name](spark, SF001)
    assert len(joined) == 1
