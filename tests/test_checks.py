"""Each check on a passing and a failing fixture; freshness boundaries; the gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.operators import checks as C

NOW = "2024-01-10 12:00:00"


def test_not_null_unique(spark):
    ok = spark.createDataFrame([(1,), (2,)], "k int")
    bad = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert C.not_null(ok, "k").count() == 0 and C.not_null(bad, "k").count() == 2
    assert C.unique(ok, "k").count() == 0
    assert [tuple(r) for r in C.unique(bad, "k").collect()] == [(1, 2)]   # NULLs ignored


def test_relationships_zone_sentinels(spark):
    zones = spark.createDataFrame([(1, "Manhattan"), (264, "Unknown"), (265, "N/A")],
                                  "location_id int, borough string")
    trips = spark.createDataFrame([(1,), (264,), (265,), (999,), (None,)], "pu int")
    bad = C.relationships(trips, "pu", zones, "location_id").collect()
    assert [r.pu for r in bad] == [999]


def test_value_within_range_null_passes(spark):
    df = spark.createDataFrame([(0,), (1,), (180,), (181,), (None,)], "d int")
    assert sorted(r.d for r in C.value_within_range(df, "d", 1, 180).collect()) == [0, 181]


def test_expression_holds(spark):
    df = spark.createDataFrame([(10.0, 9.0), (10.0, 10.0), (10.0, 11.0)], "fare double, total double")
    assert C.expression_holds(df, F.col("total") < F.col("fare")).count() == 1


@pytest.mark.parametrize("hours,status", [(35, "pass"), (36, "pass"), (37, "warn"),
                                          (71, "warn"), (72, "warn"), (73, "error")])
def test_freshness_ages(spark, hours, status):
    now = dt.datetime.fromisoformat(NOW)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "t timestamp_ntz")
    r = C.freshness(df, "t", NOW).first()
    assert r.status == status and r.age_hours == hours


def test_freshness_empty_table(spark):
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert C.freshness(df, "t", NOW).first().status == "error"


def test_source_present(spark):
    df = spark.createDataFrame([(dt.date(2023, 3, 1),)], "m date")
    assert C.source_present(df, "m", "2023-03-15").first().present is True
    assert C.source_present(df, "m", "2023-04-15").first().present is False


def test_check_counts_and_gate(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    res = C.check_counts([C.Check("not_null", "t.k", C.not_null(df, "k")),
                          C.Check("unique", "t.k", C.unique(df, "k"))])
    got = {(r.check, r.failures, r.status) for r in res.collect()}
    assert got == {("not_null", 1, "fail"), ("unique", 1, "fail")}
    with pytest.raises(C.QualityGateError):
        C.gate(res)
    ok = C.check_counts([C.Check("not_null", "t.k", C.not_null(df.dropna(), "k"))])
    assert C.gate(ok).count() == 1


def test_kept_counts_equal_a_full_run(spark):
    from meterline.operators import checks as C
    rows = [("p", 1, "a", 5.0), ("p", 1, "a", -1.0), ("p", 2, "b", None), ("q", 3, None, 9.0), ("q", 4, "z", 2.0),
            ("q", None, "z", -3.0), (None, 9, "b", 1.0), (None, 9, "y", 1.0), (None, 9, "y", 1.0)]
    df = spark.createDataFrame(rows, "part string, id int, zone string, fare double")
    dim = spark.createDataFrame([("a",), ("b",)], "zone string")
    rules = {("not_null", "fare"): C.null_rule("fare"), ("range", "fare"): C.range_rule("fare", 0, 8),
             ("not_null", "part"): F.lit(False)}
    kept = C.partition_counts(df, "part", rules, [("id", "id")], [("zone", "zone")])
    names = [*rules, ("unique", "id"), ("relationships", "zone")]
    got = {(r["check"], r["column_name"]): r["failures"]
           for r in C.check_counts([C.Counted(C.kept_counts(kept, names, {"zone": (dim, "zone")}))]).collect()}
    full = {(r["check"], r["column_name"]): r["failures"] for r in C.check_counts([
        C.RowChecks(df, rules), C.Check("unique", "id", C.unique(df, "id")),
        C.Check("relationships", "zone", C.relationships(df, "zone", dim, "zone"))]).collect()}
    assert got == full and full["relationships", "zone"] == 4 and full["unique", "id"] == 2
    empty = C.kept_counts(C.partition_counts(df.limit(0), "part", rules, [("id", "id")], [("zone", "zone")]), names, {})
    assert {r["failures"] for r in empty.collect()} == {0}


def test_a_gate_after_one_month_reads_that_month(spark, tmp_table_dir, monkeypatch):
    from meterline.operators import checks as C
    from meterline.plans import catalog as Q
    from meterline.plans import fixtures as X
    from meterline.plans import models as M
    from tests.conftest import SF001
    tables, z = M.Tables(tmp_table_dir), Q.zones(spark, SF001, partial=True)
    seen, counts = [], C.partition_counts
    monkeypatch.setattr(C, "partition_counts", lambda rows, *a: (seen.append(rows), counts(rows, *a))[1])
    month = F.col("file_month") == F.lit("1997-03-01").cast("date")
    for rows, load in ((~month, Q.LOAD_1), (month, Q.LOAD_2)):
        M.load_intermediate(spark, M.stage_trips(X.raw_trips(spark, SF001, load).filter(rows)), z, tables, M.FIXTURE_CONFIG)
        M.load_fact(spark, tables, M.FIXTURE_CONFIG)
        M.refresh_gaps(spark, tables)
        for _ in range(2):      # a second call finds nothing to count
            M.fact_counts(spark, tables, M.dim_zones(z), M.FIXTURE_CONFIG).collect()
    assert len(seen) == 2
    plan = seen[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in plan or "1997-03-01" in plan.split("PartitionFilters")[1][:120]
    # Other limits start the counts anew.
    import dataclasses
    M.fact_counts(spark, tables, M.dim_zones(z), dataclasses.replace(M.FIXTURE_CONFIG, max_duration=10)).collect()
    assert len(seen) == 3 and "1997-03-01" not in seen[2]._jdf.queryExecution().executedPlan().toString()
