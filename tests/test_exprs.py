from pyspark.sql import functions as F

"""Expression semantics: minute boundaries, rounding, keys, file names."""

import datetime as dt


from meterline.functions import exprs as X


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_minute_edge_boundary_and_fractional(spark):
    rows = [(ts("2023-01-01 10:00:45"), ts("2023-01-01 10:01:15")),   # crosses a minute mark
            (ts("2023-01-01 10:00:00"), ts("2023-01-01 10:00:00")),   # equal
            (ts("2023-01-01 10:05:00"), ts("2023-01-01 10:00:30")),   # dropoff before pickup
            (ts("2023-01-01 10:00:00.900000"), ts("2023-01-01 10:00:01.100000")),
            (None, ts("2023-01-01 10:00:00"))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    out = df.select(X.minutes_between("a", "b", "boundary").alias("m"),
                    X.minutes_between("a", "b", "fractional").alias("f")).collect()
    assert [r.m for r in out] == [1, 0, -5, 0, None]
    assert [r.f for r in out] == [0.5, 0.0, -4.5, 1 / 60, None]


def test_round_half_away(spark):
    df = spark.createDataFrame([(51921.995,), (-51921.995,), (2.5,), (-2.5,), (0.125,), (None,)],
                               "x double")
    got = [r.r for r in df.select(X.round_half_away("x", 2).alias("r")).collect()]
    assert got == [51922.0, -51922.0, 2.5, -2.5, 0.13, None]
    got0 = [r.r for r in df.select(X.round_half_away("x", 0).alias("r")).collect()]
    assert got0[2:4] == [3.0, -3.0]


def test_exact_sum_is_order_independent(spark):
    vals = [0.1] * 10 + [1e15, -1e15]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(1).agg(X.exact_sum("x").alias("s")).first().s
    b = df.repartition(7).agg(X.exact_sum("x").alias("s")).first().s
    assert a == b == 1.0


def test_surrogate_key_null_parts(spark):
    schema = "a int, b double, c timestamp_ntz"
    rows = [(1, 2.5, ts("2023-01-01 00:00:00")), (None, 2.5, ts("2023-01-01 00:00:00")),
            (1, None, ts("2023-01-01 00:00:00")), (1, 2.5, None), (None, None, None)]
    df = spark.createDataFrame(rows, schema)
    keys = [r.k for r in df.select(X.surrogate_key(df.schema, ["a", "b", "c"]).alias("k")).collect()]
    assert all(k is not None for k in keys)
    assert len(set(keys)) == 5
    import hashlib
    assert keys[4] == hashlib.md5(b"||").hexdigest()
    assert keys[0] == hashlib.md5(b"1|2500000|2023-01-01 00:00:00.000000").hexdigest()


def test_grain_key_null_in_null_out(spark):
    df = spark.createDataFrame([(1, dt.date(2023, 1, 1)), (None, dt.date(2023, 1, 1))],
                               "id int, m date")
    got = [r.k for r in df.select(X.grain_key(df.schema, ["id", "m"]).alias("k")).collect()]
    import hashlib
    assert got[0] == hashlib.md5(b"1|2023-01-01").hexdigest()
    assert got[1] is None


def test_month_from_file_names(spark):
    names = ["yellow_tripdata_2023-01.parquet", "yellow_tripdata.parquet",
             "yellow_tripdata_2023-99.parquet", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.m for r in df.select(X.month_from_name("n").alias("m")).collect()]
    assert got == [dt.date(2023, 1, 1), None, None, None]


def test_label_default_and_null(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (None,)], "p int")
    got = [r.l for r in df.select(X.label("p", {1: "Credit card", 2: "Cash"}, "Other")
                                  .alias("l")).collect()]
    assert got == ["Credit card", "Cash", "Other", "Other"]


def test_json_extract(spark):
    df = spark.createDataFrame([('{"k": 69}',), ('{"k": "x"}',), ("not json",), (None,),
                                ('{"a": {"b": 2.5}}',)], "j string")
    out = df.select(X.json_extract("j", "$.k", "int").alias("k"),
                    X.json_extract("j", "$.a.b", "double").alias("b")).collect()
    assert [r.k for r in out] == [69, None, None, None, None]
    assert out[4].b == 2.5


def test_day_name_and_year_range(spark):
    df = spark.createDataFrame([(ts("2023-01-01 12:00:00"),), (ts("2024-01-01 00:00:00"),),
                                (ts("2022-12-31 23:59:59.999999"),)], "t timestamp_ntz")
    out = df.select(X.day_name("t").alias("d"), X.year_range("t", 2023).alias("y")).collect()
    assert [r.d for r in out] == ["Sunday", "Monday", "Saturday"]
    assert [r.y for r in out] == [True, False, False]


def test_pct_zero_total(spark):
    df = spark.createDataFrame([(5, 0), (5, 10), (None, 10)], "a bigint, b bigint")
    got = [r.p for r in df.select(X.pct("a", "b").alias("p")).collect()]
    assert got == [None, 50.0, None]


def test_nan_and_infinity_carry_through_sums_and_means(spark):
    from meterline.functions.exprs import exact_avg, exact_sum
    nan, inf = float("nan"), float("inf")
    rows = [("n", 1.0), ("n", nan), ("i", 1.0), ("i", inf), ("b", inf), ("b", -inf), ("z", None),
            ("f", 0.1), ("f", 0.2), ("f", None), ("big", 1e30), ("big", 1.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: (r.s, r.a, r.p) for r in df.groupBy("k").agg(
        exact_sum("x").alias("s"), exact_avg("x").alias("a"), F.avg("x").alias("p")).collect()}
    assert all(v != v for v in got["n"]) and got["i"] == (inf, inf, inf)
    assert all(v != v for v in got["b"]) and got["z"] == (None, None, None)
    assert got["f"][0] == 0.3 and got["f"][1] == 0.15
    assert got["big"][0] == 1e30


def test_large_doubles_round_to_themselves_and_keep_apart_in_keys(spark):
    import math
    from meterline.functions.exprs import round_half_away, surrogate_key
    values = [1e13, 2e13, 1e17, -1e17, 1e300, float("nan"), float("inf"), -float("inf"), 0.0, None, 1.005, 2.5, 4e12]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    for v, g in zip(values[:8], got):
        assert g == v or (math.isnan(v) and math.isnan(g))
    assert got[8:] == [0.0, None, 1.0, 2.5, 4e12]     # 1.005 is just below 1.005
    keys = [r[0] for r in df.select(surrogate_key(df.schema, ["x"])).collect()]
    assert len(set(keys)) == len(values)
    import hashlib
    assert keys[8] == hashlib.md5(b"0").hexdigest() and keys[12] == hashlib.md5(b"4000000000000000000").hexdigest()


def test_json_fields_parse_once(spark):
    from meterline.functions.exprs import json_fields
    rows = ['{"a": {"b": [1, {"c": "x"}]}, "n": 2.5}', '{"a": ', None, "[1]", '{"n": "text"}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, j string")
    out = json_fields(df, "j", {"c": ("$.a.b[1].c", "string"), "first": ("$.a.b[0]", "int"), "n": ("$.n", "double")})
    assert [tuple(r)[2:] for r in out.orderBy("id").collect()] == [
        ("x", 1, 2.5), (None, None, None), (None, None, None), (None, None, None), (None, None, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parsejson") <= 1
