"""Dedupe, high-water marks, upsert (lazy and on disk), column sync."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.operators import incremental as I

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 1, 2)
SCHEMA = "trip_id string, pickup timestamp_ntz, tip double, _loaded_at timestamp_ntz, m date"


def jan(d):
    return dt.datetime(2023, 1, d)


def test_dedupe_within_and_across_loads(spark):
    rows = [("a", jan(1), 1.0, T1, dt.date(2023, 1, 1)),
            ("a", jan(1), 3.0, T1, dt.date(2023, 1, 1)),   # same load, bigger tip wins tie
            ("b", jan(2), 5.0, T1, dt.date(2023, 1, 1)),
            ("b", jan(2), 2.0, T2, dt.date(2023, 1, 1)),   # later load wins
            ("c", jan(3), 1.0, None, dt.date(2023, 1, 1)),  # NULL load time counts as largest
            ("c", jan(3), 9.0, T2, dt.date(2023, 1, 1)),
            (None, jan(4), 1.0, T1, dt.date(2023, 1, 1)),
            (None, jan(4), 2.0, T1, dt.date(2023, 1, 1))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.trip_id: r.tip for r in I.dedupe_latest(df, "trip_id").collect()}
    assert got == {"a": 3.0, "b": 2.0, "c": 1.0, None: 2.0}


def test_dedupe_hot_key(spark):
    rows = [("hot", jan(1), float(i), T1, dt.date(2023, 1, 1)) for i in range(3000)]
    rows += [("cold", jan(2), 1.0, T1, dt.date(2023, 1, 1))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = {r.trip_id: r.tip for r in I.dedupe_latest(df, "trip_id").collect()}
    assert got == {"hot": 2999.0, "cold": 1.0}


def test_high_water_mark_floor(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert I.high_water_mark(None, "pickup") == I.DEFAULT_FLOOR
    assert I.high_water_mark(empty, "pickup") == I.DEFAULT_FLOOR
    batch = spark.createDataFrame([("a", jan(1), 1.0, T1, None)], SCHEMA)
    assert I.new_rows(batch, empty, "pickup").count() == 1
    assert I.new_rows(batch, None, "pickup").count() == 1
    assert I.new_rows(batch, batch, "pickup").count() == 0     # strict >


def test_late_month_policies(spark):
    feb = spark.createDataFrame([("f", dt.datetime(2023, 2, 5), 1.0, T1, dt.date(2023, 2, 1))],
                                SCHEMA)
    late_jan = spark.createDataFrame([("j", jan(20), 1.0, T2, dt.date(2023, 1, 1))], SCHEMA)
    ref = I.upsert_frame(feb, I.new_rows(late_jan, feb, "pickup"), "trip_id")
    safe = I.upsert_frame(feb, I.new_rows(late_jan, feb, "_loaded_at"), "trip_id")
    assert sorted(r.trip_id for r in ref.collect()) == ["f"]
    assert sorted(r.trip_id for r in safe.collect()) == ["f", "j"]


def test_upsert_frame_replaces_keys(spark):
    t = spark.createDataFrame([("a", jan(1), 1.0, T1, None), ("b", jan(2), 1.0, T1, None)], SCHEMA)
    b = spark.createDataFrame([("b", jan(2), 7.0, T2, None), ("c", jan(3), 1.0, T2, None)], SCHEMA)
    got = {r.trip_id: r.tip for r in I.upsert_frame(t, b, "trip_id").collect()}
    assert got == {"a": 1.0, "b": 7.0, "c": 1.0}
    assert I.upsert_frame(None, b, "trip_id").count() == 2


def test_schema_drift_sync(spark):
    t = spark.createDataFrame([("a", 1.0, "x")], "trip_id string, tip double, old string")
    b = spark.createDataFrame([("b", 2.0, 5)], "trip_id string, tip double, new int")
    t2, b2 = I.sync_columns(t, b)
    assert t2.columns == ["trip_id", "tip", "new"] and t2.first().new is None
    out = I.upsert_frame(t, b, "trip_id")
    assert out.columns == ["trip_id", "tip", "new"] and out.count() == 2


def _table(spark, path):
    return sorted((r.trip_id, r.tip, str(r.m)) for r in spark.read.parquet(path).collect())


def test_upsert_on_disk_idempotent_and_partition_local(spark, tmp_table_dir):
    path = tmp_table_dir + "/fct"
    b1 = spark.createDataFrame([("a", jan(1), 1.0, T1, dt.date(2023, 1, 1)),
                                ("f", dt.datetime(2023, 2, 1), 1.0, T1, dt.date(2023, 2, 1))],
                               SCHEMA)
    I.upsert(spark, path, b1, "trip_id", ["m"])
    b2 = spark.createDataFrame([("a", jan(1), 5.0, T2, dt.date(2023, 1, 1)),
                                ("z", jan(9), 1.0, T2, dt.date(2023, 1, 1))], SCHEMA)
    I.upsert(spark, path, b2, "trip_id", ["m"])
    once = _table(spark, path)
    assert once == [("a", 5.0, "2023-01-01"), ("f", 1.0, "2023-02-01"), ("z", 1.0, "2023-01-01")]
    I.upsert(spark, path, b2, "trip_id", ["m"])          # rerun: no change
    assert _table(spark, path) == once
    I.upsert(spark, path, b1, "trip_id", ["m"], full_refresh=True)
    assert _table(spark, path) == [("a", 1.0, "2023-01-01"), ("f", 1.0, "2023-02-01")]


def test_month_of_run():
    assert I.month_of_run("2023-03-15") == "2023-03"


def test_recorded_marks_equal_scanned_max(spark, tmp_table_dir):
    """upsert records each write's max; high_water_mark reads it instead of
    scanning, and it equals the scanned max after inserts and replacements."""
    import datetime as dt
    from meterline.operators.incremental import MARKS_DIR, high_water_mark, upsert
    path = tmp_table_dir + "/t"
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3), f"m{i % 2}") for i in range(10)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, part string")
    upsert(spark, path, df, "k", ["part"], watermark_cols=["ts"])
    later = spark.createDataFrame([(3, dt.datetime(2024, 2, 1), "m1"),
                                   (11, dt.datetime(2024, 1, 5), "m1")],
                                  "k int, ts timestamp_ntz, part string")
    upsert(spark, path, later, "k", ["part"], watermark_cols=["ts"])
    t = spark.read.parquet(path)
    assert MARKS_DIR not in t.columns and t.count() == 11     # the marks stay hidden
    scanned = t.agg({"ts": "max"}).first()[0]
    assert high_water_mark(t, "ts", path=path) == scanned == dt.datetime(2024, 2, 1)
    assert spark.read.json(f"{path}/{MARKS_DIR}").count() == 2
    # a column without recorded marks falls back to a scan
    assert high_water_mark(t, "k", path=path) == 11
    # a full refresh starts the record anew (the old, larger max is gone)
    upsert(spark, path, df, "k", ["part"], full_refresh=True, watermark_cols=["ts"])
    t = spark.read.parquet(path)
    assert high_water_mark(t, "ts", path=path) == dt.datetime(2024, 1, 3)
    assert spark.read.json(f"{path}/{MARKS_DIR}").count() == 1


DRIFT = "trip_id string, tip double, m date"


def _drift(spark):
    one, two = dt.date(2023, 1, 1), dt.date(2023, 2, 1)
    first = spark.createDataFrame([("a", 1.0, one), ("b", 1.0, two)], DRIFT)
    second = spark.createDataFrame([("b", 2.0, 7, two)], "trip_id string, tip double, x int, m date")
    third = spark.createDataFrame([("c", 3.0, 8, two)], "trip_id string, tip double, x int, m date")
    return first, second, third


def test_columns_sync_on_disk(spark, tmp_table_dir):
    path = tmp_table_dir + "/t"
    first, second, third = _drift(spark)
    for b in (first, second, third):
        I.upsert(spark, path, b, "trip_id", ["m"])
    got = {r.trip_id: (r.tip, r.x) for r in I.read_table(spark, path).collect()}
    assert got == {"a": (1.0, None), "b": (2.0, 7), "c": (3.0, 8)}
    # A dropped column is gone from partitions no batch touched, too.
    I.upsert(spark, path, spark.createDataFrame([("d", dt.date(2023, 2, 1))], "trip_id string, m date"),
             "trip_id", ["m"])
    t = I.read_table(spark, path)
    assert t.columns == ["trip_id", "m"] and t.count() == 4
    # A column whose type changes is rewritten everywhere.
    wide = spark.createDataFrame([("e", 1, dt.date(2023, 2, 1))], "trip_id string, n int, m date")
    I.upsert(spark, path, wide, "trip_id", ["m"])
    I.upsert(spark, path, wide.withColumn("n", wide["n"].cast("bigint")), "trip_id", ["m"])
    assert dict(I.read_table(spark, path).dtypes)["n"] == "bigint"
    assert sorted(r.trip_id for r in I.read_table(spark, path).collect()) == list("abcde")


def test_a_crash_in_the_swap_loses_nothing(spark, tmp_table_dir, monkeypatch):
    """Die after the pending write and half the swap (the touched partition is
    deleted): the next reader finishes it, kept rows included."""
    path = tmp_table_dir + "/t"
    first = spark.createDataFrame([("a", 1.0, dt.date(2023, 1, 1)), ("k", 1.0, dt.date(2023, 1, 1)),
                                   ("b", 1.0, dt.date(2023, 2, 1))], DRIFT)
    I.upsert(spark, path, first, "trip_id", ["m"])
    batch = spark.createDataFrame([("a", 5.0, dt.date(2023, 1, 1))], DRIFT)
    finish = I._finish_pending

    def dies(spark_, path_):
        I.delete_path(spark_, path_ + "/m=2023-01-01")
        raise RuntimeError("lost")

    monkeypatch.setattr(I, "_finish_pending", dies)
    with pytest.raises(RuntimeError):
        I.upsert(spark, path, batch, "trip_id", ["m"])
    monkeypatch.setattr(I, "_finish_pending", finish)
    want = [("a", 5.0), ("b", 1.0), ("k", 1.0)]
    assert sorted((r.trip_id, r.tip) for r in I.read_table(spark, path).collect()) == want
    I.upsert(spark, path, batch, "trip_id", ["m"])     # the rerun changes nothing
    assert sorted((r.trip_id, r.tip) for r in I.read_table(spark, path).collect()) == want


def test_a_crash_before_the_pending_write_ends_changes_nothing(spark, tmp_table_dir):
    path = tmp_table_dir + "/t"
    first, *_ = _drift(spark)
    I.upsert(spark, path, first, "trip_id", ["m"])
    # What an unfinished write leaves: rows without the success mark.
    first.write.parquet(path + "/_pending/rows")
    I.delete_path(spark, path + "/_pending/rows/_SUCCESS")
    assert I.read_table(spark, path).count() == 2          # a reader leaves it alone
    I.upsert(spark, path, first, "trip_id", ["m"])         # the next writer removes it
    assert I.read_table(spark, path).count() == 2
    assert not I._exists(spark, path + "/_pending")


def test_an_empty_first_batch_makes_an_empty_table(spark, tmp_table_dir):
    path = tmp_table_dir + "/t"
    first, *_ = _drift(spark)
    I.upsert(spark, path, first.limit(0), "trip_id", ["m"], watermark_cols=["tip"])
    t = I.read_table(spark, path)
    assert t.count() == 0 and t.columns == first.columns
    I.upsert(spark, path, first, "trip_id", ["m"], watermark_cols=["tip"])
    assert I.read_table(spark, path).count() == 2


def test_a_swap_broken_off_between_two_folders_reads_whole(spark, tmp_table_dir, monkeypatch):
    """Every point of the swap: readers see the merged table and change nothing,
    the next writer ends it, and the write is recorded once."""
    months = [dt.date(2023, m, 1) for m in (1, 2, 3)]
    first = spark.createDataFrame([(f"k{m.month}", 1.0, m) for m in months], DRIFT)
    batch = spark.createDataFrame([(f"n{m.month}", 2.0, m) for m in months], DRIFT)
    want = [(f"{c}{m}", t) for c, t in (("k", 1.0), ("n", 2.0)) for m in (1, 2, 3)]
    move = I._move
    for broken in range(4):
        path = f"{tmp_table_dir}/t{broken}"
        I.upsert(spark, path, first, "trip_id", ["m"], watermark_cols=["tip"])
        done = []

        def dies(spark_, source, to):
            if len(done) == broken:
                I.delete_path(spark_, to)        # the old folder is gone, the new one not there
                raise RuntimeError("lost")
            done.append(to)
            move(spark_, source, to)

        monkeypatch.setattr(I, "_move", dies)
        with pytest.raises(RuntimeError):
            I.upsert(spark, path, batch, "trip_id", ["m"], watermark_cols=["tip"])
        monkeypatch.setattr(I, "_move", move)
        for _ in range(2):
            assert sorted((r.trip_id, r.tip) for r in I.read_table(spark, path).collect()) == want
        assert I._exists(spark, path + "/_pending")
        I.recover(spark, path)
        assert sorted((r.trip_id, r.tip) for r in I.read_table(spark, path).collect()) == want
        assert not I._exists(spark, path + "/_pending")
        assert [int(n.split("-")[0]) for n in I._numbers(spark, path)] == [0, 1]


def test_a_merge_is_one_table_write(spark, tmp_table_dir, monkeypatch):
    path = tmp_table_dir + "/t"
    first, *_ = _drift(spark)
    I.upsert(spark, path, first, "trip_id", ["m"])
    from pyspark.sql import DataFrameWriter
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, at, *a, **k: (seen.append(at), write(self, at, *a, **k)))
    I.upsert(spark, path, first, "trip_id", ["m"])
    assert [p.replace(path, "") for p in seen] == ["/_pending/rows"]
    seen.clear()
    assert I.read_table(spark, path).count() == 2 and not seen


def test_a_wider_number_type_rewrites_only_its_own_months(spark, tmp_table_dir):
    path = tmp_table_dir + "/t"
    one, two = dt.date(2023, 1, 1), dt.date(2023, 2, 1)
    cols = "trip_id string, n {}, f {}, m date"
    I.upsert(spark, path, spark.createDataFrame([("a", 1, 0.5, one), ("b", 2, 0.5, two)],
                                                cols.format("int", "float")), "trip_id", ["m"])
    old = sorted(spark.read.parquet(path + "/m=2023-01-01").inputFiles())
    wide = spark.createDataFrame([("c", 2 ** 40, 1e300, two)], cols.format("bigint", "double"))
    I.upsert(spark, path, wide, "trip_id", ["m"])
    t = I.read_table(spark, path)
    assert dict(t.dtypes)["n"] == "bigint" and dict(t.dtypes)["f"] == "double"
    assert {r.trip_id: (r.n, r.f) for r in t.collect()} == {"a": (1, 0.5), "b": (2, 0.5), "c": (2 ** 40, 1e300)}
    assert sorted(spark.read.parquet(path + "/m=2023-01-01").inputFiles()) == old
    # A later merge into the old month reads its narrow files.
    I.upsert(spark, path, spark.createDataFrame([("d", 5, 2.0, one)], cols.format("bigint", "double")),
             "trip_id", ["m"])
    assert {r.trip_id: r.n for r in I.read_table(spark, path).collect()} == {"a": 1, "b": 2, "c": 2 ** 40, "d": 5}


def test_two_partition_columns_and_null_values(spark, tmp_table_dir):
    path = tmp_table_dir + "/t"
    cols = "k string, v int, a string, b int"
    I.upsert(spark, path, spark.createDataFrame(
        [("p", 1, "x", 1), ("q", 1, None, 2), ("r", 1, "x", None), ("s", 1, "y", 3)], cols), "k", ["a", "b"])
    I.upsert(spark, path, spark.createDataFrame(
        [("q", 2, None, 2), ("r", 2, "x", None), ("t", 2, "z z", 4)], cols), "k", ["a", "b"])
    got = {r.k: (r.v, r.a, r.b) for r in I.read_table(spark, path).collect()}
    assert got == {"p": (1, "x", 1), "q": (2, None, 2), "r": (2, "x", None), "s": (1, "y", 3), "t": (2, "z z", 4)}


def test_upsert_frame_computes_each_input_once(spark):
    """the batch's plan was run for its keys and again for its rows."""
    target = spark.range(100).selectExpr("cast(id as string) trip_id", "0.0 tip")
    batch = spark.range(50, 150).selectExpr("cast(id as string) trip_id", "1.0 tip")
    plan = I.upsert_frame(target, batch, "trip_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_upsert_frame_null_keys_and_copies(spark):
    schema = "a string, b int, v int"
    target = spark.createDataFrame([("x", 1, 1), ("x", 1, 2), ("y", 1, 3), ("y", 1, 4), (None, 1, 5),
                                    (None, 1, 6), ("x", None, 7)], schema)
    batch = spark.createDataFrame([("x", 1, 10), ("x", 1, 11), (None, 1, 12), ("x", None, 13), ("z", 1, 14)], schema)
    for by in ((), ("b",)):
        got = sorted(r.v for r in I.upsert_frame(target, batch, ["a", "b"], by).collect())
        assert got == [3, 4, 5, 6, 7, 10, 11, 12, 13, 14]


def test_merge_is_written_from_its_one_shuffle(spark, tmp_table_dir):
    """a merge was shuffled by key and once more by partition."""
    rows = spark.range(400).selectExpr("cast(id as string) trip_id", "0.0 tip", "cast(id % 3 as int) p")
    plan = I.upsert_frame(rows, rows.limit(100), "trip_id", ["p"]).sortWithinPartitions("p")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    again = rows.filter("trip_id % 2 = 0").withColumn("tip", F.lit(1.0))
    for batch in (rows, again, again):
        I.upsert(spark, tmp_table_dir, batch, "trip_id", ["p"])
    got = sorted((int(r.trip_id), r.tip, r.p) for r in I.read_table(spark, tmp_table_dir).collect())
    assert got == [(i, float(i % 2 == 0), i % 3) for i in range(400)]


def test_clustered_first_write_has_no_shuffle(spark, tmp_table_dir):
    """rows that lie by partition were dealt by it again."""
    rows = spark.range(90).selectExpr("cast(id as string) trip_id", "cast(id % 3 as int) p")
    rows.write.partitionBy("p").parquet(f"{tmp_table_dir}/in")
    lying = spark.read.parquet(f"{tmp_table_dir}/in")
    seen = []
    dealt, I.rebalanced = I.rebalanced, lambda df, by: seen.append(by) or dealt(df, by)
    try:
        I.upsert(spark, f"{tmp_table_dir}/t", lying, "trip_id", ["p"], clustered=True)
    finally:
        I.rebalanced = dealt
    assert not seen
    assert I.read_table(spark, f"{tmp_table_dir}/t").count() == 90


def test_clustered_write_reads_small_pieces(spark, tmp_table_dir, monkeypatch):
    """a task of a clustered write sorted all it read, up to 128 MB of files,
    and spilled; a merge and other reads keep the session's pieces."""
    from pyspark.sql import DataFrameWriter
    key = "spark.sql.files.maxPartitionBytes"
    before, seen, write = spark.conf.get(key), [], DataFrameWriter.parquet
    spark.range(3000).selectExpr("cast(id as string) trip_id", "cast(id % 3 as int) p").repartition(
        3, "p").write.partitionBy("p").parquet(f"{tmp_table_dir}/in")
    lying = spark.read.parquet(f"{tmp_table_dir}/in")
    monkeypatch.setattr(I, "CLUSTERED_PIECE", "4k")
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, at, *a, **k: (
        seen.append((spark.conf.get(key), self._df.rdd.getNumPartitions())), write(self, at, *a, **k)))
    I.upsert(spark, f"{tmp_table_dir}/t", lying, "trip_id", ["p"], clustered=True)
    I.upsert(spark, f"{tmp_table_dir}/t", lying, "trip_id", ["p"], clustered=True)
    spark.conf.set(key, "1k")
    try:
        I.upsert(spark, f"{tmp_table_dir}/t", lying, "trip_id", ["p"], full_refresh=True, clustered=True)
        assert spark.conf.get(key) == "1k"
    finally:
        spark.conf.set(key, before)
    assert [at for at, _ in seen] == ["4k", before, "1k"] and seen[0][1] >= 3
    assert I.read_table(spark, f"{tmp_table_dir}/t").count() == 3000


def _lying(spark, path, df, by):
    """Rows that lie by partition, as a clustered upsert takes them."""
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _exchanged(df):
    """The columns of each shuffle by hash in a plan."""
    p = df._jdf.queryExecution().executedPlan()
    nodes, found = [p], []
    while nodes:
        n = nodes.pop()
        if n.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            n = n.initialPlan()
        if n.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append([n.output().apply(i).name() for i in range(n.output().size())])
        nodes += [n.children().apply(i) for i in range(n.children().size())]
    return found


def test_clustered_merge_shuffles_keys_only(spark, tmp_table_dir, monkeypatch):
    """a merge of rows that lie by partition shuffled all their columns."""
    from pyspark.sql import DataFrameWriter
    rows = spark.range(300).selectExpr("md5(cast(id as string)) trip_id", "id", "0.0 tip", "cast(id % 3 as int) p")
    first = _lying(spark, f"{tmp_table_dir}/in", rows, ["p"])
    batch = first.filter("id % 2 = 0 and p < 2").withColumn("tip", F.lit(1.0))
    shuffled, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, at, *a, **k: (
        shuffled.extend(_exchanged(self._df)), write(self, at, *a, **k)))
    path, keys = f"{tmp_table_dir}/t", ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.maxPartitionBytes",
                                        "spark.sql.classic.shuffleDependency.fileCleanup.enabled",
                                        "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k) for k in keys]
    for b in (first, batch, batch):
        I.upsert(spark, path, b, "trip_id", ["p"], clustered=True)
    assert [spark.conf.get(k) for k in keys] == before
    assert shuffled and not {"tip", "id"} & {c for cols in shuffled for c in cols}
    got = sorted((r.id, r.tip, r.p) for r in I.read_table(spark, path).collect())
    assert got == [(i, float(i % 2 == 0 and i % 3 < 2), i % 3) for i in range(300)]


def test_clustered_merge_equals_the_merge_by_rows(spark, tmp_table_dir, monkeypatch):
    """files of more rows than a bitmap, copies, NULL and look-alike keys, NULL
    partitions, partitions in turns, a column added and one dropped, marks."""
    monkeypatch.setattr(I, "BITS", 50_000)
    key = ("case when id % 50 = 0 then null when id % 50 = 1 then 'ab' when id % 50 = 2 then 'AB' when id % 50 = 3 "
           "then 'a' when id % 50 = 4 then 'é' when id % 50 = 5 then '' when id % 50 = 6 then '0a' "
           "else md5(cast(id div 2 as string)) end")
    cols = [f"{key} k", "cast(id % 4 as int) j", "id v", "case when id % 4 > 0 then concat('p ', id % 4) end a",
            "cast(id % 4 as int) b"]
    first = _lying(spark, f"{tmp_table_dir}/in1", spark.range(160_000).selectExpr(*cols, "1 gone").coalesce(1), ["a", "b"])
    again = _lying(spark, f"{tmp_table_dir}/in2", spark.range(90_000, 200_000, 3).filter("id % 4 < 3")
                   .selectExpr(*cols, "cast(id as double) extra"), ["a", "b"])
    one = _lying(spark, f"{tmp_table_dir}/in3", spark.range(39, 160_000, 40).selectExpr(*cols, "0.5D extra"), ["a", "b"])
    got = []
    for clustered in (True, False):
        path = f"{tmp_table_dir}/t{clustered}"
        for b in (first, again, again, one):
            I.upsert(spark, path, b, ["k", "j"], ["a", "b"], watermark_cols=["v"], map_col="j", clustered=clustered)
        t, last = I.read_table(spark, path), I._last_write(spark, path)
        got.append((sorted(map(tuple, t.collect()), key=str), t.columns, last["marks"], last["map"], last["parts"]))
    assert len(got[0][0]) == len(got[1][0]) > 150_000
    assert got[0] == got[1]


def test_clustered_merge_deals_many_small_files_anew(spark, tmp_table_dir):
    """each merge adds the batch's files as they lie; a partition of many small
    ones is written anew in at most ``PIECES``."""
    path = f"{tmp_table_dir}/t"
    rows = spark.range(200).selectExpr("cast(id as string) k", "0 v", "cast(id % 2 as int) p")
    first = _lying(spark, f"{tmp_table_dir}/in", rows, ["p"])
    I.upsert(spark, path, first, "k", ["p"], clustered=True)
    rows.withColumn("k", F.concat(F.lit("n"), "k")).repartition(70).write.mode("append").partitionBy("p").parquet(path)
    I.upsert(spark, path, first.filter("p = 1").withColumn("v", F.lit(1)), "k", ["p"], clustered=True)
    got = sorted((r.k, r.v) for r in I.read_table(spark, path).collect())
    assert got == sorted([(str(i), i % 2) for i in range(200)] + [(f"n{i}", 0) for i in range(200)])
    assert len(spark.read.parquet(f"{path}/p=1").inputFiles()) <= I.PIECES


def test_clustered_merge_into_an_empty_table(spark, tmp_table_dir):
    path = f"{tmp_table_dir}/t"
    rows = _lying(spark, f"{tmp_table_dir}/in", spark.range(9).selectExpr("id k", "cast(id % 2 as int) p"), ["p"])
    for b in (rows.filter("k < 0"), rows, rows.filter("k < 0"), rows):
        I.upsert(spark, path, b, "k", ["p"], watermark_cols=["k"], clustered=True)
    assert sorted(r.k for r in I.read_table(spark, path).collect()) == list(range(9))
    assert I._last_write(spark, path)["marks"] == {"k": 8}
