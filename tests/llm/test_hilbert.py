import itertools
import zlib

import pytest

from meterline.llm import hilbert
from meterline.llm.queries import op9_hilbert_sharding
from tests.conftest import SF001
from tests.llm.helpers import awkward, empty, rows, stored


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbouring_cells(dims, bits):
    digits, nexts, _ = hilbert.curve_table(dims)
    at = {}
    for p in itertools.product(range(1 << bits), repeat=dims):
        state = place = 0
        for b in range(bits - 1, -1, -1):
            cell = sum(((c >> b) & 1) << (dims - 1 - k) for k, c in enumerate(p))
            i = state * (1 << dims) + cell
            place, state = place * (1 << dims) + digits[i], nexts[i]
        at[place] = p
    assert sorted(at) == list(range((1 << bits) ** dims))
    for i in range(len(at) - 1):
        assert sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1


def test_sql_curve_equals_the_table_walk(spark):
    from pyspark.sql import functions as F
    digits, nexts, _ = hilbert.curve_table(3)
    cells = list(itertools.product(range(4), repeat=3))
    df = spark.createDataFrame(cells, "a int, b int, c int")
    for r in df.withColumn("p", hilbert.curve_place([F.col("a"), F.col("b"), F.col("c")], 2)).collect():
        state = place = 0
        for b in (1, 0):
            cell = sum(((v >> b) & 1) << (2 - k) for k, v in enumerate(r[:3]))
            i = state * 8 + cell
            place, state = place * 8 + digits[i], nexts[i]
        assert r["p"] == place


def check(out, n):
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by.values())) == n
    sizes = [len(by.get(s, [])) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


def test_law_of_rows_on_documents(spark):
    out = op9_hilbert_sharding(spark, SF001).collect()
    check(out, spark.read.parquet(f"{SF001}/documents.parquet").count())


def test_awkward_rows_and_empty_table(spark):
    out = op9_hilbert_sharding(spark, stored(spark, "hilbert", documents=awkward(spark))).collect()
    check(out, len(rows()))
    want = sorted((repr(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows())
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == want
    assert op9_hilbert_sharding(spark, stored(spark, "hilbert0", documents=empty(spark))).count() == 0


def test_rows_of_a_shard_are_close(spark):
    """Pruning: a shard's files span far fewer sources than a random split."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = hilbert.hilbert_shards(docs.select("doc_id", "lang", "source", "n_chars"),
                                 ["lang", "source", "n_chars"], 8, ties=["doc_id"])
    spans = {}
    for r in out.collect():
        spans.setdefault(r["shard"], []).append((r["lang"], r["source"]))
    mean = sum(len(set(v)) / len(v) for v in spans.values()) / 8
    assert mean < 0.75


def test_strings_with_a_long_common_start_dates_and_clashing_names(spark):
    from pyspark.sql import functions as F
    n = 640
    df = spark.range(n).select(
        "id", F.concat(F.lit("https://host.example/" + "a" * 300), F.format_string("%05d", F.col("id") % 400))
        .alias("url"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("day"),
        F.timestamp_seconds(F.col("id") * 977).alias("at"), F.lit("mine").alias("shard"), F.lit(1).alias("curve"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("hole"), F.lit(2).alias("own_shard"))
    own = hilbert.quantised(df, ["url", "day", "at", "hole"], 4)
    counts = [df.groupBy(q.alias("q")).count().collect() for q in own]
    for rows_of in counts[:3]:     # 16 buckets, none with more than twice its share
        assert len(rows_of) == 16 and max(r["count"] for r in rows_of) <= 2 * n / 16
    out = hilbert.hilbert_shards(df, ["url", "day", "at"], 8, ties=["id"])
    assert out.columns == ["id", "url", "day", "at", "own_own_shard", "own_curve", "hole", "own_shard",
                           "curve", "shard", "slot"]
    got = out.collect()
    check(got, n)
    assert {r["own_own_shard"] for r in got} == {"mine"}
    # The places follow a plain ordering by (place, tie).
    by = sorted(got, key=lambda r: (r["curve"], r["id"]))
    assert [(r["shard"], r["slot"]) for r in by] == sorted((r["shard"], r["slot"]) for r in got)


def test_string_bounds_are_the_quantiles(spark):
    values = ["b"] * 50 + ["a"] * 3 + ["c"] * 30 + ["d\U0001F600"] * 9 + ["e" * 400] * 8 + [None] * 7
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    known = sorted((v for v in values if v is not None), key=str.encode)
    want = {known[-(-k * len(known) // 8)] for k in range(1, 8)} - {"a"}
    assert hilbert.string_bounds(df, "v", 8) == sorted(want, key=str.encode)
    assert hilbert.string_bounds(df.filter("v is null"), "v", 8) == []
