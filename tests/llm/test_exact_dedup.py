import hashlib

from pyspark.sql import functions as F

from meterline.llm import exact_dedup
from tests.conftest import SF001
from tests.llm.helpers import awkward, empty, rows
from tests.oracle_harness import compare, duck

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(keep=max):
    groups = {}
    for r in rows():
        groups.setdefault((r[1] or "").translate(UPPER), []).append(r[0])
    out = []
    for text, ids in groups.items():
        some = [i for i in ids if i is not None]
        stay = keep(some) if some else None
        first = True
        for i in ids:
            kept = i == stay and first
            first = first and not kept
            out.append((i, stay, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_groups_nulls_ties_and_clashing_names(spark):
    assert got(exact_dedup.exact_groups(awkward(spark))) == expected()
    assert got(exact_dedup.exact_groups(awkward(spark), keep="smallest")) == expected(min)


def test_colliding_hashes_change_nothing(spark):
    weak = exact_dedup.exact_groups(awkward(spark), hash_of=lambda t: F.unhex(F.substring(F.md5(t), 1, 1)))
    assert got(weak) == expected()
    one = exact_dedup.exact_groups(awkward(spark), hash_of=lambda t: F.unhex(F.lit("00")))
    assert got(one) == expected()


def test_drop_copies_keeps_whole_rows(spark):
    docs = awkward(spark)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(repr, [r["doc_id"] for r in kept.collect()])) == sorted(
        map(repr, [i for i, _, _, k, _ in expected() if k]))


def test_a_split_group_and_repeated_rows_that_differ_elsewhere(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TOGETHER", 3)
    many = spark.createDataFrame([(i % 40, "Same text", f"n{i}") for i in range(100)] + [(7, "other", "x")],
                                 "doc_id long, text string, note string")
    out = exact_dedup.exact_groups(many).collect()
    assert {(r["keep"], r["size"]) for r in out} == {(39, 100), (7, 1)} and sum(r["kept"] for r in out) == 2
    kept = [tuple(r) for r in exact_dedup.drop_copies(many.repartition(5)).collect()]
    assert sorted(kept) == [(7, "other", "x"), (39, "Same text", "n39")]     # of n39 and n79
    weak = exact_dedup.exact_groups(many, hash_of=lambda t: F.unhex(F.lit("00")))
    assert got(weak) == got(exact_dedup.exact_groups(many))


def test_empty_table(spark):
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    assert exact_dedup.drop_copies(empty(spark)).count() == 0


def test_query_matches_its_sql(spark):
    r = compare(spark, "op6_exact_dedup", SF001, duck(SF001))
    assert r["status"] == "ok" and not r.get("types"), r


def test_the_entry_registers_every_operator_and_the_pipeline():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
