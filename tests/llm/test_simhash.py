import numpy as np
import pytest
import xxhash

from meterline.llm import simhash
from meterline.llm.components import components
from meterline.llm.queries import op7_simhash
from tests.conftest import SF001
from tests.llm.helpers import awkward, empty, rows, stored


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(pairs):
    """(id, fingerprint) -> component id per row, by comparing all pairs."""
    fps = sorted({f for _, f in pairs})
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                up[find(a)] = find(b)
    low = {}
    for i, f in pairs:
        if i is not None:
            low[find(f)] = min(low.get(find(f), i), i)
    return [(i, f"{f:016x}", low.get(find(f))) for i, f in pairs]


def test_spark_hash_is_the_contracts(spark):
    got = spark.sql("select xxhash64('a b c') h").first()["h"]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("where", [None, "odd"])
def test_query_equals_all_pairs(spark, where):
    at = SF001 if where is None else stored(spark, "simhash", documents=awkward(spark))
    docs = spark.read.parquet(f"{at}/documents.parquet").collect()
    want = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in docs])
    got = [tuple(r) for r in op7_simhash(spark, at).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def near(n, seed):
    """Fingerprints in clouds of a few changed bits, and lone ones."""
    rnd = np.random.default_rng(seed)
    centres = rnd.integers(0, 1 << 63, 12, dtype="u8")
    out = set(rnd.integers(0, 1 << 63, n // 2, dtype="u8").tolist())
    while len(out) < n:
        x = int(centres[rnd.integers(len(centres))])
        for b in rnd.integers(0, 64, rnd.integers(0, 7)):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("radius,crowd", [(2, 10_000), (2, 4), (1, 4), (3, 4), (3, 10_000)])
def test_links_connect_what_pairs_connect(spark, radius, crowd):
    fps = near(600, radius)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(df, radius, crowd)).collect()}
    signed = [simhash._signed(f) for f in fps]
    got = {}
    for f in signed:
        got.setdefault(roots.get(f, f), set()).add(f)
    up = {f: f for f in signed}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(signed):
        for b in signed[i + 1:]:
            if ((a ^ b) % (1 << 64)).bit_count() <= radius:
                up[find(a)] = find(b)
    want = {}
    for f in signed:
        want.setdefault(find(f), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert len(want) < len(fps)


def test_plan_spends_the_radius():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 2, (500, 64)).astype(float)
    x[:, 1] = x[:, 0]
    both = x.T @ x
    for n in (500, 10 ** 6, 10 ** 9, 10 ** 12):
        groups, ts = simhash.plan(n, both * (n / 500), 2)
        assert sum(t + 1 for t in ts) == 3 and sorted(sum(groups, [])) == list(range(64))
    groups, ts = simhash.plan(10 ** 9, both * (10 ** 9 / 500), 2)
    assert len(set(ts)) > 1   # unequal thresholds
    assert any({0, 1} <= set(g) for g in simhash.group_bits(500, both, 4))


def test_drop_near_copies(spark):
    docs = awkward(spark)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    # One row per component; id 9 names two rows of different texts, each alone.
    low = {c for _, _, c in plain_components([(r[0], plain_fingerprint(r[1])) for r in rows()])}
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted([c or 0 for c in low] + [9])


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(chain, "a long, b long")
    roots = {r["node"]: r["root"] for r in components(df).collect()}
    assert roots == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_copies(empty(spark)).count() == 0
