"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: the majority, bit by bit, of the 64-bit hashes of a text's word
shingles. Fingerprints that differ in at most ``radius`` bits are linked, and
documents are labelled by connected component.

Search, on distinct fingerprints only:

1. Bits are grouped into m parts, correlated bits together (their correlation
   comes from one pass over all fingerprints: 64 x 64 sums).
2. Pigeonhole: if parts get thresholds T_i >= -1 with sum(T_i + 1) = radius + 1,
   two fingerprints within the radius agree to within T_i bits on some part.
   For every m the best thresholds are found by dynamic programming over the
   parts on estimated work: keys probed plus candidates expected from the bits'
   own distribution. The cheapest m is used. Thresholds may differ between
   parts; -1 leaves a part out.
3. A fingerprint is filed under its value on each part used and probes the
   values within T_i bits of its own. Candidates are verified on all 64 bits.
4. A probed value filed under by very many fingerprints would cost its square.
   All fingerprints that meet in such a value are linked exactly another way:
   two fingerprints are within 2r bits only if some fingerprint lies within r
   bits of both, so each names those around it (65 for radius 2) and all that
   name the same one are linked to the smallest. No such group exceeds 65.

Defined cases: NULL and empty texts have the fingerprint zero, linked like any
other. NULL ids take part; a component's id is its smallest id that is not NULL
(NULL if it has none). Repeated rows share a fingerprint. An empty table gives
an empty result. Very long texts are hashed whole. Other columns may have any
names; of rows that repeat the id and text that stay, ``drop_near_copies`` keeps
the smallest as JSON.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import batch_of, map_rows, text_of, written
from meterline.llm.components import components
from meterline.llm.exact_dedup import one_row_each

BITS = 64
#: Candidates of one probed value beyond which its members are linked through
#: the fingerprints around them (step 4): a change of route, not of result.
CROWD = 10_000
#: Hashes expanded into bits at once.
BLOCK = 1 << 15
SIGN = 1 << 63


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The text's fingerprint, unsigned."""
    words = (text or "").encode().lower().split()   # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    starts = list(itertools.accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b - 1], seed) for a, b in zip(starts, starts[k:])], "<u8")
    counts = np.zeros(BITS, "int64")
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i:i + BLOCK].view("u1").reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long), hash (of the text:
    tells rows that repeat an id apart)."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for keys, texts, hashes in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in texts], "u8").view("i8")
            yield batch_of(doc_id=(keys, pa.int64()), fp=(fp, pa.int64()), hash=(hashes, pa.int64()))
    rows = docs.select(id_col, text_col, F.xxhash64(text_of(text_col)))
    return map_rows(rows, run, "doc_id long, fp long, hash long")


def bit_sums(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for (fps,) in batches:
            x = np.unpackbits(np.array(fps, "<i8").view("u1").reshape(-1, 8), axis=1,
                              bitorder="little").astype("float32")
            total += x.T @ x
            n += len(x)
        i, j = np.triu_indices(BITS)
        yield batch_of(i=([-1, *i.tolist()], pa.int32()), j=([-1, *j.tolist()], pa.int32()),
                       c=([n, *total[i, j].astype("int64").tolist()], pa.int64()))
    rows = (map_rows(prints.select("fp"), run, "i int, j int, c long")
            .groupBy("i", "j").agg(F.sum("c").alias("c")).collect())   # 2,081 rows
    both, n = np.zeros((BITS, BITS)), 0
    for r in rows:
        if r["i"] < 0:
            n = r["c"]
        else:
            both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["c"]
    return n, both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near equal size, each grown by the bit most
    correlated with those it has."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [min(left, key=lambda b: (-corr[b, list(left - {b})].sum() if len(left) > 1 else 0, b))]
        left -= set(group)
        while len(group) < size:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def _within(p: np.ndarray, group: list[int], t: int) -> float:
    """Estimated share of pairs that agree on the group to within ``t`` bits."""
    agree = p[group] ** 2 + (1 - p[group]) ** 2
    ways = np.array([1.0] + [0.0] * t)
    for a in agree:
        ways = a * ways + (1 - a) * np.concatenate([[0.0], ways[:-1]])
    return float(ways.sum())


def plan(n: int, both: np.ndarray, radius: int) -> tuple[list[list[int]], list[int]]:
    """The groups and thresholds of least estimated work per fingerprint."""
    p = np.diag(both) / max(n, 1)
    best = None
    for m in range(1, 2 * (radius + 1) + 1):
        groups = group_bits(n, both, m)
        # dp: units (threshold + 1) spent so far -> (work, thresholds)
        dp = {0: (0.0, [])}
        for g in groups:
            nxt: dict[int, tuple[float, list[int]]] = {}
            for (spent, (work, ts)), u in itertools.product(dp.items(), range(radius + 2)):
                if spent + u > radius + 1:
                    continue
                keys = sum(math.comb(len(g), d) for d in range(u))
                cost = work + (1 + keys + n * _within(p, g, u - 1) if u else 0.0)
                if spent + u not in nxt or cost < nxt[spent + u][0]:
                    nxt[spent + u] = (cost, [*ts, u - 1])
            dp = nxt
        work, ts = dp[radius + 1]
        if best is None or work < best[0]:
            best = (work, groups, ts)
    return best[1], best[2]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= SIGN else x


def _flips(group: list[int], t: int) -> list[int]:
    """All ways to change at most ``t`` bits of the group."""
    return [sum(1 << b for b in bits) for d in range(t + 1)
            for bits in itertools.combinations(group, d)]


def _around(prints: DataFrame, radius: int) -> DataFrame:
    """Exact links among ``prints``: those naming a common fingerprint within
    half the radius; verified, as a larger half reaches past an odd radius."""
    flips = F.array(*[F.lit(_signed(x)).cast("long")
                      for x in _flips(list(range(BITS)), (radius + 1) // 2)])
    named = prints.select("fp", F.explode(F.transform(
        flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("mid"))
    if radius % 2 == 0:
        low = named.groupBy("mid").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n"))
        return (named.join(low.filter("n > 1"), "mid").filter("fp != a")
                     .select("a", F.col("fp").alias("b")).distinct())
    pairs = named.join(named.withColumnRenamed("fp", "a"), "mid").filter("a < fp")
    return (pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= radius)
                 .select("a", F.col("fp").alias("b")).distinct())


def links(prints: DataFrame, radius: int = 2, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly those
    connected by pairs within the radius."""
    n, both = bit_sums(prints)
    groups, thresholds = plan(n, both, radius)
    filed = probes = None
    for i, (group, t) in enumerate(zip(groups, thresholds)):
        if t < 0:
            continue
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in group))).cast("long"))
        flips = F.array(*[F.lit(_signed(x)).cast("long") for x in _flips(group, t)])
        one = prints.select(F.lit(i).alias("part"), own.alias("value"), "fp")
        more = prints.select(F.lit(i).alias("part"), F.explode(F.transform(
            flips, lambda x: own.bitwiseXOR(x))).alias("value"), "fp")
        filed = one if filed is None else filed.unionByName(one)
        probes = more if probes is None else probes.unionByName(more)
    key = ["part", "value"]
    # How many meet in each value; a value that only its own fingerprint
    # probes can hold no pair.
    met = (filed.select(*key, F.lit(1).alias("f"), F.lit(0).alias("p"))
                .unionByName(probes.select(*key, F.lit(0).alias("f"), F.lit(1).alias("p")))
                .groupBy(*key).agg(F.sum("f").alias("f"), F.sum("p").alias("p"))
                .filter("f > 0 and f * p > 1").withColumn("crowded", F.col("f") * F.col("p") > crowd))
    met = written(met, "met")
    few, many = met.filter("not crowded").select(*key), met.filter("crowded").select(*key)
    some = filed.join(few, key)
    pairs = (some.join(probes.withColumnRenamed("fp", "q"), key)
                 .filter((F.col("fp") != F.col("q"))
                         & (F.bit_count(F.col("fp").bitwiseXOR(F.col("q"))) <= radius))
                 .select(F.least("fp", "q").alias("a"), F.greatest("fp", "q").alias("b")))
    crowds = filed.join(many, key).select("fp").unionByName(
        probes.join(many, key).select("fp")).distinct()
    return pairs.unionByName(_around(crowds, radius))


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int,
                radius: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, fp, hash) and the component (root) of each fp."""
    rows = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    # The first row of each fingerprint: smallest id that is not NULL.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash"))
    prints = written(rows.groupBy("fp").agg(first.alias("first")), "prints")
    roots = written(components(links(prints.select("fp"), radius)), "roots")
    return rows, (prints.join(roots, prints["fp"] == roots["node"], "left")
                        .select("fp", "first", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per row."""
    rows, root = _components(docs, id_col, text_col, shingle, seed, radius)
    low = root.groupBy("root").agg(F.min("first").alias("low"))
    of = root.join(low, "root").select("fp", F.col("low.doc_id").alias("component_id"))
    return rows.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """One row of each component, the one of the smallest id, all columns
    unchanged; of rows that repeat that id, one."""
    _, root = _components(docs, id_col, text_col, shingle, seed, radius)
    stay = (root.groupBy("root").agg(F.min("first").alias("low"))
                .select(F.col("low.doc_id").alias("id"), F.col("low.hash").alias("own")))
    return one_row_each(docs, id_col, F.xxhash64(text_of(text_col)), stay)
