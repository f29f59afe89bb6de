"""Exact top-k search by tiled matrix products.

Vectors become integers, ``floor(scale * x)``, and a query's score is its integer
inner product. The product of queries and shards is cut into blocks: rows are
dealt by a hash of their id into shards of at most about ``SHARD`` vectors, queries
into groups of about ``GROUP``, and each (shard, group) pair is one task's work.
Inside, tiles of ``TILE`` vectors by ``LINES`` queries go through one matrix
product each; of a tile only every query's k best are selected and merged into
its list so far. A pair yields one list of k per query; lists are merged in a
tree, ``FAN`` at a time, until each query has one.

Exactness: products run in doubles where the largest possible sum is below 2^53,
in 64-bit integers below 2^63, else in Python integers. Ids ascend within a
shard, so the smaller id wins a tie.

Scale: a row is copied once per query group and a query once per shard, the least
that a blocked product needs (nothing is broadcast, no task sees all of either
side). Shards grow with the input from 8,192 to 262,144 vectors, so small inputs
still spread and large ones copy queries rarely; a task holds one shard and one
group. The lists are k / SHARD of what is compared.

Defined cases: vectors that are NULL or hold NULL or non-finite components take
no part, nor do rows without an id; zero vectors do. Vectors meet only vectors
of their own length (empty ones score 0 with each other). Rows that repeat an id
count once, with the smallest of their vectors. Ties go to the smaller id. A
score beyond a long is the nearest long. With fewer than k candidates all are
returned, with none a query has no rows; an empty table gives an empty result.
Only the two named columns are read; others may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import written

#: Vectors and queries that one task multiplies at most (about), and that one
#: matrix product takes.
SHARD, GROUP = 262_144, 65_536
TILE, LINES = 8192, 512
#: Shards are cut smaller than SHARD until there are this many.
SPREAD = 64
#: Lists merged into one at each level of the tree.
FAN = 16


def finite(vector: Column) -> Column:
    """Whether a vector holds numbers only."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
                      F.lit(False))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): doubles where they hold it exactly, else Python integers."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if np.isfinite(y).all():
        return y
    return np.array([[int(v) * scale if abs(v) > 2 ** 53 else int(np.floor(v * scale)) for v in row]
                     for row in x], object).reshape(x.shape)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products (queries x vectors) of integer-valued rows."""
    largest = [max((abs(int(v)) for v in (a.min(), a.max())), default=0) if a.size else 0 for a in (q, x)]
    bound = largest[0] * largest[1] * q.shape[1]
    if bound < 2 ** 53:
        return (q.astype("f8") @ x.astype("f8").T).astype("i8")
    if bound < 2 ** 63:
        return q.astype("i8") @ x.astype("i8").T

    def whole(a: np.ndarray) -> np.ndarray:
        return np.array([[int(v) for v in row] for row in a], object).reshape(a.shape)

    exact = whole(q) @ whole(x).T
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype("i8")


def best_columns(scores: np.ndarray, out: np.ndarray, k: int) -> np.ndarray:
    """Per line, the columns of its k highest scores, highest first, ties to the
    smaller column. ``out`` (line, column pairs) never win while others are left."""
    width = scores.shape[1]
    k = min(k, width)
    top = int(max(abs(int(scores.min())), abs(int(scores.max())))) if scores.size else 0
    if (top + 2) * width < 2 ** 53:
        # Score and column in one number: no two are equal.
        keyed = scores.astype("f8") * width + (width - 1 - np.arange(width))
        keyed[out[0], out[1]] = -np.inf
        part = np.argpartition(-keyed, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(keyed, part, 1), axis=1)
        return np.take_along_axis(part, order, 1)
    order = np.argsort(~scores, axis=1, kind="stable")      # ~ turns the order round, without overflow
    own = np.zeros(scores.shape, bool)
    own[out[0], out[1]] = True
    last = np.argsort(np.take_along_axis(own, order, 1), axis=1, kind="stable")
    return np.take_along_axis(order, last, 1)[:, :k]


def best_of_shard(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray,
                  k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, scores, taken) of shape (queries, k): each query's best rows of a
    shard whose ids ascend, its own id left out; not ``taken``: no such row."""
    best = np.zeros((len(q), k), "i8"), np.zeros((len(q), k), "i8"), np.zeros((len(q), k), bool)
    for at in range(0, len(ids), TILE):
        tile = ids[at:at + TILE]
        scores = products(q, x[at:at + TILE])
        own = np.minimum(np.searchsorted(tile, q_ids), len(tile) - 1)
        mine = np.flatnonzero(tile[own] == q_ids)
        cols = best_columns(scores, np.array([mine, own[mine]]), k)
        new = (tile[cols], np.take_along_axis(scores, cols, 1), tile[cols] != q_ids[:, None])
        both = [np.concatenate([a, b], axis=1) for a, b in zip(best, new)]
        # Stable: among equal scores the earlier tile, so the smaller id, stays first.
        order = np.argsort(~both[1], axis=1, kind="stable")
        order = np.take_along_axis(order, np.argsort(~np.take_along_axis(both[2], order, 1), axis=1,
                                                     kind="stable"), 1)[:, :k]
        best = tuple(np.take_along_axis(a, order, 1) for a in both)
    return best


def _matrix(ids: pa.ChunkedArray, vectors: pa.ChunkedArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids ascending, vectors) of a task's rows."""
    ids, v = ids.to_numpy(), vectors.combine_chunks()
    x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
    order = np.argsort(ids, kind="stable")
    return ids[order], x[order]


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (doubles): the vectors that take part, one per id."""
    return (vectors.filter(F.col(id_col).isNotNull())
                   .select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
                   .filter(finite(F.col("v"))).groupBy("id").agg(F.min("v").alias("v")))


def search(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products
    of every row for which ``queries`` (a condition on the column ``id``) holds."""
    rows = written(usable_rows(vectors, id_col, vector_col), "topk-vectors")
    asked = rows.filter(queries)
    n = rows.count()
    shards = max(1, -(-n // min(SHARD, max(TILE, n // SPREAD))))
    groups = max(1, -(-asked.count() // GROUP))
    dim, spread = F.size("v").alias("dim"), F.xxhash64("id")

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    left = rows.select(dim, F.pmod(spread, F.lit(shards)).alias("shard"), each(groups).alias("part"), "id", "v")
    right = asked.select(dim, each(shards).alias("shard"),
                         F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(groups)).alias("part"),
                         F.col("id").alias("q_id"), F.col("v").alias("q"))

    def multiply(key: tuple, shard: pa.Table, group: pa.Table) -> pa.Table:
        size, number = key[0].as_py(), key[1].as_py()
        made = []
        if len(shard) and len(group):
            ids, x = _matrix(shard["id"], shard["v"], size)
            q_ids, q = _matrix(group["q_id"], group["q"], size)
            x, q = integers(x, scale), integers(q, scale)
            for at in range(0, len(q_ids), LINES):
                mine = q_ids[at:at + LINES]
                best = best_of_shard(mine, q[at:at + LINES], ids, x, k)
                taken = best[2].sum(axis=1)
                ends = pa.array(np.concatenate([[0], np.cumsum(taken)]), pa.int32())
                item = pa.StructArray.from_arrays(
                    [pa.array(~best[1][best[2]]), pa.array(best[0][best[2]])], names=["low", "id"])
                made.append(pa.table({"query_id": pa.array(mine), "node": pa.array(np.full(len(mine), number)),
                                      "best": pa.ListArray.from_arrays(ends, item)}))
        return pa.concat_tables(made) if made else pa.table(
            {"query_id": pa.array([], pa.int64()), "node": pa.array([], pa.int64()),
             "best": pa.array([], pa.list_(pa.struct([("low", pa.int64()), ("id", pa.int64())])))})

    key = ["dim", "shard", "part"]
    # ``low`` is the score's complement: ascending order is best first, ties by id.
    lists = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        multiply, "query_id long, node long, best array<struct<low: long, id: long>>")
    nodes = shards
    while nodes > 1:
        lists = (lists.groupBy("query_id", F.floor(F.col("node") / FAN).alias("node"))
                      .agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best")))
        nodes = -(-nodes // FAN)
    return (lists.select("query_id", F.posexplode("best").alias("at", "b"))
                 .select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias("vec_id"),
                         F.bitwise_not("b.low").alias("score")))
