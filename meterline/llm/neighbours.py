"""Approximate nearest neighbours by randomly rotated one-bit codes.

Each vector, less the centroid, is rotated at random and kept as the signs of
its components: one bit each, with two correction scalars (its length r, and f,
how far its unit vector leans towards its code). For a query q the inner
product with a vector o = c + r u is estimated from the code s of u as

    <c, q> + r <s, Rq> / (f sqrt(D))

and the error is at most r |q| sqrt(1 / f^2 - 1) e / sqrt(D - 1) with high
probability (e = ``BOUND``). A query first scores its most promising vectors
exactly; a vector is then scored exactly ("reranked") only if its estimate plus
its bound reaches the k-th best found. Queries therefore read packed bits and a
few full vectors.

The index has every vector, in blocks of ``BLOCK``; the centroid is a mean over
all of them and the rotation is seeded. A stated set of queries is searched
against all rows: query blocks meet vector blocks through an equi-join on the
block number, each pair of blocks yields at most k rows per query, and a window
keeps the best k.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite
components take no part, nor do rows without an id. Vectors meet only vectors
of their own length. Rows that repeat an id count once, with the smallest of
their vectors. Ties go to the smaller id. With fewer than k candidates all are
returned; an empty table gives an empty result. Only the two named columns are
read; others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import batch_rows, written

#: Vectors of an index block and queries of a query block.
BLOCK, QUERIES = 8192, 256
#: Standard errors within which an estimate is trusted.
BOUND = 2.5


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, r and f of each row of ``x``."""
    rest = x - centre
    r = np.linalg.norm(rest, axis=1)
    u = (rest / np.where(r > 0, r, 1)[:, None]) @ turn.T
    bits = u >= 0
    f = np.abs(u).sum(axis=1) / np.sqrt(x.shape[1])
    return np.packbits(bits, axis=1), r, np.where(r > 0, f, 1.0)


def estimate(codes: np.ndarray, r: np.ndarray, f: np.ndarray, centre: np.ndarray, turn: np.ndarray,
             q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and their bounds."""
    dim = len(centre)
    signs = np.unpackbits(codes, axis=1, count=dim).astype("f4") * 2 - 1
    guess = ((q @ turn.T).astype("f4") @ signs.T) * (r / (f * np.sqrt(dim))).astype("f4")
    guess += (q @ centre).astype("f4")[:, None]
    spread = r * np.sqrt(np.maximum(1 / f ** 2 - 1, 0)) * BOUND / np.sqrt(max(dim - 1, 1))
    return guess, np.linalg.norm(q, axis=1)[:, None].astype("f4") * spread.astype("f4")


def best_of_block(q_id: int, q: np.ndarray, guess: np.ndarray, bound: np.ndarray, ids: np.ndarray,
                  x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The query's k best of one block: ids and exact scores."""
    def exact(rows: np.ndarray) -> np.ndarray:
        return (x[rows] * q).sum(axis=1)   # row by row alike: equal vectors tie

    mine = ids == q_id
    if mine.any():
        guess = np.where(mine, -np.inf, guess)
    first = np.argpartition(-guess, min(2 * k, len(guess) - 1))[:2 * k]
    first = first[~mine[first]]
    floor = np.sort(exact(first))[-k] if len(first) >= k else -np.inf
    rows = np.flatnonzero((guess + bound >= floor) & ~mine)
    rows = np.union1d(rows, first)
    s = exact(rows)
    order = np.lexsort((ids[rows], -s))[:k]
    return ids[rows][order], s[order]


def _packed(df: DataFrame, block: Column) -> DataFrame:
    """One row per (dim, block): ids and vectors as bytes."""
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        x = np.array(rows["v"].tolist(), "<f8")
        return pd.DataFrame({"dim": [int(rows["dim"].iloc[0])], "block": [int(rows["block"].iloc[0])],
                             "ids": [rows["id"].to_numpy("<i8").tobytes()], "x": [x.tobytes()]})
    return df.withColumn("block", block).groupBy("dim", "block").applyInPandas(
        pack, "dim int, block long, ids binary, x binary")


def build_index(vectors: DataFrame, id_col: str, vector_col: str,
                seed: int) -> tuple[DataFrame, DataFrame, dict[int, np.ndarray]]:
    """(usable vectors: id, v, dim; index: one row per block with codes and
    scalars; centroid by dimension)."""
    v = F.col(vector_col).cast("array<double>")
    rows = (vectors.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), v.alias("v"))
                   .filter(usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))
                   .withColumn("dim", F.size("v")))
    rows = written(rows, "vectors")
    # One number per dimension and place: the mean of all vectors.
    sums = (rows.select("dim", F.posexplode("v").alias("at", "x"))
                .groupBy("dim", "at").agg(F.avg("x").alias("m"), F.count(F.lit(1)).alias("n")).collect())
    centres: dict[int, np.ndarray] = {}
    counts: dict[int, int] = {}
    for r in sums:
        centres.setdefault(r["dim"], np.zeros(r["dim"]))[r["at"]] = r["m"]
        counts[r["dim"]] = r["n"]
    if not counts:
        blocks = F.lit(1)
    else:
        blocks = F.coalesce(*[F.when(F.col("dim") == d, -(-n // BLOCK)) for d, n in counts.items()])
    packed = _packed(rows, F.pmod(F.xxhash64("id"), blocks))

    def codes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = {c: [] for c in ("codes", "r", "f")}
            for dim, x in zip(f["dim"], f["x"]):
                got = encode(np.frombuffer(x, "<f8").reshape(-1, dim), centres[dim], rotation(dim, seed))
                for c, a in zip(out, got):
                    out[c].append(a.tobytes())
            yield f.assign(**out)
    index = written(packed.mapInPandas(codes, "dim int, block long, ids binary, x binary, "
                                              "codes binary, r binary, f binary"), "index")
    return rows, index, centres


def search(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", seed: int = 7) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest of every row for
    which ``queries`` (a condition on the column ``id``) holds."""
    with batch_rows(vectors.sparkSession, 8):   # rows are blocks
        return written(_nearest(vectors, queries, k, id_col, vector_col, seed), "nearest")


def _nearest(vectors: DataFrame, queries: Column, k: int, id_col: str, vector_col: str,
             seed: int) -> DataFrame:
    rows, index, centres = build_index(vectors, id_col, vector_col, seed)
    asked = rows.filter(queries)
    per_dim = {r["dim"]: r["n"] for r in
               asked.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = F.coalesce(*[F.when(F.col("dim") == d, -(-n // QUERIES)) for d, n in per_dim.items()],
                       F.lit(1))
    packed = _packed(asked, F.pmod(F.xxhash64("id"), parts)).select(
        "dim", F.col("ids").alias("q_ids"), F.col("x").alias("q"))
    blocks = index.groupBy("dim").agg(F.max("block").alias("last"))
    # Every query block goes to every index block of its dimension.
    meet = (packed.join(blocks, "dim")
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")
                  .join(index, ["dim", "block"]))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                dim = row.dim
                ids, x = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.x, "<f8").reshape(-1, dim)
                q_ids, q = np.frombuffer(row.q_ids, "<i8"), np.frombuffer(row.q, "<f8").reshape(-1, dim)
                codes = np.frombuffer(row.codes, "u1").reshape(len(ids), -1)
                guess, bound = estimate(codes, np.frombuffer(row.r), np.frombuffer(row.f), centres[dim],
                                        rotation(dim, seed), q)
                found = [best_of_block(q_ids[i], q[i], guess[i], bound[i], ids, x, k)
                         for i in range(len(q_ids))]
                yield pd.DataFrame({"query_id": np.repeat(q_ids, [len(a) for a, _ in found]),
                                    "vec_id": np.concatenate([a for a, _ in found]),
                                    "score": np.concatenate([s for _, s in found])})

    near = meet.mapInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
