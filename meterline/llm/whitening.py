"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on the triangular factor.

Entries become whole numbers, ``x = floor(scale * c) + offset``. The fit uses
every distinct x vector once. With A the scatter of the centred fit vectors,

1. pivoted Cholesky gives A = L L' with L's rows permuted, and stops at the
   numerical rank;
2. one-sided Jacobi rotates L's columns until they are orthogonal. Their squared
   norms are A's eigenvalues and the normalised columns its eigenvectors: A
   itself is never rotated, so small eigenvalues keep their accuracy.

A vector is whitened by projecting its centred x on a component and dividing by
the square root of that component's eigenvalue (of the covariance, divisor n).

Centring comes before any product: sums are exact integers, a whole number near
the mean is taken off first (exact), the fraction left after it.

Scale: distinct vectors come from a partial aggregate, so one vector on a third
of all rows costs no task more; they are stored once and read three times, for
sums, scatter and check. Tasks send one d x d matrix each, added up in two levels
per matrix row; the decomposition is one task per vector length over d rows.
Only d sums and 16 components per length reach the driver, whose size follows
the vectors' length, not the rows.

Defined cases: vectors that are NULL or hold NULL or non-finite entries are
dropped; rows without an id stay. Rows that repeat an id all stay. Vectors of
different lengths are fitted apart. Fewer components than asked for are returned
where the fit has a smaller rank: none for a single distinct vector, an empty
vector or an empty table, so such rows give no rows. Entries beyond 2^40 after
scaling count as 2^40. A deviation beyond a long is NULL. Equal eigenvalues may
come in any order, and components have either sign, alike for all rows. Only the
two named columns are read; others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import written
from meterline.llm.topk import finite

#: Entries stay within this, so sums of a task's vectors fit a long.
LIMIT = 2 ** 40
#: Jacobi ends when no two columns are less orthogonal than this.
ORTHOGONAL = 1e-15
SWEEPS = 60
#: Branches of the two-level addition of the tasks' matrices.
BRANCHES = 256


def whole_numbers(vector: Column, scale: int, offset: int) -> Column:
    """floor(scale * c) + offset of every entry, as longs."""
    limit = F.lit(float(LIMIT))
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(c * scale, -limit), limit)) + offset)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (d x rank, rows in the order of ``a``) with a = L L'."""
    a, d = a.copy(), len(a)
    rows, factor = np.arange(d), np.zeros((d, d))
    floor = d * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for j in range(d):
        p = j + int(np.argmax(a.diagonal()[j:]))
        if not a[p, p] > floor:
            factor = factor[:, :j]
            break
        for m in (a, factor):
            m[[j, p]] = m[[p, j]]
        a[:, [j, p]] = a[:, [p, j]]
        rows[[j, p]] = rows[[p, j]]
        factor[j, j] = np.sqrt(a[j, j])
        factor[j + 1:, j] = a[j + 1:, j] / factor[j, j]
        a[j + 1:, j + 1:] -= np.outer(factor[j + 1:, j], factor[j + 1:, j])
    out = np.empty_like(factor)
    out[rows] = factor
    return out


def rounds(m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A round-robin schedule: every two of ``m`` columns meet once, in rounds of
    disjoint pairs."""
    seats = list(range(m + m % 2))
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        met = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if a < m and b < m]
        yield np.array([p[0] for p in met]), np.array([p[1] for p in met])
        seats = [seats[0], seats[-1], *seats[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of factor factor' (falling) and unit eigenvectors (columns)."""
    g = factor.copy()
    for _ in range(SWEEPS):
        worst = 0.0
        for i, j in rounds(g.shape[1]):
            x, y = g[:, i], g[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > ORTHOGONAL
            zeta = (yy - xx) / (2 * np.where(turn, xy, 1.0))
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            g[:, i], g[:, j] = c * x - c * t * y, c * t * x + c * y
        if worst <= ORTHOGONAL:
            break
    norms = np.sqrt((g * g).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


class Centre:
    """n and the exact sums of one length's fit vectors."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        near = [(2 * s + n) // (2 * n) for s in sums]
        self.near = np.array(near, "i8")
        self.rest = np.array([(s - n * m) / n for s, m in zip(sums, near)])   # -0.5 .. 0.5
        self.whole_rest = [s - n * m for s, m in zip(sums, near)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
        about = (self.centred(x) ** 2).sum(axis=1) * float(self.n) ** 2
        # Sums that fit a long come out right modulo 2^64.
        off = ((x - self.near).astype("u8") * np.uint64(self.n % 2 ** 64)
               - np.array([w % 2 ** 64 for w in self.whole_rest], "u8"))
        low = (off * off).sum(axis=1, dtype="u8").astype("i8")
        out = [int(v) if a < 2.0 ** 62 else None for v, a in zip(low, about)]
        for i in np.flatnonzero(about >= 2.0 ** 62):
            exact = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums))
            out[i] = exact if exact < 2 ** 63 else None
        return out


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) for each length in a batch whose last column is x."""
    x = batch.column(batch.num_columns - 1)
    sizes = x.value_lengths().to_numpy()
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        mine = x if len(at) == len(sizes) else x.take(pa.array(at))
        yield int(dim), at, mine.flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)


def _slot() -> int:
    return TaskContext.get().partitionId()


def centres_of(fit: DataFrame) -> dict[int, Centre]:
    """n and sums of every length, from one partial sum a task."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = {}, {}
        for batch in batches:
            for dim, _, x in _vectors(batch):
                n[dim] = n.get(dim, 0) + len(x)
                part = [int(v) for v in x.sum(axis=0)]
                sums[dim] = [a + b for a, b in zip(sums[dim], part)] if dim in sums else part
        yield pa.RecordBatch.from_pydict(
            {"dim": pa.array(n.keys(), pa.int32()), "n": pa.array(n.values(), pa.int64()),
             "s": pa.array([[str(v) for v in sums[d]] for d in n], pa.list_(pa.string()))})
    parts = fit.mapInArrow(add, "dim int, n long, s array<string>")
    total = (parts.select("dim", "n", F.posexplode("s").alias("at", "s"))
                  .groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for r in total.collect():                       # one row per length and dimension
        found.setdefault(r["dim"], {})[r["at"]] = (r["n"], int(r["s"]))
    return {d: Centre(rows[0][0], [rows[i][1] for i in range(d)]) for d, rows in found.items()}


def scatter_rows(vectors: DataFrame, project: dict[int, np.ndarray] | None,
                 centres: dict[int, Centre]) -> DataFrame:
    """dim, at, v: row ``at`` of the sum of y y' over ``vectors``, y the centred
    vector, multiplied by ``project`` if given."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _vectors(batch):
                if dim in centres and (project is None or dim in project):
                    y = centres[dim].centred(x)
                    y = y if project is None else y @ project[dim]
                    sums[dim] = sums.get(dim, 0) + y.T @ y
        for dim, m in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"dim": pa.array([dim] * len(m), pa.int32()), "at": pa.array(range(len(m)), pa.int32()),
                 "slot": pa.array([_slot()] * len(m), pa.int32()),
                 "v": pa.array(list(m), pa.list_(pa.float64()))})

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("slot")                 # the same sum whatever order tasks end in
        v = rows["v"].combine_chunks()
        total = v.flatten().to_numpy().reshape(len(rows), -1).sum(axis=0)
        return rows.slice(0, 1).select(["dim", "at", "slot"]).append_column(
            "v", pa.array([total], pa.list_(pa.float64())))

    schema = "dim int, at int, slot int, v array<double>"
    parts = vectors.mapInArrow(multiply, schema)
    return (parts.groupBy("dim", "at", F.pmod("slot", F.lit(BRANCHES))).applyInArrow(add, schema)
                 .groupBy("dim", "at").applyInArrow(add, schema))


def decomposed(scatter: DataFrame, centres: dict[int, Centre], k: int) -> DataFrame:
    """dim, component (from 1), e (of the covariance), explained, v (unit vector)."""
    ns = {d: c.n for d, c in centres.items()}

    def solve(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        dim = rows["dim"][0].as_py()
        a = rows["v"].combine_chunks().flatten().to_numpy().reshape(dim, dim)
        values, v = one_sided_jacobi(pivoted_cholesky(a))
        top = min(k, len(values))
        return pa.table({"dim": pa.array([dim] * top, pa.int32()),
                         "component": pa.array(range(1, top + 1), pa.int32()),
                         "e": pa.array(values[:top] / ns[dim], pa.float64()),
                         "explained": pa.array(values[:top] / a.trace(), pa.float64()),
                         "v": pa.array(list(v[:, :top].T), pa.list_(pa.float64()))})
    return scatter.groupBy("dim").applyInArrow(
        solve, "dim int, component int, e double, explained double, v array<double>")


def whiten(vectors: DataFrame, k: int = 16, scale: int = 64, offset: int = 1_000_000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of
    every usable row and its first ``k`` components."""
    usable = vectors.filter(finite(F.col(vector_col)))
    rows = usable.select(F.col(id_col).alias("vec_id"),
                         whole_numbers(F.col(vector_col).cast("array<double>"), scale, offset).alias("x"))
    fit = written(rows.select("x").distinct(), "fit")
    centres = centres_of(fit)
    turn: dict[int, np.ndarray] = {}
    share: dict[int, np.ndarray] = {}
    found = decomposed(scatter_rows(fit, None, centres), centres, k).collect()   # k vectors a length
    for dim in {r["dim"] for r in found}:
        mine = sorted((r for r in found if r["dim"] == dim), key=lambda r: r["component"])
        turn[dim] = np.array([np.array(r["v"]) / np.sqrt(r["e"]) for r in mine]).T
        share[dim] = np.array([r["explained"] for r in mine])
    error = {dim: 0.0 for dim in turn}
    for r in scatter_rows(fit, turn, centres).collect():                         # k x k a length
        unit = np.arange(len(r["v"])) == r["at"]
        error[r["dim"]] = max(error[r["dim"]],
                              float(np.abs(np.array(r["v"]) / centres[r["dim"]].n - unit).max()))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _vectors(batch):
                if dim not in turn:
                    continue
                m, top = len(x), turn[dim].shape[1]
                ids = batch.column(0).take(pa.array(at))
                line = np.repeat(np.arange(m), top)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids.take(pa.array(line)),
                    "component": pa.array(np.tile(np.arange(1, top + 1, dtype="i4"), m)),
                    "n": pa.array(np.full(m * top, centres[dim].n)),
                    "deviation": pa.array(centres[dim].deviations(x), pa.int64()).take(pa.array(line)),
                    "whitened": pa.array((centres[dim].centred(x) @ turn[dim]).ravel()),
                    "explained": pa.array(np.tile(share[dim], m)),
                    "identity_error": pa.array(np.full(m * top, error[dim]))})
    kind = dict(rows.dtypes)["vec_id"]
    return rows.mapInArrow(project, f"vec_id {kind}, component int, n long, deviation long, "
                                    "whitened double, explained double, identity_error double")
