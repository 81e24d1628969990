"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, ``floor(scale * c) + shift``. The fit list is each distinct vector once. With X its rows less
their mean, the method alternates Xv and X'u: ``v`` and all bidiagonal numbers have the size of a vector and are
kept on the driver, each ``u`` has an entry per row and is never stored: it is X times a small vector ``w``, so a task makes the entries of its
rows anew. Every new ``u`` is made orthogonal to all earlier ones (the products are summed over all rows in the
same pass; a second pass follows where more than half of it lay along them), every new ``v`` likewise, twice. Where a product vanishes, the process goes on with a fresh direction, so that repeated eigenvalues are all found.
It ends when the leading singular values of the bidiagonal matrix have converged, at the latest at the vectors' length. The
singular vectors of that small matrix give the components; squared singular values over n are the variances.

A pass is one job over the written fit list; each task sums over its rows in NumPy and gives one row of sums, which Spark adds up by place.
The driver holds vectors and matrices of the vectors' length only. Lengths up to some ten thousand are meant.

Rows whose vector is null or holds a null or non-finite entry are left out. Vectors of each length are fitted by themselves. Empty vectors have
no components; nor have directions without variance (all vectors equal, repeated dimensions), so fewer components than asked for come
back. Entries whose scaled size exceeds 2^45 count as 2^45. ``deviation`` is null where it doesn't fit a long. Null ids are kept; repeated rows give a row each
and count once in the fit. An empty table gives no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.tables import materialize

LIMIT = float(1 << 45)
#: Singular values below this share of the largest are rounding.
ROUNDING = 1e-11
CONVERGED = 1e-15


class Fit(NamedTuple):
    size: int
    n: int
    sums: list[int]
    components: np.ndarray  # a row per component
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole(vectors: DataFrame, scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """``vec_id`` and ``x``, the entries as whole numbers; rows that can't be used are left out."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(LIMIT)), F.lit(-LIMIT))) + shift)
    return rows.where("embedding IS NOT NULL").where(sound).select("vec_id", scaled.alias("x"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``part(x)`` over batches of rows: once per task, then by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(matrix(batch.column(0), size))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    places = rows.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("place", "value"))
    found = places.groupBy("place").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(found, key=lambda r: r["place"])])


def orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            vector = vector - (b @ vector) * b
    return vector


def fresh(basis: list[np.ndarray], size: int, random: np.random.Generator) -> np.ndarray:
    """A unit vector orthogonal to the basis, which doesn't span all."""
    while True:
        vector = orthogonal(random.standard_normal(size), basis)
        length = math.sqrt(vector @ vector)
        if length > 1e-6:
            return vector / length


def bidiagonalised(rows: DataFrame, mean: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors (rows) and singular values of the centred rows, as far as they aren't zero."""
    size = len(mean)
    random = np.random.default_rng(size)
    vs, ws = [fresh([], size, random)], []
    alphas: list[float] = []
    betas: list[float] = []
    largest = 0.0

    def products(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """With y = Xw: the square of its length, its products with all earlier u, and X'y."""
        earlier = np.array(ws).reshape(-1, size)

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            y = centred @ w
            return np.r_[y @ y, (centred @ earlier.T).T @ y, y @ centred]

        found = summed(rows, part, size)
        return found[0], found[1 : 1 + len(ws)], found[1 + len(ws) :]

    while True:
        j = len(ws)
        w = vs[j] - (betas[j - 1] * ws[j - 1] if j else 0.0)
        square, shares, back = products(w)
        for c, u in zip(shares, ws, strict=True):
            w = w - c * u
        left = square - shares @ shares
        if left < square / 2:
            # Much of it lay along earlier ones, so what is left of them by rounding counts: once more.
            square, shares, back = products(w)
            for c, u in zip(shares, ws, strict=True):
                w = w - c * u
            left = square - shares @ shares
        alpha = math.sqrt(max(0.0, left))
        largest = max(largest, alpha)
        if alpha <= ROUNDING * largest or not alpha:
            # Nothing is left in this direction: its row of the bidiagonal matrix is zero.
            alphas.append(0.0)
            ws.append(np.zeros(size))
            rest = np.zeros(size)
        else:
            alphas.append(alpha)
            ws.append(w / alpha)
            # X'u for u = (y - sum of c u) / alpha, less what lies along earlier v
            rest = orthogonal(back / alpha, vs)
        if len(vs) == size:
            break
        beta = math.sqrt(rest @ rest)
        if beta <= ROUNDING * max(largest, beta) or not beta:
            betas.append(0.0)
            vs.append(fresh(vs, size, random))
        else:
            largest = max(largest, beta)
            betas.append(beta)
            vs.append(rest / beta)
            sides, values, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))
            # The residual of a singular value is the next beta times the last entry of its left vector.
            if j + 1 >= components and (beta * np.abs(sides[-1, :components]) <= CONVERGED * values[0]).all():
                vs.pop()
                break
    _, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1))
    kept = values[:components] > ROUNDING * max(values[0], 1e-300)
    return (right[:components] @ np.array(vs))[kept], values[:components][kept]


def fitted(rows: DataFrame, size: int, components: int) -> Fit | None:
    """Components of the distinct vectors of one length."""
    distinct = materialize(rows.groupBy("x").agg(F.count("*").alias("copies")).select("x"), "fit-list")
    each = distinct.mapInArrow(_sums(size), "n long, sums array<long>")
    total = each.select("n", F.posexplode("sums").alias("place", "value")).groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("sum"))
    found = sorted(total.collect(), key=lambda r: r["place"])
    if not found:
        return None
    n, sums = found[0]["n"], [int(r["sum"]) for r in found]
    mean = np.array([s / n for s in sums])

    squares = summed(distinct, lambda x: np.r_[((x - mean) ** 2).sum(), (x - mean).sum(axis=0)], size)
    trace = (squares[0] - (squares[1:] ** 2).sum() / n) / n
    if trace <= 0:
        return Fit(size, n, sums, np.zeros((0, size)), np.zeros(0), np.zeros(0), 0.0)
    vectors, values = bidiagonalised(distinct, mean, components)
    variances = values**2 / n
    scaled = (vectors / np.sqrt(variances)[:, None]).T
    k = len(values)
    centre = summed(distinct, lambda x: ((x - mean) @ scaled).sum(axis=0), size) / n

    def products(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ scaled - centre
        return (white.T @ white).ravel()

    error = np.abs(summed(distinct, products, size).reshape(k, k) / n - np.eye(k)).max()
    return Fit(size, n, sums, vectors, variances, variances / trace, float(error))


def _sums(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, np.int64)
        for batch in batches:
            n += batch.num_rows
            total = total + matrix(batch.column(0), size).sum(axis=0, dtype=np.int64)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], ["n", "sums"])

    return run


APPLIED = "vec_id long, n long, deviation long, whitened array<double>"


def applied(rows: DataFrame, fit: Fit) -> DataFrame:
    """Each row of the fit's length by component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    size, n, sums = fit.size, fit.n, fit.sums
    mean = np.array([s / n for s in sums])
    scaled = (fit.components / np.sqrt(fit.variances)[:, None]).T

    def deviations(x: np.ndarray) -> list[int | None]:
        widest = max(max(abs(n * int(x[:, i].max()) - s), abs(n * int(x[:, i].min()) - s)) for i, s in enumerate(sums))
        if widest * widest * size < 1 << 62:
            d = n * x - np.array(sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = (sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist())
        return [d if d < 1 << 63 else None for d in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1), size)
                white = (x - mean) @ scaled
                columns = [
                    batch.column(0),
                    pa.array(np.full(len(x), n), pa.int64()),
                    pa.array(deviations(x), pa.int64()),
                    pa.array(list(white), pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in APPLIED.split(", ")])

    explained = F.array(*[F.lit(float(e)) for e in fit.explained])
    white = rows.mapInArrow(run, APPLIED).select("vec_id", "n", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return white.select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(fit.identity_error).alias("identity_error"),
    )


def whitened(vectors: DataFrame, components: int = 16, scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """Up to ``components`` rows per usable vector, whitened over the distinct vectors of its length."""
    rows = materialize(whole(vectors.withColumn("vec_id", F.col("vec_id").cast("long")), scale, shift), "whole-vectors")
    sizes = [r["size"] for r in rows.select(F.size("x").alias("size")).where("size > 0").distinct().orderBy("size").collect()]
    out = None
    for size in sizes:
        own = rows.where(F.size("x") == size)
        fit = fitted(own.select("x"), size, components)
        if fit is None or not len(fit.variances):
            continue
        found = applied(own, fit)
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], empty)
    return out
