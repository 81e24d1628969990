"""Principal components of a long matrix of any width, by block power iteration with Rayleigh-Ritz steps.

With X the matrix of samples by probes less the probe means, the sample side holds a block of ``u`` vectors as a short
array per sample. One step forms Z = X'U (join by sample, sums per probe) and W = XZ (join by probe, sums per sample): two equi-joins and
two partial aggregations over the long rows, whatever the width. No sample or probe is ever packed into a row, and only matrices
of the block's size reach the driver.

Plain power iteration converges as slowly as the spectrum is flat. The steps' blocks are therefore kept: a basis V of up to
``BASIS`` blocks with W = XX'V beside it gives the best vectors inside their span (a small symmetric eigenproblem on the driver), and
the residual of the wanted vectors, made orthogonal to the basis by its Gram matrix, is the next block. A full basis is cut down to
its best vectors and goes on. It ends when every wanted residual is below ``tolerance`` times the largest eigenvalue, or raises.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.functions.blocks import mapped, summed
from betaloom.operators.quality import SAMPLE
from betaloom.tables import materialize

#: Vectors of a block beyond those asked for.
SPARE = 6
#: Blocks in the basis before it is cut down, and blocks kept then.
BASIS, KEPT = 6, 2
#: A direction of a residual block whose share of its largest is below this waits for a later block: it would be mostly rounding.
ROUNDING = 1e-4
#: An eigenvalue below this share of the matrix's own squares is rounding of a matrix that doesn't vary.
ROUNDED = 1e-26


def check_complete(values: DataFrame) -> tuple[int, float]:
    """Number of samples of a matrix in which every sample has a value of every probe (else ValueError), and its sum of squares."""
    per_sample = values.groupBy(*SAMPLE).agg(F.count("value").alias("n"), F.sum(F.col("value") ** 2).alias("squares"))
    samples, least, most, squares = per_sample.agg(F.count("*"), F.min("n"), F.max("n"), F.sum("squares")).first()
    probes = values.agg(F.count_distinct("probe_id")).first()[0]
    if samples and not (least == most == probes):
        raise ValueError("principal components need a matrix without missing values; impute or drop them first")
    return samples, squares or 0.0


def to_probes(values: DataFrame, block: DataFrame, size: int) -> DataFrame:
    """Z = X'U: (probe_id, z0, z1, ...)."""
    wide = block.select(*SAMPLE, *[F.get("u", i).alias(f"u{i}") for i in range(size)])
    sums = [F.sum(F.col("value") * F.col(f"u{i}")).alias(f"z{i}") for i in range(size)]
    return materialize(values.join(wide, SAMPLE).groupBy("probe_id").agg(*sums), "probe-block")


def to_samples(values: DataFrame, probes: DataFrame, size: int) -> DataFrame:
    """W = XZ: (sample, w), not yet centred."""
    sums = [F.sum(F.col("value") * F.col(f"z{i}")).alias(f"w{i}") for i in range(size)]
    wide = values.join(probes, "probe_id").groupBy(*SAMPLE).agg(*sums)
    return wide.select(*SAMPLE, F.array(*[f"w{i}" for i in range(size)]).alias("w"))


def start_block(values: DataFrame, size: int, n: int) -> tuple[DataFrame, int]:
    """Seeded numbers per sample that don't depend on partitions, orthonormal and centred; and how many vectors they are."""
    samples = values.select(*SAMPLE).distinct()
    drawn = [F.xxhash64(*SAMPLE, F.lit(i)).cast("double") / float(1 << 63) for i in range(size)]
    block = materialize(samples.select(*SAMPLE, F.array(*drawn).alias("u")), "start-block")
    mean = summed(block, ["u"], lambda u: u.sum(axis=0), (size,)) / n
    gram = summed(block, ["u"], lambda u: (u - mean).T @ (u - mean), (size, size))
    turn = whitener(gram, ROUNDING)
    return mapped(block, SAMPLE, ["u"], lambda u: [(u - mean) @ turn], ["u"]), turn.shape[1]


def whitener(gram: np.ndarray, share: float) -> np.ndarray:
    """T with T'GT = 1 over the directions of a Gram matrix that have more than ``share`` of the largest length."""
    lengths, vectors = np.linalg.eigh(gram)
    kept = lengths > max(lengths[-1], 0.0) * share**2
    kept &= lengths > 0
    return vectors[:, kept] / np.sqrt(lengths[kept])


def leading(values: DataFrame, k: int, tolerance: float, most_steps: int) -> tuple[DataFrame, np.ndarray]:
    """(sample, v) with the ``k`` leading unit vectors of XX' (fewer if its rank is less), and their eigenvalues."""
    n, squares = check_complete(values)
    size = min(k + SPARE, max(n - 1, 0))
    if not size:
        return values.select(*SAMPLE).distinct().select("*", F.array().cast("array<double>").alias("v")), np.zeros(0)
    block, width = start_block(values, size, n)
    basis, b = None, 0
    for _ in range(most_steps):
        fresh = block.join(to_samples(values, to_probes(values, block, width), width), SAMPLE)
        if basis is None:
            joined = fresh.select(*SAMPLE, F.col("u").alias("v"), "w")
        else:
            joined = basis.join(fresh.withColumnRenamed("w", "x"), SAMPLE)
            joined = joined.select(*SAMPLE, F.concat("v", "u").alias("v"), F.concat("w", "x").alias("w"))
        basis, b = materialize(joined, "basis"), b + width
        sums = summed(basis, ["v", "w"], lambda v, w: np.vstack([v.T @ w, w.sum(axis=0)]), (b + 1, b))
        # the columns of V add up to nothing, so only W needs centring
        product, mean = sums[:b], sums[b] / n
        eigenvalues, vectors = np.linalg.eigh((product + product.T) / 2)
        order = np.argsort(-eigenvalues)
        eigenvalues, vectors = eigenvalues[order], vectors[:, order]
        largest = eigenvalues[0] if eigenvalues[0] > ROUNDED * squares else 0.0
        top, theta = vectors[:, :size], eigenvalues[:size]
        first = product @ top - top * theta

        def residual(v, w, mean=mean, top=top, theta=theta, first=first):
            return (w - mean) @ top - (v @ top) * theta - v @ first

        def products(v, w, residual=residual):
            r = residual(v, w)
            return np.vstack([v.T @ r, r.T @ r])

        both = summed(basis, ["v", "w"], products, (b + len(theta), len(theta)))
        second, gram = both[:b], both[b:]
        gram = gram - second.T @ second
        lengths = np.sqrt(np.maximum(np.diag(gram), 0.0))
        if largest == 0 or (lengths[:k] <= tolerance * largest).all() or b >= n - 1:
            rank = min(k, int((theta > 1e-12 * largest).sum())) if largest else 0
            found = mapped(basis, SAMPLE, ["v"], lambda v: [v @ top[:, :rank]], ["v"]) if rank else basis.select(*SAMPLE, F.array().cast("array<double>").alias("v"))
            return materialize(found, "leading"), theta[:rank]
        # vectors that have converged add no direction
        open_ones = lengths > tolerance * largest / 10
        unit = np.zeros((len(theta), int(open_ones.sum())))
        unit[open_ones] = np.diag(1 / lengths[open_ones])
        turn = unit @ whitener(unit.T @ gram @ unit, ROUNDING)
        turn = turn[:, -max(1, n - 1 - b) :]

        def following(v, w, residual=residual, second=second, turn=turn):
            return [v, (residual(v, w) - v @ second) @ turn]

        rough = materialize(mapped(basis, SAMPLE, ["v", "w"], following, ["v", "u"]), "block")
        block, width = orthonormal(rough, b, turn.shape[1], n)
        if b >= BASIS * size:
            keep, held = vectors[:, : KEPT * size], mean
            basis, b = mapped(basis, SAMPLE, ["v", "w"], lambda v, w, keep=keep, held=held: [v @ keep, (w - held) @ keep], ["v", "w"]), keep.shape[1]
    raise ArithmeticError(f"components haven't converged after {most_steps} steps")


def orthonormal(rough: DataFrame, b: int, width: int, n: int) -> tuple[DataFrame, int]:
    """The block (sample, u) of a rough one beside its basis, centred, orthonormal and orthogonal to the basis to rounding."""
    sums = summed(rough, ["v", "u"], lambda v, u: np.vstack([v.T @ u, u.T @ u, u.sum(axis=0)]), (b + width + 1, width))
    along, gram, mean = sums[:b], sums[b:-1], sums[-1] / n
    turn = whitener(gram - n * np.outer(mean, mean) - along.T @ along, 1e-2)
    return mapped(rough, SAMPLE, ["v", "u"], lambda v, u: [(u - mean - v @ along) @ turn], ["u"]), turn.shape[1]


def principal_components(values: DataFrame, k: int = 10, tolerance: float = 1e-10, most_steps: int = 300) -> DataFrame:
    """Sample scores PC1..PCk of a complete matrix, centred.

    Each component is oriented so that its largest loading is positive (of equal ones the least probe's). Components beyond the rank are zero.
    """
    vectors, eigenvalues = leading(values, k, tolerance, most_steps)
    rank = len(eigenvalues)
    signs = [F.lit(1.0)] * rank
    if rank:
        loadings = to_probes(values, vectors.select(*SAMPLE, F.col("v").alias("u")), rank)
        best = [F.max_by(F.signum(f"z{i}"), F.struct(F.abs(F.col(f"z{i}")), F.col("probe_id"))).alias(f"s{i}") for i in range(rank)]
        row = loadings.agg(*best).first()
        signs = [F.lit(float(s) or 1.0) for s in row]
    scores = [F.get("v", i) * (signs[i] * float(np.sqrt(max(eigenvalues[i], 0.0)))) for i in range(rank)] + [F.lit(0.0)] * (k - rank)
    return vectors.select(*SAMPLE, *[s.alias(f"PC{i + 1}") for i, s in enumerate(scores)])
