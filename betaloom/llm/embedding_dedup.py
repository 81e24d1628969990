"""Links between near-equal embeddings by randomly rotated binary codes.

Equal vectors of a label are one class. Unit vectors are turned by random rotations, and the signs of the
turned coordinates are their code. Bands of the code's bits put classes into buckets; the bits of a
band and the number of bands follow from the largest label, so that buckets stay small and a pair at the
threshold misses all bands with a chance of 1e-9. In a bucket the inner product of a class with another is estimated from
the code of the first, divided by the stored correction factor (the product of the vector with its own code), which makes the
estimate unbiased. If the estimate plus its error bound reaches the threshold, the cosine
is computed in double precision and decides; else the pair is dropped. A pair that meets in several bands counts in the first.

Vectors that are null, zero, empty, or hold a null or non-finite component, and those with a null label, link with nothing.
Vectors of different lengths link with nothing. Repeated rows are links of each other, also if they share an id.
A null id is never a component's name unless all its ids are null. An empty table gives no rows. Only ``vec_id``,
``embedding`` and ``label`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.llm.blocks import by_unit, components, forest, in_blocks
from betaloom.tables import materialize

CHANCE = 1e-9
ERRORS = 6.0

CODED = "class binary, unit array<double>, code binary, correction double, bands array<int>"
PARTIAL = "class binary, links long, other binary"


@lru_cache(maxsize=256)
def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def banding(largest: int, threshold: float, chance: float = CHANCE) -> tuple[int, int]:
    """Bits of a band for about a quarter of a chance meeting per class, and the bands needed."""
    bits = min(30, max(4, math.ceil(math.log2(max(2, largest))) + 2))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(chance) / math.log(1 - same))


def codes(classes: DataFrame, bits: int, bands: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, np.ndarray] = {}
        for frame in frames:
            out = frame[["class"]].copy()
            units = [np.array(x, np.float64) for x in frame["embedding"]]
            signs, corrections = [], []
            for x in units:
                x /= np.abs(x).max()
                x /= np.sqrt(x @ x)
            for size in {len(x) for x in units}:
                if size not in known:
                    known[size] = np.vstack([rotation(size, 1 + k) for k in range(-(-bits * bands // size))])
            for size, rows in pd.Series(range(len(units))).groupby([len(x) for x in units]):
                turned = np.stack([units[i] for i in rows]) @ known[size].T
                for i, t in zip(rows, turned, strict=True):
                    signs.append((i, t > 0))
                    corrections.append((i, np.abs(t[:size]).sum() / math.sqrt(size)))
            signs = [s for _, s in sorted(signs, key=lambda x: x[0])]
            power = 1 << np.arange(bits, dtype=np.int64)
            out["unit"] = units
            out["code"] = [np.packbits(s[: len(u)]).tobytes() for s, u in zip(signs, units, strict=True)]
            out["correction"] = [c for _, c in sorted(corrections)]
            out["bands"] = [(s[: bits * bands].reshape(bands, bits) @ power).astype(np.int32) for s in signs]
            yield out

    return classes.select("class", "embedding").mapInPandas(run, CODED)


def linked_pairs(units: np.ndarray, code: np.ndarray, correction: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs have a cosine of at least ``threshold``: estimated from codes, recomputed where the bound allows it."""
    size = units.shape[1]
    turned = (units @ rotation(size, 1).T).astype(np.float32)
    estimate = (code @ turned.T) / (math.sqrt(size) * correction[:, None])
    spread = np.sqrt(np.maximum(0, 1 - correction**2)) / (correction * math.sqrt(max(1, size - 1)))
    open_pairs = estimate + ERRORS * spread[:, None] >= threshold
    a, b = np.nonzero(np.triu(open_pairs & open_pairs.T, 1))
    out = np.zeros((len(units), len(units)), bool)
    for low in range(0, len(a), 1 << 16):
        i, j = a[low : low + (1 << 16)], b[low : low + (1 << 16)]
        cosine = np.einsum("ij,ij->i", units[i], units[j])
        near = cosine >= threshold
        out[i[near], j[near]] = True
    return out


def links(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    sound = F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    name = F.unhex(F.md5(F.to_json(F.struct("label", "embedding")).cast("binary")))
    rows = rows.withColumn("class", F.when(F.coalesce(sound, F.lit(False)), name))
    held = materialize(rows, "vectors")
    classes = held.where("class IS NOT NULL").groupBy("class").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    classes = materialize(classes, "vector-classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, bands = banding(largest, threshold)
    coded = materialize(codes(classes, bits, bands), "codes")

    keyed = coded.join(classes.select("class", "label", "weight"), "class").withColumn("size", F.size("unit"))
    spread = keyed.select("class", F.posexplode("bands").alias("band", "bucket"), "label", "size")
    keys = ["label", "size", "band", "bucket"]
    buckets = spread.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    dealt = in_blocks(spread.select("class", *keys).join(buckets, keys), F.col("n"), F.col("class"))
    dealt = dealt.select("class", *keys, "own", "i", "j").join(coded, "class").join(classes.select("class", "weight"), "class")

    def compare(frame: pd.DataFrame) -> pd.DataFrame | None:
        units = np.stack(list(frame["unit"]))
        code = np.stack([np.unpackbits(np.frombuffer(c, np.uint8), count=units.shape[1]) for c in frame["code"]]).astype(np.float32) * 2 - 1
        near = linked_pairs(units, code, frame["correction"].to_numpy(), threshold)
        if frame["i"].iloc[0] != frame["j"].iloc[0]:
            own = frame["own"].to_numpy()
            near &= own[:, None] != own
        if not near.any():
            return None
        for earlier in np.stack([b[: frame["band"].iloc[0]] for b in frame["bands"]]).T:
            near &= earlier[:, None] != earlier
        near |= near.T
        some = np.flatnonzero(near.any(axis=1))
        if not len(some):
            return None
        parent = np.arange(len(near))
        for child, up in forest(near):
            parent[child] = up
        names = frame["class"].to_numpy()
        found = near[some].astype(np.int64) @ frame["weight"].to_numpy()
        return pd.DataFrame({"class": names[some], "links": found, "other": names[parent[some]]})

    columns = ["class", *keys, "own", "i", "j", "unit", "code", "correction", "bands", "weight"]
    found = materialize(by_unit(dealt.select(*columns), [*keys, "i", "j"], compare, PARTIAL), "links")
    totals = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class").alias("a"), F.col("other").alias("b")))
    named = classes.join(totals, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = named.select("class", "first_id", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "class").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "root").select("class", "component_id", (F.col("links") + F.col("weight") - 1).alias("links"))
    out = held.select("vec_id", "class").join(materialize(named, "named"), "class", "left")
    alone = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), alone.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
