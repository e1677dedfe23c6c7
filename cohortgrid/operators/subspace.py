"""Principal components of a long table of which both sides are large, by a block Krylov method."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Vectors of a block beyond the components asked for, blocks of a basis before a restart, and bytes of vectors that are broadcast.
EXTRA, MOST_BLOCKS, BROADCAST_BYTES = 4, 12, 8 << 20


def _times(cells: DataFrame, by: str, vectors: DataFrame, on: str, width: int, rows: int) -> DataFrame:
    """``(by, z)``: the cells' matrix times the ``width`` vectors ``v`` of ``(on, v)``.

    Few vectors are broadcast, so the cells are not shuffled at all. More are joined by ``on``: then it has so many values that none holds
    a large part of the cells, since each has at most one cell with each value of ``by``. The sums are combined before their shuffle.
    """
    side = F.broadcast(vectors) if rows * width * 8 <= BROADCAST_BYTES else vectors
    sums = [F.sum(F.col("value") * F.col("v")[i]).alias(f"z{i}") for i in range(width)]
    return cells.join(side, on).groupBy(by).agg(*sums).select(by, F.array(*(f"z{i}" for i in range(width))).alias("z"))


def _products(basis: DataFrame, name: str) -> np.ndarray:
    """The basis ``v`` and the block ``name`` of all features, stacked, times the block: partial products of partitions are added up."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                z = np.stack(pdf[name])
                whole = np.hstack([np.stack(pdf["v"]), z])
                total = whole.T @ z if total is None else total + whole.T @ z
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "x": total.ravel()})

    found = basis.select("v", name).mapInPandas(partial, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    out = np.zeros((max(r.i for r in found) + 1, max(r.j for r in found) + 1))
    for r in found:
        out[r.i, r.j] = r.x
    return out


def _combined(column: str, weights: np.ndarray) -> Column:
    """The vectors of an array column times a small matrix."""
    at = lambda j: F.aggregate(F.zip_with(column, F.array(*map(F.lit, map(float, weights[:, j]))), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
    return F.array(*(at(j) for j in range(weights.shape[1])))


def _orthonormal(basis: DataFrame, name: str, scale: float) -> tuple[DataFrame, np.ndarray, np.ndarray, int]:
    """The block ``name`` freed of the basis and made orthonormal, twice since one pass leaves rounding errors.

    Returns the table, the products of the basis with the block, the products of the block's remainder with itself, and
    how many directions are left: those shorter than the rounding of ``scale`` are none.
    """
    along = rest = None
    for turn in range(2):
        both = _products(basis, name)
        m = both.shape[0] - both.shape[1]
        c, own = both[:m], both[m:] - both[:m].T @ both[:m]
        if turn == 0:
            along, rest = c, own
        values, turned = np.linalg.eigh((own + own.T) / 2)
        good = values > (max(scale, 1e-300) * 1e-11) ** 2 if turn == 0 else values > 0.25
        w = turned[:, good] / np.sqrt(values[good])
        if not w.shape[1]:
            return basis, along, rest, 0
        z = _combined(name, w)
        if m:
            z = F.zip_with(z, _combined("v", c @ w), lambda a, b: a - b)
        basis = materialise(basis.select("feature", "v", z.alias(name)), "block")
    return basis, along, rest, w.shape[1]


def leading_vectors(cells: DataFrame, k: int, tolerance: float = 1e-9, restarts: int = 40) -> tuple[DataFrame, np.ndarray]:
    """``(feature, v)`` with the ``k`` leading right singular vectors of centred ``cells`` ``(sample, feature, value)``, and the squared singular values.

    Each round multiplies the newest block by the matrix and its transpose, and adds what is new in it to an orthonormal basis
    of features, which is kept as a table. Eigenvalues are those of the products of the basis with itself under the matrix. Vectors are
    right when what the matrix moves them out of their direction is below ``tolerance`` of the largest eigenvalue. A full basis is
    cut to its leading vectors. Only matrices of the size of the basis, at most a few hundred, come to the driver. A matrix of smaller rank has
    fewer vectors, an empty or constant one none.
    """
    width = k + EXTRA
    n_features, n_samples = cells.agg(F.count_distinct("feature"), F.count_distinct("sample")).first()
    draws = F.array(*(F.xxhash64("feature", F.lit(i)).cast("double") / float(1 << 63) for i in range(width)))
    start = cells.select("feature").distinct().select("feature", F.array().cast("array<double>").alias("v"), draws.alias("z"))
    if not n_features:
        return start.select("feature", "v"), np.zeros(0)
    basis, *_, q = _orthonormal(materialise(start, "block"), "z", 1.0)
    inner, size, top = np.zeros((0, 0)), 0, 0.0
    for _ in range(restarts * MOST_BLOCKS):
        basis = basis.select("feature", F.concat("v", "z").alias("v"), F.col("z").alias("new"))
        size += q
        y = materialise(_times(cells, "sample", basis.select("feature", F.col("new").alias("v")), "feature", q, n_features), "scores")
        z = _times(cells, "feature", y.select("sample", F.col("z").alias("v")), "sample", q, n_samples)
        basis = materialise(basis.select("feature", "v").join(z, "feature"), "block")
        block, along, rest, more = _orthonormal(basis, "z", top)
        # The newest columns of the matrix within the basis; it is symmetric.
        grown = np.zeros((size, size))
        grown[: size - q, : size - q] = inner
        grown[:, size - q :] = along
        grown[size - q :, :] = along.T
        inner = grown
        values, turned = np.linalg.eigh((inner + inner.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        top = values[0]
        last = turned[size - q :, :k]
        moved = np.sqrt(np.maximum(0, np.einsum("ij,ik,kj->j", last, rest, last)))
        if not more or (size >= k and (moved <= tolerance * max(top, 1e-300)).all()):
            # Vectors of no variance are none.
            good = [j for j in range(min(k, size)) if values[j] > max(top, 1e-300) * 1e-12]
            return basis.select("feature", _combined("v", turned[:, good]).alias("v")), values[good]
        if size + more > width * MOST_BLOCKS:
            q = min(width, size)
            kept = basis.select("feature", F.array().cast("array<double>").alias("v"), _combined("v", turned[:, :q]).alias("z"))
            basis, inner, size = materialise(kept, "block"), np.zeros((0, 0)), 0
        else:
            basis, q = block, more
    raise RuntimeError(f"principal components did not settle within {restarts} restarts")


def large_pca(cells: DataFrame, k: int) -> DataFrame:
    """``(sample, component, score, share)`` of centred ``cells``; see :func:`leading_vectors`. The largest loading of a component is positive."""
    vectors, values = leading_vectors(cells, k)
    n = len(values)
    if not n:
        return cells.select("sample", F.lit(1).alias("component"), F.lit(0.0).alias("score"), F.lit(0.0).alias("share")).limit(0)
    vectors = materialise(vectors, "vectors")
    ends = vectors.agg(F.count("*").alias("n"), *(F.max_by(F.col("v")[j], F.struct(F.abs(F.col("v")[j]), "feature")).alias(f"v{j}") for j in range(n))).first()
    total = cells.agg(F.sum(F.col("value") * F.col("value"))).first()[0]
    scores = _times(cells, "sample", vectors, "feature", n, ends["n"])
    rows = F.array(*(F.struct(F.lit(j + 1).alias("component"), (F.col("z")[j] * (1.0 if ends[f"v{j}"] >= 0 else -1.0)).alias("score"), F.lit(float(values[j] / total)).alias("share")) for j in range(n)))
    return scores.select("sample", F.inline(rows))
