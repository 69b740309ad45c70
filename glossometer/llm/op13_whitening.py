"""Embedding whitening by LOBPCG.

The leading eigenvectors of the covariance matrix come from locally optimal block iterations. The matrix itself is
never built: its product with a block of vectors is a sum over the centred rows, taken in one distributed pass, and what
reaches the driver is a block of as many numbers as the vectors have dimensions times the block's width. Each step solves
the small eigenproblem of Rayleigh and Ritz on the iterate, its residuals and the last directions. Steps go on until
the residuals of the wanted vectors, from a product of their own, are at the level of rounding; only then are rows projected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Components, and further columns of the block that speed up the last ones.
COMPONENTS, GUARD = 8, 4
#: A component c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: A residual's norm over the largest eigenvalue: AIM is sought, WORST is accepted where PATIENCE steps don't halve it, and beyond STEPS steps it is an error.
AIM, WORST, PATIENCE, STEPS, SEED = 1e-14, 1e-10, 12, 1000, 13
#: An eigenvalue of at most so many times the trace is none: its component has no variance to scale.
NO_VARIANCE = 1e-13


def vectors_of(batch: pd.Series) -> np.ndarray:
    return np.stack(batch.to_numpy()).astype(np.int64)


def summed(rows: DataFrame, partial: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of a block of numbers over all rows: added up inside each partition, then by number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                part = partial(vectors_of(batch["x"])).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"at": np.arange(len(total)), "value": total})

    out = np.zeros(int(np.prod(shape)))
    for r in rows.select("x").mapInPandas(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():  # dimensions times the block's width
        out[r["at"]] = r["value"]
    return out.reshape(shape)


def orthonormal(basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns' span without directions that only rounding adds."""
    norms = np.linalg.norm(basis, axis=0)
    u, s, _ = np.linalg.svd(basis[:, norms > 0] / norms[norms > 0], full_matrices=False)
    return u[:, s > 1e-10 * s.max(initial=0)]


def leading(product: Callable[[np.ndarray], np.ndarray], width: int, n: int, guard: int = GUARD, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, unit eigenvectors as columns, the largest relative residual) of a symmetric matrix given by its products.

    A step takes one product, with the new directions; the iterate's own follows from it. Where the residuals look done, a
    product of the iterate itself certifies them; also where steps, certified or not, no longer halve the lowest ones.
    """
    m = min(width, n + guard)
    x = orthonormal(np.random.default_rng(SEED).standard_normal((width, m)))
    ax, certified, p, best, low, since = product(x), True, None, None, float("inf"), 0
    for _ in range(steps):
        theta, turn = np.linalg.eigh(x.T @ ax)
        theta, turn = theta[::-1], turn[:, ::-1]
        x, ax = x @ turn, ax @ turn
        residual = ax - x * theta
        off = float(np.linalg.norm(residual[:, :n], axis=0).max(initial=0)) / max(abs(theta[0]), np.finfo(float).tiny)
        low, since = (off, 0) if off <= 0.5 * low else (low, since + 1)
        if certified and (best is None or off < best[2]):
            best = theta[:n], x[:, :n], off
        settled = since >= PATIENCE and best[2] <= WORST  # rounding lets them fall no further
        if certified and (off <= AIM or settled or m == width):
            break
        if not certified and (off <= 2 * AIM or since and since % 4 == 0):
            x, _ = np.linalg.qr(x)
            ax, certified = product(x), True
            continue
        inside = lambda b: b - x @ (x.T @ b)
        more = orthonormal(inside(inside(residual if p is None else np.concatenate([residual, p], axis=1))))
        more = inside(more)
        basis, whole = np.concatenate([x, more], axis=1), np.concatenate([ax, product(more)], axis=1)
        _, turn = np.linalg.eigh((small := basis.T @ whole) + small.T)
        turn = turn[:, ::-1][:, :m]
        p, x, ax, certified = more @ turn[m:], basis @ turn, whole @ turn, False
    if best[2] > WORST:
        raise ArithmeticError(f"residuals of {best[2]} after {steps} steps")
    return best


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, residual) for each fitting row and component.

    Entries c become x = floor(scale * c) + shift. n is the number of fitting rows, S their sums; deviation is the exact sum of (n * x - S)^2
    (null where 64 bits can't hold it), whitened the projection of x - S / n on the component over the root of its
    eigenvalue. residual is the largest norm of V z - e z over the largest eigenvalue.

    Rows whose vector is null or empty, or holds a null or non-finite entry, are dropped. Of vectors of several
    widths those of the most frequent one (then the widest) fit; the others are dropped. Components without variance (all vectors alike,
    fewer rows than components, constant entries) aren't returned. Rows that repeat an id or have none are rows of
    their own. No fitting row gives no rows. Other columns are ignored.
    """
    sound = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")) + shift)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where((F.size("v") > 0) & sound)
    staged = written(rows.select("id", whole.alias("x")))
    spark, schema = vectors.sparkSession, f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    widths = staged.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if widths is None:
        return spark.createDataFrame([], schema)
    width, n = widths
    fit = staged.where(F.size("x") == width)
    exact = fit.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("at").collect()  # a row per dimension
    sums = [int(r["s"]) for r in exact]
    mean = np.array([float(Decimal(s) / n) for s in sums])
    most = max(max(abs(n * r["low"] - s), abs(n * r["high"] - s)) for r, s in zip(exact, sums))  # of |n x - S|

    def product(z: np.ndarray) -> np.ndarray:
        def partial(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return c.T @ (c @ z)

        return summed(fit, partial, z.shape) / n

    trace = float(summed(fit, lambda x: np.array([((x - mean) ** 2).sum()]), (1,))[0]) / n
    e, z, residual = leading(product, width, min(components, width)) if trace else (np.zeros(0), np.zeros((width, 0)), 0.0)
    there = e > NO_VARIANCE * trace
    e, z = e[there], z[:, there]
    if not len(e):
        return spark.createDataFrame([], schema)
    project = z / np.sqrt(e)
    moments = summed(fit, lambda x: np.concatenate([(w := (x - mean) @ project).sum(axis=0)[None], w.T @ w]), (len(e) + 1, len(e)))
    middle = moments[0] / n
    error = float(np.abs(moments[1:] / n - np.outer(middle, middle) - np.eye(len(e))).max())
    explained, k = e / trace, len(e)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = vectors_of(batch["x"])
            if width * most * most < 1 << 63:
                d = ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1)
            else:  # Python's integers
                exact_d = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
                d = pd.array([v if v < 1 << 63 else None for v in exact_d], "Int64")
            out = {id_col: batch["id"].repeat(k).to_numpy(), "component": np.tile(np.arange(1, k + 1), len(x)), "n": n, "deviation": np.repeat(d, k), "whitened": ((x - mean) @ project).ravel()}
            yield pd.DataFrame(out | {"explained": np.tile(explained, len(x)), "identity_error": error, "residual": residual})

    return fit.mapInPandas(finish, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
