"""Whitening of embeddings by a block Lanczos iteration that never forms the covariance.

Entries become integers, so sums and deviations are exact. Each step multiplies a block of vectors v by the
covariance as a pass over all rows: every task centres its rows, forms X'(Xv), and the parts are summed by
dimension. The driver holds only blocks of as many rows as a vector has dimensions: it reorthogonalises the new block
against all earlier ones, twice; replaces directions that vanish (a breakdown) by new random ones, orthogonal to the rest; and stops
when the residuals of the wanted pairs, formed from the products that it has, are within rounding, or the
basis is complete. The trace for the explained shares comes from the rows' deviations.

Defined cases: rows whose vector is null, empty, or has a null or non-finite entry are dropped, and so are those whose length isn't the
most frequent one (of ties the longest); entries are clipped to 2^52 after scaling; a null id stays null; repeated rows count
again; a component whose variance is zero within rounding has no whitened values and is left out, so equal
rows, one row or an empty table give no rows; a deviation beyond a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: Components; vectors of a block (at least as many, so that equal eigenvalues are all found); scale and shift of entries.
COMPONENTS, BLOCK, SCALE, SHIFT = 8, 16, 1024, 100_000
CLIP, LONG = float(1 << 52), (1 << 63) - 1
#: Residuals of the wanted pairs, as a share of the largest eigenvalue; what counts as vanished in a new block, as a share of its product.
RESIDUAL, VANISHED = 4e-15, 1e-12


def integers(df: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, x (array of bigint) of the rows whose entries are all finite."""
    v = F.col(vector).cast("array<double>")
    infinite = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    clipped = lambda c: F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.floor(c * SCALE).cast("double"))).cast("bigint") + SHIFT
    # One loop over the entries: a bad one becomes null, and a row with nulls goes.
    x = F.transform(v, lambda c: F.when(~infinite(c), clipped(c)))
    rows = df.select(F.col(id).cast("bigint").alias("vec_id"), x.alias("x"))
    return rows.filter((F.size("x") > 0) & ~F.array_contains(F.transform("x", lambda c: c.isNull()), True))


def blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in shared.batches(rows):
        yield b, b.column("x").flatten().to_numpy().reshape(b.num_rows, -1)


def sums(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * dims
        for _, x in blocks(batches):
            # Of 2^53 at most, so a thousand add up within a long.
            for k in range(0, len(x), 1000):
                s = [a + int(b) for a, b in zip(s, x[k : k + 1000].sum(0), strict=True)]
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array([Decimal(a) for a in s], pa.decimal128(38, 0))], names=["i", "n", "s"])

    got = rows.select("x").mapInArrow(run, "i int, n bigint, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    return got[0]["n"], [int(r["s"]) for r in sorted(got, key=lambda r: r["i"])]


def product(rows: DataFrame, mean: np.ndarray, n: int, v: np.ndarray) -> np.ndarray:
    """The covariance of the rows times v: one pass, rows centred before they are multiplied."""
    width = v.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = np.zeros_like(v)
        for _, x in blocks(batches):
            c = x - mean
            y += c.T @ (c @ v)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(y)), pa.int32()), pa.array(list(y), pa.list_(pa.float64()))], names=["i", "y"])

    parts = rows.select("x").mapInArrow(run, "i int, y array<double>")
    got = parts.groupBy("i").agg(F.array(*[F.sum(F.col("y")[j]) for j in range(width)]).alias("y")).collect()
    return np.array([r["y"] for r in sorted(got, key=lambda r: r["i"])]) / n


def lanczos(times: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The wanted largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns; times multiplies it by a block."""
    rng = np.random.default_rng(11)
    q, aq = np.zeros((dims, 0)), np.zeros((dims, 0))
    new = np.linalg.qr(rng.standard_normal((dims, min(dims, block))))[0]
    while True:
        q, aq = np.hstack([q, new]), np.hstack([aq, y := times(new)])
        t = q.T @ aq
        e, s = np.linalg.eigh((t + t.T) / 2)
        e, s = e[::-1][:wanted], s[:, ::-1][:, :wanted]
        residual = np.linalg.norm(aq @ s - q @ s * e, axis=0)
        if q.shape[1] == dims or (len(e) == wanted and residual.max() <= RESIDUAL * max(e[0], 0)):
            return e, np.linalg.qr(q @ s)[0]
        new = _next(q, y, min(block, dims - q.shape[1]), rng)


def _next(q: np.ndarray, y: np.ndarray, width: int, rng: np.random.Generator) -> np.ndarray:
    """width unit vectors, orthogonal to q and each other: what y adds, then random ones in place of what vanished."""
    size = np.linalg.norm(y)
    for _ in range(2):
        y = y - q @ (q.T @ y)
    u, found, _ = np.linalg.svd(y, full_matrices=False)
    new = u[:, found > VANISHED * size][:, :width]
    while True:
        for _ in range(2):
            new = new - q @ (q.T @ new)
            new = np.linalg.qr(new)[0]
        if new.shape[1] == width:
            return new
        new = np.hstack([new, rng.standard_normal((len(q), width - new.shape[1]))])


def deviations(x: np.ndarray, n: int, s: list[int]) -> tuple[list[int | None], np.ndarray]:
    """Of each row the exact sum of (n*x - s)^2 (None beyond a long), and it over n^2."""
    middle = np.array([a // n for a in s], np.int64)
    rest = np.array([a % n for a in s], object)
    away = x - middle
    if (int(np.abs(away).max(initial=0)) + 1) ** 2 * n * n * len(middle) < 1 << 62:
        d = away * n - rest.astype(np.int64)
        exact = (d * d).sum(1).tolist()
    else:
        exact = [int(((a * n - rest) ** 2).sum()) for a in away.astype(object)]
    return [a if a <= LONG else None for a in exact], np.array([a / (n * n) for a in exact])


def project(rows: DataFrame, n: int, s: list[int], onto: np.ndarray) -> DataFrame:
    """vec_id, deviation, spread (deviation over n^2), w (the centred row times onto)."""
    mean = np.array([a / n for a in s])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in blocks(batches):
            deviation, spread = deviations(x, n, s)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(deviation, pa.int64()), pa.array(spread), pa.array(list((x - mean) @ onto), pa.list_(pa.float64()))], names=["vec_id", "deviation", "spread", "w"])

    return rows.mapInArrow(run, "vec_id bigint, deviation bigint, spread double, w array<double>")


def whiten(spark: SparkSession, df: DataFrame, components: int = COMPONENTS, block: int = BLOCK, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row and component: vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue."""
    stage = shared.Stage(spark, "whitening")
    rows = stage.write(integers(df, id, vector), "integers")
    length = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    empty = spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, eigenvalue double")
    if not length:
        return empty
    dims = length["dims"]
    rows = rows.filter(F.size("x") == dims)
    n, s = sums(rows, dims)
    mean, wanted = np.array([a / n for a in s]), min(components, dims)
    e, q = lanczos(lambda v: product(rows, mean, n, v), dims, wanted, max(block, wanted))
    # Rounding leaves about this much of a variance that is zero, after rows of this size were centred.
    least = max(e[0], 0) * dims * 1e-14 + (np.abs(mean).max() * 1e-15) ** 2
    e, q = e[e > least], q[:, e > least]
    if not len(e):
        return empty
    whitened = stage.write(project(rows, n, s, q / np.sqrt(e)), "whitened")
    w, m = F.col("w"), len(e)
    pairs = [(i, j) for i in range(m) for j in range(i + 1)]
    found = whitened.agg(F.sum("spread").alias("spread"), *[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    trace = found["spread"] / n
    out = whitened.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
    values = F.array(*[F.lit(float(a)) for a in e])
    eigenvalue = values[F.col("k")]
    return out.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", (eigenvalue / trace).alias("explained"), F.lit(float(error)).alias("identity_error"), eigenvalue.alias("eigenvalue"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, shared.table(spark, sf_dir, "embeddings"))
