"""Whitening of vectors by principal components of their covariance.

Two passes over the vectors give exact sums and the centred scatter. The scatter, a
matrix of dimensions, is factored by a pivoted Cholesky decomposition, and one-sided
Jacobi rotations make the columns of the triangular factor orthogonal: their squared
norms are the eigenvalues, the normalised columns the components.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weekgrid.llm.common import stored, table, tidy
from weekgrid.llm.vectors import matrix, sound

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
RANK = 1e-13


def pivoted_cholesky(a, least: float = RANK):
    """Rows' order and the triangular factor: a[order][:, order] = factor @ factor.T.
    Columns end where no pivot exceeds ``least`` of the first one."""
    n = len(a)
    order, factor = np.arange(n), np.zeros((n, n))
    rest, start = a.diagonal().copy(), a.diagonal().max(initial=0.0)
    for j in range(n):
        p = j + int(rest[order[j:]].argmax())
        order[[j, p]] = order[[p, j]]
        factor[[j, p]] = factor[[p, j]]
        pivot = rest[order[j]]
        if pivot <= least * start or pivot <= 0:
            return order, factor[:, :j]
        factor[j, j] = np.sqrt(pivot)
        below = order[j + 1 :]
        factor[j + 1 :, j] = (a[below, order[j]] - factor[j + 1 :, :j] @ factor[j, :j]) / factor[j, j]
        rest[below] -= factor[j + 1 :, j] ** 2
    return order, factor


def orthogonal_columns(factor, sweeps: int = 60):
    """One-sided Jacobi: rotates pairs of columns until all are orthogonal. The pairs of
    a sweep are dealt like the rounds of a tournament, so each round turns disjoint
    pairs at once."""
    x = np.array(factor)
    n = x.shape[1]
    players = list(range(n)) + [-1] * (n % 2)
    half = len(players) // 2
    for _ in range(sweeps):
        turned = False
        for _ in range(max(len(players) - 1, 0)):
            pairs = [(min(a, b), max(a, b)) for a, b in zip(players[:half], players[:half - 1 : -1]) if min(a, b) >= 0]
            players = [players[0], players[-1], *players[1:-1]]
            if not pairs:
                continue
            i, j = np.array(pairs).T
            u, v = x[:, i], x[:, j]
            alpha, beta, gamma = (u * u).sum(0), (v * v).sum(0), (u * v).sum(0)
            turn = np.abs(gamma) > 1e-16 * np.sqrt(alpha * beta)
            if not turn.any():
                continue
            turned |= bool((np.abs(gamma) > 1e-15 * np.sqrt(alpha * beta)).any())
            zeta = (beta - alpha) / (2 * np.where(turn, gamma, 1.0))
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            s = np.where(turn, c * t, 0.0)
            x[:, i], x[:, j] = c * u - s * v, s * u + c * v
        if not turned:
            break
    return x


def components_of(scatter, n: int):
    """Eigenvalues (falling) of scatter / n and unit components as rows, of its rank."""
    order, factor = pivoted_cholesky(scatter / n)
    x = orthogonal_columns(factor)
    norms = np.sqrt((x * x).sum(0))
    by = np.argsort(-norms, kind="stable")
    found = np.zeros((len(by), len(order)))
    found[:, order] = (x[:, by] / norms[by]).T
    return norms[by] ** 2, found


def whole(batch, width: int, scale: int, shift: int):
    return np.floor(matrix(batch.column(1), width) * scale).astype(np.int64) + shift


def column_sums(rows: DataFrame, width: int, scale: int, shift: int) -> list[int]:
    """Exact sum of each dimension; one row per dimension leaves a batch."""

    def run(batches):
        for batch in batches:
            total = whole(batch, width, scale, shift).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["at", "total"])

    sums = rows.mapInArrow(run, "at long, total long").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return [int(r["total"]) for r in sums.orderBy("at").collect()]


def scatter_of(rows: DataFrame, width: int, columns: Column, centre) -> np.ndarray:
    """Sum of products of centred columns: one matrix per task, added up by cells."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = columns(batch) - centre
            total += x.T @ x
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "total"])

    cells = rows.mapInArrow(run, "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    out = np.zeros((width, width))
    for r in cells:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


@tidy
def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for
    every sound row and each of the first ``components``.

    Entries are x = floor(scale * c) + shift. Rows whose vector is null or holds a null
    or a non-finite entry are left out; a null id stays. Repeated rows count each time.
    A shorter vector counts as followed by entries c = 0. ``deviation``, the sum of
    (n x - S)^2, is exact (decimal(38,0)). There are no more components than the
    covariance has rank, so equal vectors only, or a table of one row, give no rows,
    and so does an empty table. The driver holds the sums and one matrix of
    dimensions; the vectors stay in tasks.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda v: v.cast("double")).alias("vector"), sound(vector_col).alias("ok"))
    rows = stored(rows.where("ok").drop("ok"), "sound")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.max(F.array_max(F.transform("vector", lambda v: F.abs(v)))).alias("most")).first()
    n, width = facts["n"], facts["width"] or 0
    if (facts["most"] or 0.0) * scale >= 2.0**52:
        raise ValueError(f"entries of more than {2**52 // scale} are not whole numbers in double precision")
    empty = rows.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    if not n or not width:
        return empty
    sums = column_sums(rows, width, scale, shift)
    # x - S/n from exact integers: with S = q n + r it is (x - q) - r/n.
    high, low = np.array([s // n for s in sums]), np.array([s % n / n for s in sums])
    centred = lambda batch: (whole(batch, width, scale, shift) - high) - low
    scatter = scatter_of(rows, width, centred, np.zeros(width))
    values, found = components_of(scatter, n)
    values, found = values[:components], found[:components]
    m = len(values)
    if not m:
        return empty
    total = scatter.diagonal().sum() / n
    most = max((abs(int(n * scale * facts["most"])) + n * shift + max(map(abs, sums))) ** 2 * width, 1)
    exact = np.int64 if most < 2**63 else object

    def project(batches):
        for batch in batches:
            x = whole(batch, width, scale, shift)
            away = x.astype(exact) * n - np.array(sums, exact)
            deviation = [Decimal(int(d)) for d in (away * away).sum(1)]
            white = ((x - high) - low) @ found.T / np.sqrt(values)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, m, dtype=np.int32)), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.decimal128(38, 0)), lists], ["vec_id", "deviation", "white"])

    white = stored(rows.mapInArrow(project, "vec_id long, deviation decimal(38,0), white array<double>"), "whitened")
    means = white.agg(*[F.avg(F.col("white")[i]).alias(str(i)) for i in range(m)]).first()
    fields = lambda batch: matrix(batch.column(1), m)
    spread = scatter_of(white.select("vec_id", "white"), m, fields, np.array([means[str(i)] for i in range(m)])) / n
    error = float(np.abs(spread - np.eye(m)).max())
    shares = F.array(*[F.lit(float(v / total)) for v in values])
    each = white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))
