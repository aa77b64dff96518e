"""Embedding whitening by shifted CholeskyQR.

The centred rows are a tall matrix X. A pass over the rows gathers the Gram matrix of X; the Cholesky factor of it, with a
shift added that keeps it definite however ill-conditioned X is, is a first R, and the rows divided by R (a triangular
solve per batch) are nearer to orthonormal. Further passes gather the Gram matrix of the rows so divided and divide again,
until it is the identity; the product of the factors is the R of X's QR decomposition (Fukaya et al., 2020). The singular
values and right vectors of R are those of X: whitening components without squaring X's condition.

Every pass reads the rows once; a task sends the upper triangle of its sums, added up by place, so that the driver gets
one matrix a pass, whatever the number of rows or tasks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import written

#: Whole numbers are floor(SCALE * entry) + LIFT.
SCALE, LIFT = 1024, 100_000
#: Entries from here on have no such long; they count as not finite.
HUGE = float(1 << 52)
#: Passes at most; three are enough unless columns depend on each other.
PASSES = 8
#: Singular values below this share of the largest are none: the columns depend on each other there.
LEAST_SHARE = 1e-11
#: The Gram matrix is the identity when no eigenvalue is off by more.
NEAR = 1e-10
#: Eigenvalues of a Gram matrix of divided rows below this share are of columns that depend on each other.
DEPENDENT = 1e-9
#: Rows that are worked on at once.
BLOCK = 4096


def whole_rows(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, x): the rows without null or non-finite entries, as whole numbers."""
    c = F.col(vector).cast("array<double>")
    fine = F.forall(c, lambda v: v.isNotNull() & (F.abs(v) < HUGE) & ~F.isnan(v))
    kept = vectors.select(F.col(id).alias("id"), c.alias("c")).where(F.col("c").isNotNull() & fine)
    return kept.select("id", F.transform("c", lambda v: F.floor(v * SCALE) + LIFT).alias("x"))


def _blocks(batches):
    """(batch slice, matrix of whole numbers) of BLOCK rows at most."""
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            part = batch.slice(a, BLOCK)
            column = part.column("x")
            yield part, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _exact_sum(x):
    """Column sums without overflow."""
    if len(x) and np.abs(x).max() * float(len(x)) < 2**62:
        return [int(v) for v in x.sum(axis=0)]
    return [int(v) for v in x.astype(object).sum(axis=0)] if len(x) else []


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """(rows, sum of each column), exact; a task sends one number a column."""

    def run(batches):
        sums, n = None, 0
        for _, x in _blocks(batches):
            part = _exact_sum(x)
            sums = part if sums is None else [a + b for a, b in zip(sums, part)]
            n += len(x)
        if n:
            # Halves of a sum that may exceed a long.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(-1, len(sums)), pa.int32()),
                    pa.array([0, *[s >> 32 for s in sums]], pa.int64()),
                    pa.array([n, *[s & 0xFFFFFFFF for s in sums]], pa.int64()),
                ],
                ["k", "high", "low"],
            )

    parts = rows.mapInArrow(run, "k int, high long, low long").groupBy("k")
    found = parts.agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    by = {r["k"]: (int(r["high"]) << 32) + int(r["low"]) for r in found}
    return by.pop(-1, 0), [by[k] for k in sorted(by)]


class Centre:
    """Rows less their mean: the whole part of the mean is taken off exactly, the rest in double precision."""

    def __init__(self, n, sums):
        self.n = n
        self.whole = [s // n for s in sums]
        self.rest = [s % n for s in sums]

    def rows(self, x):
        return (x - np.array(self.whole, np.int64)).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviations(self, x):
        """Sum over columns of (n * x - S) ** 2, as whole numbers."""
        off = x - np.array(self.whole, np.int64)
        if len(off) and (np.abs(off).max() + 1.0) ** 2 * float(self.n) ** 2 * max(1, x.shape[1]) < 2**62:
            return ((self.n * off - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((self.n * int(v) - r) ** 2 for v, r in zip(row, self.rest)) for row in off]


def divided(q, r):
    """q times the inverse of the upper triangular r, column by column."""
    out = np.empty_like(q)
    for j in range(len(r)):
        out[:, j] = (q[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def gram(rows: DataFrame, of, size: int) -> np.ndarray:
    """Gram matrix of the matrices `of(x)`, with a last column of ones, over all rows."""
    place = np.triu_indices(size + 1)

    def run(batches):
        total = None
        for _, x in _blocks(batches):
            q = of(x)
            q = np.concatenate([q, np.ones((len(q), 1))], axis=1)
            total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(place[0]), dtype=np.int32)), pa.array(total[place])], ["k", "v"]
            )

    found = rows.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas().sort_values("k")
    out = np.zeros((size + 1, size + 1))
    out[place] = found["v"].to_numpy()
    return out + np.triu(out, 1).T


def shifted_cholesky_qr(rows: DataFrame, centre: Centre, size: int) -> np.ndarray:
    """R of the QR decomposition of the centred rows, up to a rotation of its rows."""
    factors: list[np.ndarray] = []
    last = np.eye(size)
    u = np.finfo(float).eps / 2
    for _ in range(PASSES):

        def of(x, factors=tuple(factors)):
            q = centre.rows(x)
            for r in factors:
                q = divided(q, r)
            return q

        g = gram(rows, of, size)[:size, :size]
        values, turned = np.linalg.eigh(g)
        if values[-1] <= 0:
            return np.zeros((size, size))
        live = values > DEPENDENT * values[-1]
        if factors and np.abs(values[live] - 1).max() <= NEAR:
            # The others: columns that depend on each other, of which only the shifts are left.
            last = np.sqrt(np.where(live, values, 0))[:, None] * turned.T
            break
        # The first shift bounds the rounding of the sums; later Gram matrices need one only where columns depend.
        shift = 11 * size * (size + 1) * u * values[-1]
        if not factors:
            shift = min(shift + 11 * centre.n * size * u * values[-1], values[-1])
        elif values[0] > 100 * shift:
            shift = 0.0
        factors.append(np.linalg.cholesky(g + shift * np.eye(size)).T)
    r = np.eye(size)
    for f in [*factors, last]:
        r = f @ r
    return r


def whiten(vectors: DataFrame, id="vec_id", vector="embedding", components=8) -> DataFrame:
    """One row per usable vector and component: `id`, component, n, deviation, whitened, explained, identity_error.

    Rows are dropped whose vector is null or holds null or non-finite entries (or entries of 2**52 and more, which have no
    whole number); empty vectors, and vectors of another length than the most frequent (of several: the longest), have no
    place in the covariance and are dropped, too. Repeated rows and ids count and come out as often as they are there; a
    null id is kept. Components are numbered from 1 by falling eigenvalue; equal eigenvalues leave their order open.
    Directions without variance have no whitened value, so constant tables, single rows and empty tables give none.
    Other columns are not read. `deviation` is exact, as decimal(38,0).
    """
    spark = vectors.sparkSession
    kept = written(whole_rows(vectors, id, vector).withColumn("size", F.size("x")), "whole-rows")
    sizes = kept.where("size > 0").groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    field = kept.schema["id"].dataType.simpleString()
    schema = f"id {field}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    named = [F.col("id").alias(id), "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if sizes is None:
        return spark.createDataFrame([], schema).select(*named)
    size = sizes["size"]
    rows = kept.where(F.col("size") == size).select("id", "x")
    n, sums = totals(rows)
    centre = Centre(n, sums)
    r = shifted_cholesky_qr(rows, centre, size)
    _, sigma, vt = np.linalg.svd(r)
    used = int((sigma[:components] > sigma[0] * LEAST_SHARE).sum()) if sigma[0] > 0 else 0
    if not used:
        return spark.createDataFrame([], schema).select(*named)
    scale = (vt[:used].T) / (sigma[:used] / np.sqrt(n))
    explained = sigma[:used] ** 2 / (sigma**2).sum()

    def whitened(x):
        return centre.rows(x) @ scale

    g = gram(rows, whitened, used) / n
    mean = g[:used, used]
    error = float(np.abs(g[:used, :used] - np.outer(mean, mean) - np.eye(used)).max())

    def run(batches):
        for part, x in _blocks(batches):
            z, m = whitened(x), len(x)
            deviation = pa.array(centre.deviations(x), pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(m), used))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(each),
                    pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * used, n, np.int64)),
                    deviation.take(each),
                    pa.array(z.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * used, error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema).select(*named)
