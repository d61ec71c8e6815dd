"""Embedding whitening from an exact, bit-sliced scatter matrix.

Each entry c (as double) becomes the integer x = floor(256 c).  The fit list is
each distinct x vector once.  A slice of its rows is shifted to non-negative
integers per dimension and cut into bit planes: plane b of dimension i is one bit
a row, packed into 64-bit words.  The popcount of two planes' AND counts the rows
with both bits, so

    sum y_i y_j = sum over b, c of 2**(b+c) popcount(plane(i,b) AND plane(j,c))

is exact, and undoing the shift gives the exact sum of x_i x_j.  Slices add up by
ordinary grouped sums in decimals.  The driver receives d (d+1) / 2 + d + 1
integers for d dimensions, however many rows there are, centres them as integers
(n sum x_i x_j - S_i S_j) and only then divides by n**2 for the eigenvectors.

Defined results: a row whose vector is null or holds a null or non-finite entry
is dropped; a vector shorter than the longest one counts as holding nulls; copies
of a vector weigh nothing extra but keep their own output rows; an entry outside
a long's range is cut to it; a deviation beyond a long is null; a component whose
eigenvalue is zero (up to rounding) has a null ``whitened`` and takes no part in
the identity error, which is null if none is left; with a zero trace ``explained``
is null; equal eigenvalues may come in either order; empty tables and empty
vectors give no rows; other columns never matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.session import materialize

SLICE_VALUES = 1 << 19  # integers cut into planes at once
SCALE = 256.0
LONG = 1 << 63


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the rows that remain."""
    entries = vectors.select(F.col(f"`{id_col}`").alias("vec_id"),
                             F.col(f"`{vec_col}`").cast("array<double>").alias("c")).where("c is not null")
    bad = F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    x = F.transform("c", lambda v: F.floor(v * F.lit(SCALE)).cast("long"))
    return entries.where(~bad).select("vec_id", x.alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column of equal lengths as an integer matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Planes of non-negative integers (rows x dims), packed over rows into words; a dimension's planes are consecutive."""
    rows = -len(y) % 64
    y = np.concatenate([y, np.zeros((rows, y.shape[1]), np.uint64)]) if rows else y
    planes = np.stack([(y >> np.uint64(b)).astype(np.uint8) & 1 for b in range(bits)], axis=2)  # rows, dims, bits
    packed = np.packbits(planes.transpose(1, 2, 0), axis=2)  # dims, bits, bytes
    return np.ascontiguousarray(packed.reshape(-1, packed.shape[2])).view(np.uint64)


def cross_products(x: np.ndarray) -> tuple[list, list, list]:
    """Exact sums over the rows: x_i x_j for i <= j as (i, j, sum), and x_i as (i, -1, sum)."""
    n, dims = x.shape
    low = x.min(axis=0)
    y = x.astype(np.uint64) - low.astype(np.uint64)  # modulo 2**64, hence right for any longs
    bits = max(int(y.max()).bit_length(), 1)
    planes = bit_planes(y, bits)
    # the weights need Python integers only where the sums could pass a long
    kind = object if 2 * bits + n.bit_length() > 62 else np.int64
    weight = np.array([1 << b for b in range(bits)], kind)

    def weighted(words, dim):
        """Of every dimension from ``dim`` on: the sum of its values over the rows marked in ``words``."""
        counts = np.bitwise_count(planes[dim * bits:] & words).sum(axis=1, dtype=np.int64)
        return counts.astype(kind).reshape(-1, bits) @ weight

    shift, total = [int(s) for s in low], [int(t) for t in weighted(np.uint64(2**64 - 1), 0)]
    i, j, v = [], [], []
    for a in range(dims):
        i.append(a), j.append(-1), v.append(total[a] + n * shift[a])
        gram = sum(weight[b] * weighted(planes[a * bits + b], a) for b in range(bits))
        for b in range(a, dims):
            i.append(a), j.append(b)
            v.append(int(gram[b - a]) + shift[b] * total[a] + shift[a] * total[b] + n * shift[a] * shift[b])
    return i, j, v


def scatter_task(dims: int):
    """Task function: fit rows -> (i, j, value) sums of the task; (-1, -1) is the number of rows."""
    rows = max(64, SLICE_VALUES // dims)

    def run(batches):
        sums: dict = {}
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                x = matrix(batch.slice(at, rows).column("x"), dims)
                sums[-1, -1] = sums.get((-1, -1), 0) + len(x)
                for a, b, v in zip(*cross_products(x)):
                    sums[a, b] = sums.get((a, b), 0) + v
        if sums:
            keys = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([str(v) for v in sums.values()], pa.string())], names=["i", "j", "v"])
    return run


class Fit:
    """Exact sums of the fit list and the components derived from them."""

    def __init__(self, n: int, sums: list[int], products: dict, dims: int, k: int):
        self.n, self.sums, self.dims = n, sums, dims
        centred = np.array([[n * products[min(a, b), max(a, b)] - sums[a] * sums[b] for b in range(dims)]
                            for a in range(dims)], dtype=object)
        cov = np.array([[v / (n * n) for v in row] for row in centred], float)  # integers divided exactly, then rounded
        values, vectors = np.linalg.eigh(cov)
        top = np.argsort(values, kind="stable")[::-1][:k]
        self.values, self.vectors = values[top], vectors[:, top]
        trace = sum(int(centred[a, a]) for a in range(dims)) / (n * n)
        self.explained = [float(max(v, 0.0)) / trace if trace else None for v in self.values]
        floor = max(float(values[-1]), 0.0) * dims * np.finfo(float).eps
        self.live = self.values > floor

    def project(self, x: np.ndarray) -> np.ndarray:
        """(x - S/n) on the live components, over the root of their eigenvalues."""
        wide = int(np.abs(x.astype(object)).max()) * self.n >= 1 << 62
        centred = (self.n * x.astype(object) - np.array(self.sums, object)).astype(float) if wide else (
            self.n * x - np.array(self.sums, np.int64)).astype(float)
        with np.errstate(invalid="ignore", divide="ignore"):
            out = (centred / self.n) @ self.vectors / np.sqrt(self.values)
        out[:, ~self.live] = np.nan
        return out

    def deviation(self, x: np.ndarray) -> list:
        """Exact sum over dimensions of (n x - S)**2; None beyond a long."""
        peak = int(np.abs(x.astype(object)).max()) * self.n + max(abs(s) for s in self.sums)
        if self.dims * peak * peak < LONG:
            part = self.n * x - np.array(self.sums, np.int64)
            return (part * part).sum(axis=1).tolist()
        part = self.n * x.astype(object) - np.array(self.sums, object)
        return [v if v < LONG else None for v in (part * part).sum(axis=1).tolist()]


def fit(distinct: DataFrame, dims: int, k: int = 4) -> Fit:
    """Sums by Spark; what reaches the driver depends on the dimensions alone."""
    parts = distinct.mapInArrow(scatter_task(dims), "i int, j int, v string")
    rows = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    sums = {(r.i, r.j): int(r.v) for r in rows}
    return Fit(sums[-1, -1], [sums[a, -1] for a in range(dims)], sums, dims, min(k, dims))


def identity_error(spark: SparkSession, distinct: DataFrame, model: Fit):
    """Largest entry of |covariance of the whitened fit list - identity|, measured on the rows."""
    live = [c for c in range(len(model.values)) if model.live[c]]
    if not live:
        return None
    dims = model.dims

    def projected(batches):
        for batch in batches:
            if batch.num_rows:
                out = model.project(matrix(batch.column("x"), dims))
                yield pa.RecordBatch.from_arrays([pa.array(out[:, c]) for c in live], names=[f"w{c}" for c in live])

    w = distinct.mapInArrow(projected, ", ".join(f"w{c} double" for c in live))
    means = w.agg(*[F.avg(f"w{c}").alias(f"w{c}") for c in live]).first()
    centred = w.select(*[(F.col(f"w{c}") - F.lit(means[f"w{c}"])).alias(f"w{c}") for c in live])
    cov = centred.agg(*[F.avg(F.col(f"w{a}") * F.col(f"w{b}")).alias(f"c{a}_{b}") for a in live for b in live]).first()
    return max(abs(cov[f"c{a}_{b}"] - (a == b)) for a in live for b in live)


def whiten(vectors: DataFrame, k: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component 1..min(k, d): vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    schema = ("vec_id {}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double").format(vectors.schema[id_col].dataType.simpleString())
    rows = materialize(integer_rows(vectors, id_col, vec_col), "integer-rows")
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == dims)
    distinct = materialize(rows.select("x").distinct(), "fit-list")
    model = fit(distinct, dims, k)
    error = identity_error(spark, distinct, model)

    def run(batches):
        width = len(model.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"), dims)
            n = len(x)
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(n), width)))
            deviation = pa.array(model.deviation(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, width + 1), n), pa.int32()),
                 pa.array(np.full(n * width, model.n), pa.int64()),
                 deviation.take(pa.array(np.repeat(np.arange(n), width))),
                 pa.array(model.project(x).ravel(), pa.float64(), from_pandas=True),
                 pa.array(model.explained * n, pa.float64()),
                 pa.array([error] * (n * width), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
