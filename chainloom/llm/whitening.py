"""Whitening of embeddings by a covariance of about twice double precision.

The fit takes each distinct integer vector once. A task adds the outer products of its centred vectors
as pairs of a high and a low part. Products of a block are free of error: centred components, themselves
pairs, are split into slices of few bits, so that a matrix product of two slices is exact in doubles; these
are added to the pair by error-free sums. Tasks' pairs are merged by the same sums, a row of the matrix at
a time and as they come, so a merging task holds one matrix however many tasks there are. The driver
holds matrices of the dimension's square alone.

Eigenvectors come from LAPACK's ``syevd`` through ``numpy.linalg.eigh``: reduction to a tridiagonal
matrix, then divide and conquer.

Defined cases: vectors that are null or empty, or hold null or non-finite components, are dropped.
Repeated vectors count once in the fit and each row is projected. Vectors of different lengths are fitted
length by length (16 lengths at most). A component that has no variance (an eigenvalue of at most the rounding of the
largest) has null for ``whitened`` and takes no part in ``identity_error``, which is 0 if none has any.
Fewer than 16 dimensions: as many components. Null ids are kept. Extra columns are ignored. Integers beyond
2^52 raise an error, and so do deviations beyond 64 bits. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .topk import usable

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: A block's rows, and the bits of a slice: 2 * BITS + log2(BLOCK) are at most a double's 53.
BLOCK, BITS = 1024, 21


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rounded sum and its error."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def pair_sum(ah: np.ndarray, al: np.ndarray, bh: np.ndarray, bl: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of two pairs, as a pair."""
    s, e = two_sum(ah, bh)
    t, f = two_sum(al, bl)
    s, e = two_sum(s, e + t)
    return two_sum(s, e + f)


def slices(a: np.ndarray, count: int) -> list[np.ndarray]:
    """``count`` matrices whose sum is ``a`` but for bits below the last; each column of each has at most ``BITS`` bits."""
    out = []
    for _ in range(count):
        most = np.abs(a).max(axis=0)
        top = np.ldexp(1.0, np.frexp(most)[1] + 53 - BITS)
        q = np.where(most > 0, (a + top) - top, 0.0)
        out.append(q)
        a = a - q
    return out


def outer_sums(high: np.ndarray, low: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the rows' outer products as a pair; rows are pairs or, without ``low``, doubles."""
    d = high.shape[1]
    h, l = np.zeros((d, d)), np.zeros((d, d))  # noqa: E741
    for i in range(0, len(high), BLOCK):
        parts = slices(high[i : i + BLOCK], 3) + (slices(low[i : i + BLOCK], 2) if low is not None else [])
        for a in range(len(parts)):
            for b in range(len(parts) - a):  # later products lie below the low part's bits
                h, l = pair_sum(h, l, parts[a].T @ parts[b], 0.0)  # noqa: E741
    return h, l


@dataclass(frozen=True)
class Centre:
    """How many vectors are fitted, and their sums by dimension."""

    n: int
    sums: tuple[int, ...]

    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        high = [s / self.n for s in self.sums]
        return np.array(high), np.array([float(Fraction(s, self.n) - Fraction(h)) for s, h in zip(self.sums, high)])

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high, low = self.mean()
        s, e = two_sum(x.astype(float), -high)
        return two_sum(s, e - low)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Of each row the sum over dimensions of (n * x - sum)^2."""
        if self.n * int(np.abs(x).max()) < 1 << 62 and max(map(abs, self.sums)) < 1 << 62:
            y = self.n * x - np.array(self.sums, np.int64)
            most = int(np.abs(y).max())
            if most * most * len(self.sums) < 1 << 63:
                return (y * y).sum(axis=1).tolist()
        return [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums)) for row in x]


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
    if len(x) and max(int(x.max()), -int(x.min())) > 1 << 52:
        raise ValueError("a component is larger than 2^52")
    return x


def integers(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id and x, the components floor(scale * c) + shift."""
    return vectors.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long") + shift).alias("x"))


def centre(fit: DataFrame) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            n, total = n + batch.num_rows, total + (matrix(batch).sum(axis=0) if batch.num_rows else 0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(np.full(len(total), n)), pa.array(total)], names=["at", "n", "s"])

    sums = fit.mapInArrow(run, "at long, n long, s long").groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = sorted(sums.collect())  # one a dimension
    return Centre(rows[0]["n"], tuple(int(r["s"]) for r in rows))


def covariance(fit: DataFrame, rows_of) -> np.ndarray:
    """The sum of outer products of ``rows_of(x)`` (a matrix, or a pair of them), one pair a task, merged by rows of the matrix."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = l = None  # noqa: E741
        for batch in batches:
            if batch.num_rows:
                found = outer_sums(*rows_of(matrix(batch)))
                h, l = found if h is None else pair_sum(h, l, *found)  # noqa: E741
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(h))), pa.array(list(h)), pa.array(list(l))], names=["i", "high", "low"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i, h, l in zip(*(batch.column(c).to_pylist() for c in ("i", "high", "low"))):  # noqa: E741
                pair = np.array(h), np.array(l)
                have[i] = pair_sum(*have[i], *pair) if i in have else pair
        yield pa.RecordBatch.from_arrays([pa.array([*have], pa.int64()), pa.array([list(h + l) for h, l in have.values()], pa.list_(pa.float64()))], names=["i", "row"])

    merged = fit.mapInArrow(add, "i long, high array<double>, low array<double>").repartition("i").mapInArrow(merge, "i long, row array<double>")
    return np.array([r["row"] for r in sorted(merged.collect())])


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``rows``: vec_id, x (of one length). A row each for every vector and component, as the query returns them."""
    fit = cut(rows.select("x").distinct())
    c = centre(fit)
    v = covariance(fit, lambda x: c.centred(x)) / c.n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    k = min(components, len(values))
    values, vectors = values[::-1][:k], np.ascontiguousarray(vectors[:, ::-1][:, :k])
    varies = values > max(values[0], 0.0) * len(v) * np.finfo(float).eps
    scaled = vectors / np.sqrt(np.where(varies, values, 1.0))
    project = lambda x: c.centred(x)[0] @ scaled
    error = 0.0
    if varies.any():
        of = covariance(fit, lambda x: (project(x)[:, varies],)) / c.n
        error = float(np.abs(of - np.eye(len(of))).max())
    explained = np.where(varies, values / max(np.trace(v), np.finfo(float).tiny), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                x, n = matrix(batch), batch.num_rows
                empty = np.tile(~varies, n)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(n), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, c.n)),
                    pa.array(c.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k))), pa.array(project(x).ravel(), mask=empty), pa.array(np.tile(explained, n)), pa.array(np.full(n * k, error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, OUT)


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT, components: int = COMPONENTS) -> DataFrame:
    rows = integers(vectors, scale, shift)
    lengths = [r[0] for r in rows.select(F.size("x")).distinct().limit(17).collect()]
    if len(lengths) > 16:
        raise ValueError("vectors of more than 16 lengths")
    out = [whiten(rows.where(F.size("x") == length), components) for length in sorted(lengths)]
    return reduce(DataFrame.unionByName, out) if out else rows.sparkSession.createDataFrame([], OUT)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
