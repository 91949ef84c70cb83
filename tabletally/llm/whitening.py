"""Embedding whitening from an exact, bit-sliced scatter matrix.

Vectors are integers. Each task takes chunks of rows, subtracts every
dimension's least value in the chunk, and writes bit b of dimension d of all
its rows as one *plane*: a bit string packed into 64-bit words. The product sum
of two dimensions is then the sum over their planes a, b of
2^(a + b) * popcount(plane a AND plane b), which is exact; the shift is taken
out again in integers. The sums of all chunks are added as limbs of 32 bits by
a grouped sum, so nothing overflows or is rounded at any number of rows.

The driver holds one number per pair of dimensions. It centres the scatter
matrix as integers, n * X - S S', and only then turns it into doubles for
``eigh``. A second pass over the rows projects the centred vectors on the
components and divides by the square roots of their eigenvalues.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .topk import finite, matrix

#: Numbers whose bit planes are held at once.
VALUES_IN_CHUNK = 1 << 20
#: Fixed value: what the contract adds to each entry.
OFFSET = 100_000
#: Integer entries beyond this size are set to it, so that shifted values fit a long.
MOST = 1 << 61


def integers(lengths: np.ndarray, flat: np.ndarray, dims: int, scale: int, offset: int) -> np.ndarray:
    """floor(scale * c) + offset of every entry; entries that a shorter vector lacks count as c = 0."""
    with np.errstate(over="ignore"):
        whole = np.floor(flat.astype(np.float64) * scale)
    return matrix(lengths, np.clip(whole, -MOST, MOST).astype(np.int64), dims) + offset


def planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-negative (rows, dims) values -> packed bit planes (plane, word), and each plane's dimension and bit."""
    n, dims = values.shape
    width = max(1, int(values.max()).bit_length()) if values.size else 1
    padded = np.zeros((dims, -(-n // 64) * 64), np.uint64)
    padded[:, :n] = values.T
    packed = np.stack([
        np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64) for b in range(width)
    ], axis=1)  # dimension, bit, word
    dim, bit = np.repeat(np.arange(dims), width), np.tile(np.arange(width), dims)
    packed = packed.reshape(dims * width, -1)
    used = packed.any(axis=1)
    return packed[used], dim[used], bit[used]


def cross_products(values: np.ndarray) -> np.ndarray:
    """Exact product sums of all pairs of dimensions as Python integers, by AND and popcount of bit planes."""
    n, dims = values.shape
    low = values.min(axis=0)
    packed, dim, bit = planes(values - low)
    width = int(bit.max(initial=0)) + 1
    # a sum over the rows and both bits fits a long where the planes are few enough
    kind = np.int64 if 2 * width + n.bit_length() < 62 else object
    weight = np.array([1 << int(b) for b in bit], kind)
    shifted = np.zeros((dims, dims), kind)
    for p in range(len(packed)):
        counts = np.bitwise_count(packed[p:] & packed[p]).sum(axis=1, dtype=np.int64).astype(kind) * weight[p:]
        weighted = np.zeros(dims, kind)
        np.add.at(weighted, dim[p:], counts)
        shifted[dim[p]] += weighted * weight[p]
        weighted[dim[p]] -= counts[0]  # a plane meets itself once
        shifted[:, dim[p]] += weighted * weight[p]
    sums, low = (values - low).sum(axis=0, dtype=object), low.astype(object)
    return shifted.astype(object) + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)


def limbs(i: int, j: int, dims: int, value: int) -> Iterator[tuple[int, int, int, int, int]]:
    """A signed integer as rows (dims, i, j, limb, its 32 bits with the sign)."""
    sign, value, at = (1, value, 0) if value >= 0 else (-1, -value, 0)
    while value:
        if value & 0xFFFFFFFF:
            yield dims, i, j, at, sign * (value & 0xFFFFFFFF)
        value, at = value >> 32, at + 1


class Sums:
    """n, sums and product sums of the vectors of one task with equally many dimensions."""

    def __init__(self, dims: int):
        self.dims, self.n = dims, 0
        self.sums, self.products = np.zeros(dims, object), np.zeros((dims, dims), object)

    def add(self, values: np.ndarray) -> None:
        rows = max(64, VALUES_IN_CHUNK // max(self.dims, 1))
        for start in range(0, len(values) if self.dims else 0, rows):
            part = values[start : start + rows]
            self.sums += part.sum(axis=0, dtype=object)
            self.products += cross_products(part)
        self.n += len(values)

    def rows(self) -> Iterator[tuple[int, int, int, int, int]]:
        """n at (-1, -1), the sums at (-1, d), the product sums at (i, j), i <= j."""
        yield from limbs(-1, -1, self.dims, self.n)
        for d in range(self.dims):
            yield from limbs(-1, d, self.dims, int(self.sums[d]))
            for j in range(d, self.dims):
                yield from limbs(d, j, self.dims, int(self.products[d, j]))


def vectors_in(batch: pa.RecordBatch, place: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Lengths, flat entries and the greatest length of the batch's arrays."""
    column = batch.column(place)
    lengths = column.value_lengths().to_numpy()
    return lengths, column.flatten().to_numpy(), int(lengths.max(initial=0))


class Statistics:
    """n, sums S and product sums X of integer vectors, all exact, with what follows from them."""

    def __init__(self, rows: list, offset: int):
        groups: dict[int, dict[tuple[int, int], int]] = {}
        for dims, i, j, limb, value in rows:
            group = groups.setdefault(dims, {})
            group[i, j] = group.get((i, j), 0) + (int(value) << 32 * limb)
        self.dims = max(groups, default=0)
        self.n, self.sums = 0, np.zeros(self.dims, object)
        products = np.zeros((self.dims, self.dims), object)
        for dims, group in groups.items():
            n = group[-1, -1]
            # rows of a chunk of shorter vectors hold the offset in the dimensions they lack
            sums = np.array([group.get((-1, d), 0) if d < dims else n * offset for d in range(self.dims)], object)
            self.n, self.sums = self.n + n, self.sums + sums
            for i in range(self.dims):
                for j in range(i, self.dims):
                    if j < dims:
                        x = group.get((i, j), 0)
                    else:
                        x = offset * int(sums[i])
                    products[i, j] += x
        lower = np.tril_indices(self.dims, -1)
        products[lower] = products.T[lower]
        #: n^2 times the covariance, in integers
        self.scatter = self.n * products - np.outer(self.sums, self.sums)

    def components(self, k: int) -> Components:
        """The first k unit eigenvectors of the covariance by falling eigenvalue."""
        square = max(self.n, 1) ** 2
        covariance = np.array([[float(Decimal(int(v)) / square) for v in row] for row in self.scatter]).reshape(self.dims, self.dims)
        values, vectors = np.linalg.eigh(covariance)
        return Components(covariance, values[::-1][:k], vectors[:, ::-1][:, :k], float(np.trace(covariance)))


class Components:
    def __init__(self, covariance: np.ndarray, values: np.ndarray, vectors: np.ndarray, trace: float):
        #: a component whose variance is lost in the rounding of the greatest has none to divide by
        self.varies = values > max(trace, 0.0) * len(covariance) * np.finfo(float).eps
        self.explained = values / trace if trace > 0 else np.zeros_like(values)
        self.axes = vectors / np.sqrt(np.where(self.varies, values, 1.0))
        axes = self.axes[:, self.varies]
        # the covariance of axes' (x - S/n) is axes' V axes
        error = axes.T @ covariance @ axes - np.eye(axes.shape[1])
        self.identity_error = float(np.abs(error).max(initial=0.0))


def statistics(rows: DataFrame, vector: str, scale: int, offset: int) -> Statistics:
    """One pass over the vectors; the driver gets a few numbers per pair of dimensions."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Sums] = {}
        for batch in batches:
            if batch.num_rows:
                lengths, flat, dims = vectors_in(batch, 0)
                held.setdefault(dims, Sums(dims)).add(integers(lengths, flat, dims, scale, offset))
        for sums in held.values():
            columns = [pa.array(c, pa.int64()) for c in zip(*sums.rows(), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["dims", "i", "j", "limb", "value"])

    partial = rows.select(vector).mapInArrow(scan, "dims long, i long, j long, limb long, value long")
    # below 2^31 tasks the sum of a limb fits a long
    return Statistics(partial.groupBy("dims", "i", "j", "limb").agg(F.sum("value")).collect(), offset)


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8, scale: int = 1024, offset: int = OFFSET
) -> DataFrame:
    """One row per vector and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    An entry c counts as x = floor(scale * c) + offset. ``deviation`` is the
    sum over the dimensions of (n * x - S)^2, an exact decimal of 38 digits
    (null where it has more).

    Defined cases: rows whose vector is null or holds a null, NaN or infinite
    entry are dropped; entries that a shorter vector lacks count as c = 0, and
    entries beyond 2^61 are set to it; fewer dimensions than ``k`` give fewer
    components, vectors that are all empty none; a component without variance
    (a single row, equal rows) has a null ``whitened``, and ``identity_error``
    is over the others (0 if there are none); null keys are kept; rows that
    occur twice are two rows; an empty table gives no rows; other columns are
    not used.
    """
    rows = df.where(finite(F.col(vector))).select(F.col(key).alias("_key"), F.col(vector).alias("_vector"))
    found = statistics(rows, "_vector", scale, offset)
    parts = found.components(k)
    n, dims = found.n, found.dims
    count = len(parts.explained)
    # (n * x - S) / n in two exact steps: x minus the whole part of S / n, and the rest of that division
    whole = np.array([int(s) // max(n, 1) for s in found.sums], np.int64)
    rest = np.array([float(Decimal(int(s) % max(n, 1)) / max(n, 1)) for s in found.sums])
    sums = found.sums

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not count:
                continue
            lengths, flat, _ = vectors_in(batch, 1)
            x = integers(lengths, flat, dims, scale, offset)
            whitened = ((x - whole).astype(np.float64) - rest) @ parts.axes
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), count))),
                 pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                 pa.array(np.repeat(deviations(x, sums, n), count), pa.string()),
                 pa.array(whitened.ravel(), mask=np.tile(~parts.varies, batch.num_rows)),
                 pa.array(np.tile(parts.explained, batch.num_rows))],
                names=[key, "component", "deviation", "whitened", "explained"],
            )

    kind = rows.schema["_key"].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, deviation string, whitened double, explained double"
    return rows.mapInArrow(project, schema).select(
        f"`{key}`", "component", F.lit(n).cast("long").alias("n"), F.expr("try_cast(deviation AS decimal(38, 0))").alias("deviation"),
        "whitened", "explained", F.lit(parts.identity_error).alias("identity_error"),
    )


def deviations(x: np.ndarray, sums: np.ndarray, n: int) -> list[str]:
    """The exact sums of (n * x - S)^2 as decimal text, in longs where they fit."""
    most = n * max(int(x.max()), -int(x.min()), 0) + max((abs(int(s)) for s in sums), default=0) if x.size else 0
    off = n * x - sums.astype(np.int64) if most < 1 << 62 else n * x.astype(object) - sums
    if off.size and int(np.abs(off).max()) ** 2 * off.shape[1] >= 1 << 63:
        off = off.astype(object)
    return [str(d) for d in (off * off).sum(axis=1).tolist()]


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """The first 8 whitened components of every embedding; a deviation beyond a long's range is null."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS long)"))
