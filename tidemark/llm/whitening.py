"""Whitening of embeddings with exact second moments from bit planes.

Every entry c becomes the integer floor(64 c) + 1000000. A task takes blocks of rows, shifts each dimension by its
smallest value in the block and packs each bit of the shifted values, across the rows, into words of 64. The sum over
rows of a product of two dimensions is then a weighted count: for bit p of one and bit q of the other,
2^(p+q) times the ones in the AND of the two planes. The shift is undone in whole numbers. Sums and products of all
tasks are added by Spark as limbs of 40 bits, so nothing is rounded: n * sum(x_i x_j) - sum(x_i) sum(x_j) is formed in
integers of any size, divided once, and only then decomposed.

What reaches the driver is one row per pair of dimensions, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, spare

SCALE, OFFSET = 64, 1_000_000
#: Rows whose bits are packed together; their planes stay in a processor's cache.
BLOCK_ROWS = 4096
#: An entry of this size or more has no long integer and counts as non-finite.
ENTRY_LIMIT = 2.0**56
LIMB = 40
LIMBS = 4


@dataclass
class Moments:
    """n vectors' exact sums and sums of products, as Python integers."""

    n: int
    sums: list[int]
    products: list[list[int]]


@dataclass
class Whitening:
    """Components in rows of ``basis`` (unit eigenvectors), their eigenvalues and the trace of the covariance."""

    n: int
    sums: list[int]
    basis: np.ndarray
    values: np.ndarray
    trace: float


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers of a size that can be counted."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < ENTRY_LIMIT))


def usual_length(vectors: DataFrame) -> int:
    """The length most vectors have, the greater of equals; 0 if there is none."""
    top = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top.d if top else 0


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of the list column as integers x."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.floor(flat * SCALE).astype(np.int64) + OFFSET


def planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the columns of a block: words, each plane's column and bit, and the columns' shifts."""
    shift = x.min(0)
    y = (x - shift).astype(np.uint64)
    bits = [int(m).bit_length() for m in y.max(0)]
    column = np.repeat(np.arange(x.shape[1]), bits)
    bit = np.concatenate([np.arange(b) for b in bits]).astype(np.uint64) if column.size else np.zeros(0, np.uint64)
    ones = ((y[:, column] >> bit) & np.uint64(1)).astype(np.uint8)
    packed = np.packbits(np.ascontiguousarray(ones.T), axis=1)
    words = np.zeros((len(column), -(-packed.shape[1] // 8) * 8), np.uint8)
    words[:, : packed.shape[1]] = packed
    return words.view(np.uint64), column, bit.astype(np.int64), shift


def block_moments(x: np.ndarray) -> Moments:
    """Exact sums and products of one block by AND and count of its planes."""
    n, dims = x.shape
    words, column, bit, shift = planes(x)
    counts = np.zeros((len(words), len(words)), np.int64)
    for p in range(len(words)):
        counts[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(1, dtype=np.int64)
    counts = np.triu(counts) + np.triu(counts, 1).T
    widest = int(bit.max()) + 1 if len(bit) else 0
    kind = np.float64 if 2 * widest + n.bit_length() <= 52 else object  # doubles hold these whole numbers exactly
    weights = np.zeros((len(words), dims), kind)
    weights[np.arange(len(words)), column] = [1 << b for b in bit.tolist()]
    products = weights.T @ counts.astype(kind) @ weights
    sums = weights.T @ np.diag(counts).astype(kind)
    y, s, m = _whole(products), _whole(sums), _whole(shift)
    return Moments(n, list(s + n * m), (y + np.outer(m, s) + np.outer(s, m) + n * np.outer(m, m)).tolist())


def _whole(values: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers."""
    if values.dtype != object:
        values = values.astype(np.int64)
    return values.astype(object)


def limbs(value: int) -> tuple[int, ...]:
    """An integer as digits of 40 bits, the last one signed."""
    mask = (1 << LIMB) - 1
    return tuple((value >> (LIMB * k)) & mask for k in range(LIMBS - 1)) + (value >> (LIMB * (LIMBS - 1)),)


def moments(vectors: DataFrame, dims: int) -> Moments:
    """Exact moments of a DataFrame with one column v of lists of ``dims`` doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            x = integers(batch.column(0), dims)
            for a in range(0, len(x), BLOCK_ROWS):
                part = block_moments(x[a : a + BLOCK_ROWS])
                n += part.n
                sums = sums + np.array(part.sums, object)
                products = products + np.array(part.products, object)
        if n:
            # dimension -1 stands for the constant one: its products are the sums, and with itself the count
            entries = [(-1, -1, n)] + [(-1, j, sums[j]) for j in range(dims)] + [(i, j, products[i, j]) for i in range(dims) for j in range(i, dims)]
            digits = np.array([limbs(int(v)) for *_, v in entries], np.int64)
            columns = [pa.array([e[0] for e in entries], pa.int32()), pa.array([e[1] for e in entries], pa.int32()), *map(pa.array, digits.T)]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", *(f"l{k}" for k in range(LIMBS))])

    schema = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    rows = vectors.mapInArrow(run, schema).groupBy("i", "j").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)))
    found = {(r.i, r.j): sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS)) for r in rows.collect()}
    get = lambda i, j: found.get((min(i, j), max(i, j)), 0)
    return Moments(get(-1, -1), [get(-1, j) for j in range(dims)], [[get(i, j) for j in range(dims)] for i in range(dims)])


def fit(m: Moments, components: int) -> Whitening:
    """Eigenvectors of the covariance, falling eigenvalues. Directions without variance cannot be whitened and are left out."""
    dims = len(m.sums)
    if not m.n or not dims:
        return Whitening(m.n, m.sums, np.zeros((0, dims)), np.zeros(0), 0.0)
    square = m.n * m.n
    centred = [[m.n * m.products[i][j] - m.sums[i] * m.sums[j] for j in range(dims)] for i in range(dims)]
    covariance = np.array([[c / square for c in row] for row in centred])
    values, vectors = np.linalg.eigh(covariance)
    values, basis = values[::-1], vectors.T[::-1]
    keep = int((values > max(values[0], 0.0) * dims * 4 * np.finfo(float).eps).sum())
    keep = min(keep, components)
    basis = basis[:keep] * np.sign(basis[np.arange(keep), np.abs(basis[:keep]).argmax(1)])[:, None]
    return Whitening(m.n, m.sums, basis, values[:keep], sum(centred[i][i] for i in range(dims)) / square)


def centre(x: np.ndarray, w: Whitening) -> np.ndarray:
    """n x - S in whole numbers: longs where they fit, else Python integers."""
    if max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * w.n < 1 << 62:
        return w.n * x - np.array(w.sums, np.int64)
    return w.n * x.astype(object) - np.array(w.sums, object)


def deviations(z: np.ndarray) -> list[int]:
    """Exact sums of squares of the rows."""
    if z.dtype == object or (z.size and int(np.abs(z).max()) >= 1 << 56):
        return (z.astype(object) ** 2).sum(1).tolist()
    if z.size and z.shape[1] * int(np.abs(z).max()) ** 2 < 1 << 63:
        return (z * z).sum(1).tolist()
    high, low, total = z >> 28, z & ((1 << 28) - 1), np.zeros(len(z), object)
    for a in range(0, z.shape[1], 64):  # sums of 64 products of 28 bits fit a long
        h, l = high[:, a : a + 64], low[:, a : a + 64]  # noqa: E741
        total = total + ((h * h).sum(1).astype(object) << 56) + ((h * l).sum(1).astype(object) << 29) + (l * l).sum(1).astype(object)
    return total.tolist()


def project(z: np.ndarray, w: Whitening) -> np.ndarray:
    """Whitened coordinates of centred rows."""
    return (z.astype(np.float64) / w.n) @ (w.basis / np.sqrt(w.values)[:, None]).T


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured on all rows in one pass."""
    dims, k = len(w.sums), len(w.values)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            white = project(centre(integers(batch.column(0), dims), w), w)
            white = np.hstack([white, np.ones((len(white), 1))])
            total += white.T @ white
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    rows = vectors.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    second = np.zeros((k + 1, k + 1))
    for r in rows:
        second[r.i, r.j] = second[r.j, r.i] = r.s
    mean = second[k, :k] / w.n
    return float(np.abs(second[:k, :k] / w.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = 32, vector_col: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """One row per vector and component: the columns in ``keep``, then component (from 1), n, deviation (sum of squares of
    n x - S, an exact decimal), whitened, explained (share of the variance) and identity_error.

    All vectors take part in the fit. Left out are null vectors, vectors with null, NaN or infinite entries or entries
    of 2^56 and more, and vectors that do not have the most frequent length (the greater of equally frequent ones).
    Components are at most ``components``, at most the dimensions, and only those with variance, so equal vectors or a
    single one give no rows, nor does an empty table. Repeated rows count as often as they occur and each has its own
    result; keys may be null. Other columns are not looked at; ``keep`` may name none that the result adds.
    """
    prepare(embeddings.sparkSession)
    own = spare(embeddings, "_vector")
    quoted = [F.col(f"`{c}`") for c in keep]
    rows = embeddings.select(*quoted, F.col(f"`{vector_col}`").cast("array<double>").alias(own)).where(usable(F.col(own)))
    vectors = rows.select(F.col(own).alias("v"))
    dims = usual_length(vectors)
    rows, vectors = rows.where(F.size(own) == dims), vectors.where(F.size("v") == dims)
    w = fit(moments(vectors, dims) if dims else Moments(0, [], []), components)
    error, numbers = identity_error(vectors, w), len(w.values)
    share = w.values / w.trace if numbers else w.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows if numbers else 0, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                z = centre(integers(part.column(part.num_columns - 1), dims), w)
                white, size = project(z, w), part.num_rows
                at = pa.array(np.repeat(np.arange(size), numbers))
                kept = [part.column(c).take(at) for c in range(part.num_columns - 1)]
                deviation = pa.array([str(d) for d in deviations(z)]).cast(pa.decimal128(38, 0)).take(at)
                fixed = [pa.array(np.tile(np.arange(1, numbers + 1, dtype=np.int32), size)), pa.array(np.full(size * numbers, w.n)), deviation]
                measured = [pa.array(white.ravel()), pa.array(np.tile(share, size)), pa.array(np.full(size * numbers, error))]
                yield pa.RecordBatch.from_arrays([*kept, *fixed, *measured], [*part.schema.names[:-1], "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kept = "".join(f"`{c}` {rows.schema[k].dataType.simpleString()}, " for k, c in enumerate(keep))
    return rows.mapInArrow(run, kept + "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
