"""Whitening of embeddings on exact second moments.

Entries become whole numbers first, so sums and cross-products can be exact. A task takes its
vectors in blocks, shifts every dimension to start at zero and cuts it into bit planes: bit k of a
dimension, packed across the rows of the block into 64-bit words. The cross-product of two
dimensions is then the sum over their planes k and l of 2**(k + l) times the number of ones
in (plane k AND plane l). The shift is undone exactly, tasks hand over whole numbers in limbs, and
Spark adds them up. The driver holds one matrix of dimensions by dimensions, whatever the number of
vectors: it centres it as whole numbers (n * products - sums * sums) and only then goes to doubles, for
the eigenvectors. Two more passes stream the vectors past the broadcast model, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, SHIFT = 1024, 100_000  # x = floor(SCALE * entry) + SHIFT
LARGEST = float(1 << 52)  # entries from here on are taken as not finite
COMPONENTS = 8
BLOCK_ENTRIES = 1 << 20  # numbers in one block
LIMB = 40  # bits; sums of 2**23 limbs fit into a long
NOTHING = 1e-12  # an eigenvalue below this share of the largest is rounding

_SUMS = T.StructType(
    [
        T.StructField("size", T.IntegerType()),
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("limb", T.IntegerType()),
        T.StructField("value", T.LongType()),
    ]
)


def whole_vectors(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of whole numbers) of the vectors that take part, by length and in blocks."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore"):
        odd = np.cumsum(np.append(0, ~(np.abs(values) < LARGEST)))  # NULL reads as not a number
    taken = (lengths > 0) & (odd[ends] == odd[ends - lengths])
    for length in np.unique(lengths[taken]):
        rows = np.flatnonzero(taken & (lengths == length))
        step = max(1, BLOCK_ENTRIES // int(length))
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            entries = values[(ends[part] - length)[:, None] + np.arange(length)]
            yield part, np.floor(SCALE * entries).astype(np.int64) + SHIFT


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns of whole numbers, and of the products of every two (j >= i), as Python integers."""
    n, d = x.shape
    least = x.min(axis=0)
    shifted = (x - least).T.astype(np.uint64)
    bits = int(shifted.max()).bit_length()
    planes = np.zeros((bits, d, -(-n // 64) * 8), np.uint8)
    for k in range(bits):
        planes[k, :, : -(-n // 8)] = np.packbits(((shifted >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), axis=1)
    words = planes.view(np.uint64)
    exact = np.int64 if 2 * bits + n.bit_length() < 63 else object
    products = np.zeros((d, d), exact)
    weights = np.array([1 << k for k in range(bits)], exact).reshape(-1, 1)
    for i in range(d):
        for k in range(bits):
            ones = np.bitwise_count(words[k, i] & words[:, i:]).sum(axis=-1, dtype=np.int64)
            products[i, i:] += (ones.astype(exact) * weights).sum(axis=0) * (1 << k)
    # x = shifted + least, undone in whole numbers of any size
    least, above = least.astype(object), shifted.astype(object).sum(axis=1) if exact is object else shifted.sum(axis=1).astype(object)
    products = products.astype(object) + np.outer(least, above) + np.outer(above, least) + n * np.outer(least, least)
    return above + n * least, np.triu(products)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    at = 0
    while not -(1 << (LIMB - 1)) <= value < 1 << (LIMB - 1):
        yield at, value & ((1 << LIMB) - 1)
        value, at = value >> LIMB, at + 1
    yield at, value


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors -> number (i = j = -1), sums (i = -1) and cross-products of this task, in limbs."""
    totals: dict[int, list] = {}
    for batch in batches:
        for rows, x in whole_vectors(batch.column(0)):
            sums, products = cross_products(x)
            held = totals.setdefault(x.shape[1], [0, 0, 0])
            held[0], held[1], held[2] = held[0] + len(rows), held[1] + sums, held[2] + products
    for size, (n, sums, products) in totals.items():
        cells = [(-1, -1, n)] + [(-1, j, int(s)) for j, s in enumerate(sums)]
        cells += [(i, j, int(products[i, j])) for i in range(size) for j in range(i, size)]
        rows = [(size, i, j, limb, part) for i, j, value in cells for limb, part in _limbs(value)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if name == "value" else pa.int32()) for name, c in zip(_SUMS.names, zip(*rows))],
            names=_SUMS.names,
        )


@dataclass
class Model:
    """Whitening of the vectors of one length."""

    n: int
    sums: np.ndarray  # Python integers
    eigenvalues: np.ndarray  # falling
    components: np.ndarray  # one column each
    explained: np.ndarray

    @property
    def scales(self) -> np.ndarray:
        """One over the standard deviation of each component; zero where nothing varies."""
        positive = self.eigenvalues > NOTHING * max(self.eigenvalues[0], 0)
        return np.where(positive, 1 / np.sqrt(np.where(positive, self.eigenvalues, 1)), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: longs where they are sure to fit, else Python integers."""
        bound = self.n * int(np.abs(x).max()) + max(abs(int(s)) for s in self.sums)
        exact = np.int64 if bound < 1 << 62 else object
        return x.astype(exact) * self.n - self.sums.astype(exact)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.components * self.scales

    def deviation(self, centred: np.ndarray) -> list[int]:
        """Sum of squares per row, exact."""
        wide = int(np.abs(centred).max()) ** 2 * centred.shape[1] >= 1 << 62
        return ((centred.astype(object) if wide else centred) ** 2).sum(axis=1).tolist()


def solve(n: int, sums: np.ndarray, products: np.ndarray, components: int = COMPONENTS) -> Model:
    """The model of exact moments: centred in whole numbers, then eigenvectors in doubles."""
    upper = np.triu(products)
    products = upper + np.triu(upper, 1).T
    covariance = ((n * products - np.outer(sums, sums)) / (n * n)).astype(np.float64)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(len(order))] < 0, -1.0, 1.0)
    trace = float(np.trace(covariance))
    return Model(n, sums, values, vectors, values / trace if trace > 0 else np.zeros(len(order)))


def fit(vectors: DataFrame, components: int = COMPONENTS, vector_column: str = "embedding") -> dict[int, Model]:
    """A model per length of vector, from all vectors."""
    parts = vectors.select(vector_column).mapInArrow(_moments, _SUMS)
    sums = parts.groupBy("size", "i", "j", "limb").agg(F.sum("value").alias("value")).toArrow()
    cells: dict[int, dict[tuple[int, int], int]] = {}
    for size, i, j, limb, value in zip(*(sums.column(c).to_pylist() for c in _SUMS.names)):
        held = cells.setdefault(size, {})
        held[i, j] = held.get((i, j), 0) + (value << (LIMB * limb))
    models = {}
    for size, held in cells.items():
        products = np.array([[held.get((i, j), 0) for j in range(size)] for i in range(size)], object)
        models[size] = solve(held[-1, -1], np.array([held[-1, j] for j in range(size)], object), products, components)
    return models


_COVARIANCE = T.StructType(
    [
        T.StructField("size", T.IntegerType()),
        T.StructField("a", T.IntegerType()),
        T.StructField("b", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def identity_errors(vectors: DataFrame, models: dict[int, Model], vector_column: str = "embedding") -> dict[int, float]:
    """Per length, the largest absolute entry of the whitened vectors' covariance minus the identity.

    Over the components that vary; 0 if none does.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in whole_vectors(batch.column(0)):
                model = shared.value[x.shape[1]]
                z = model.whiten(model.centred(x))
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + z.T @ z
        for size, square in totals.items():
            a, b = np.indices(square.shape, np.int32)
            columns = [np.full(square.size, size, np.int32), a.ravel(), b.ravel(), square.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_COVARIANCE.names)

    errors = dict.fromkeys(models, 0.0)
    cells = vectors.select(vector_column).mapInArrow(spread, _COVARIANCE).groupBy("size", "a", "b").agg(F.sum("value").alias("value"))
    for size, a, b, value in cells.collect():
        varies = models[size].scales > 0
        if varies[a] and varies[b]:
            errors[size] = max(errors[size], abs(value / models[size].n - (a == b)))
    return errors


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """A row per vector and component (at most ``components``, numbered from 1 by falling eigenvalue).

    Columns: the id, ``component``, ``n`` (vectors of the fit), ``deviation`` (decimal: the exact sum of
    squares of n * x - sums), ``whitened``, ``explained`` (share of the component in the total variance) and
    ``identity_error`` (measured over all whitened vectors). All vectors are fitted, and x is
    floor(1024 * entry) + 100000.

    Vectors that are NULL, empty, or hold an entry that is NULL, not finite or 2**52 or more in size take no
    part. Vectors of another length form a fit of their own. Ids are not read: NULL and repeated
    ids stay. A component without variance (equal vectors, or fewer than dimensions) has ``whitened`` 0.
    Components of equal eigenvalues may be any of their plane, the same for all rows. The largest
    entry of a component is positive. An empty table gives no rows; other columns are not read.
    """
    models = fit(vectors, components, vector_column)
    errors = identity_errors(vectors, models, vector_column)
    shared = vectors.sparkSession.sparkContext.broadcast((models, errors))
    schema = T.StructType(
        [
            T.StructField(id_column, vectors.schema[id_column].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation_text", T.StringType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, errors = shared.value
        for batch in batches:
            for taken, x in whole_vectors(batch.column(1)):
                model = models[x.shape[1]]
                centred = model.centred(x)
                k, m = len(model.eigenvalues), len(taken)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(taken, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n, np.int64)),
                        pa.array([s for s in map(str, model.deviation(centred)) for _ in range(k)], pa.string()),
                        pa.array(model.whiten(centred).ravel()),
                        pa.array(np.tile(model.explained, m)),
                        pa.array(np.full(m * k, errors[x.shape[1]])),
                    ],
                    names=schema.names,
                )

    whitened = vectors.select(id_column, vector_column).mapInArrow(rows, schema)
    exact = F.col("deviation_text").try_cast("decimal(38,0)").alias("deviation")
    return whitened.select(id_column, "component", "n", exact, "whitened", "explained", "identity_error")
