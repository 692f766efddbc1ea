"""Whitening of embeddings from an exact scatter matrix counted on bit planes.

Entries become integers. Per block of rows, each dimension is shifted by its least value there and cut
into bit planes, and every plane is packed across the rows into 64-bit words. A cross-product of two
dimensions is then the sum over their planes of 2^(p+q) times the set bits of the AND of both, and the
shift is taken back in integers. Block sums are added up by Spark as decimals; the driver holds one
matrix of dimensions by dimensions, centred as integers and only then divided and decomposed.

Defined results: rows whose vector is NULL, or holds a NULL or non-finite entry, or one outside +-2^53
(whose scaled value a double no longer holds exactly), are dropped; so are vectors shorter or longer than
the commonest length (the greater of equally common ones). Components whose eigenvalue is not above
rounding do not exist: one distinct vector, or an empty table, gives no rows. Rows that repeat an id or
a vector are rows each, but a vector counts once in the fit. Equal eigenvalues come in the order of the
solver. A deviation that does not fit a long is NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.llm.common import map_batches, record_batch
from newsdesk.session import store

SCALE = 256
COMPONENTS = 4
#: Rows whose bit planes are packed at once.
PACKED_ROWS = 1 << 14
LIMIT = float(1 << 53)


def scaled(rows: DataFrame, vector: str, *keep: str) -> DataFrame:
    """The columns `keep` and `x`, the integer vector, of every row that is not dropped."""
    entries = F.col(vector).cast("array<double>")
    usable = entries.isNotNull() & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    x = F.transform(entries, lambda c: F.floor(c * SCALE))
    found = rows.filter(usable).select(*keep, x.alias("x")).filter(F.size("x") > 0)
    common = found.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return found.filter(F.size("x") == (common["d"] if common else -1))


def matrix_of(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one integer matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of the bit planes of a non-negative matrix rows x dimensions; one row of
    words per plane that has a bit set."""
    words, dimension, bit = [], [], []
    count = -(-len(values) // 64)
    for d in range(values.shape[1]):
        column = values[:, d]
        for p in range(int(column.max()).bit_length()):
            packed = np.zeros(count * 8, np.uint8)
            raw = np.packbits((column >> np.uint64(p)).astype(np.uint8) & 1, bitorder="little")
            packed[: len(raw)] = raw
            words.append(packed.view(np.uint64))
            dimension.append(d)
            bit.append(p)
    return np.array(words, np.uint64).reshape(-1, count), np.array(dimension, np.int64), np.array(bit, np.int64)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cross-products, sums) of the columns of an integer matrix, exact, as Python integers."""
    n, dims = x.shape
    least = x.min(axis=0)
    shifted = (x - least).view(np.uint64) if x.dtype == np.int64 else (x - least).astype(np.uint64)
    words, dimension, bit = planes(shifted)
    products = np.zeros((dims, dims), object)
    sums = np.zeros(dims, object)
    np.add.at(sums, dimension, [int(c) << int(b) for c, b in zip(np.bitwise_count(words).sum(axis=1), bit)])
    starts = np.searchsorted(dimension, np.arange(dims + 1))
    for i in range(len(words)):
        common = np.bitwise_count(words[i] & words[starts[dimension[i]] :]).sum(axis=1)
        other = dimension[starts[dimension[i]] :]
        weights = np.array([1 << int(b + bit[i]) for b in bit[starts[dimension[i]] :]], object)
        np.add.at(products[dimension[i]], other, common.astype(object) * weights)
    products = np.triu(products) + np.triu(products, 1).T
    shift = np.array([int(v) for v in least], object)
    products = products + np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)
    return products, sums + n * shift


@dataclass
class Whitener:
    """n distinct vectors with the sums S; unit eigenvectors by column, their eigenvalues, the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        far = max([abs(int(x.min())), abs(int(x.max())), 1]) * self.n + max(map(abs, self.sums)) if x.size else 0
        if far < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of the rows of x."""
        return (self.centred(x) / self.n).astype(float) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        far = self.centred(x)
        if far.dtype != object and len(far) and float(np.abs(far).max()) ** 2 * far.shape[1] < 2.0**62:
            return (far * far).sum(axis=1).tolist()
        sums = [sum(int(v) * int(v) for v in row) for row in far]
        return [s if s < 1 << 63 else None for s in sums]


def sums_of(vectors: DataFrame) -> DataFrame:
    """(i, j, value): exact cross-products of dimensions i <= j of all rows `x`; i = -1 for the sums and
    i = j = -1 for the number of rows. Each task sends one matrix."""
    vectors.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")

    def run(batches):
        total, waiting, held = None, [], 0

        def add():
            nonlocal total, waiting, held
            x = np.concatenate(waiting)
            products, sums = scatter(x)
            total = (products, sums, len(x)) if total is None else (total[0] + products, total[1] + sums, total[2] + len(x))
            waiting, held = [], 0

        for batch in batches:
            if batch.num_rows:
                waiting.append(matrix_of(batch.column("x")))
                held += batch.num_rows
                if held >= PACKED_ROWS:
                    add()
        if held:
            add()
        if total is not None:
            products, sums, n = total
            dims = len(sums)
            rows = [(-1, -1, n), *((-1, j, int(sums[j])) for j in range(dims)), *((i, j, int(products[i, j])) for i in range(dims) for j in range(i, dims))]
            i, j, value = zip(*rows)
            yield record_batch(i=pa.array(i, pa.int32()), j=pa.array(j, pa.int32()), value=pa.array([str(v) for v in value], pa.string()))

    parts = vectors.mapInArrow(run, "i int, j int, value string")
    return parts.groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Whitener of the distinct vectors `x`; None where no component exists."""
    rows = [(r["i"], r["j"], int(r["value"])) for r in sums_of(vectors).collect()]  # dimensions squared, not rows
    if not rows:
        return None
    found = {(i, j): v for i, j, v in rows}
    n = found[-1, -1]
    dims = max(j for _, j, _ in rows) + 1
    sums = [found[-1, j] for j in range(dims)]
    covariance = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            covariance[i, j] = covariance[j, i] = (n * found[i, j] - sums[i] * sums[j]) / (n * n)
    values, basis = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    order = [k for k in order if values[k] > dims * np.finfo(float).eps * values[-1]]
    if not order:
        return None
    trace = sum(n * found[i, i] - sums[i] ** 2 for i in range(dims)) / (n * n)
    return Whitener(n, sums, basis[:, order], values[order], trace)


def whitened(vectors: DataFrame, model: Whitener, *keep: str) -> DataFrame:
    """The columns `keep`, `w` (whitened coordinates) and `deviation` of every row `x`."""
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in keep}
    sent = vectors.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch):
        x = matrix_of(batch.column("x"))
        points = sent.value.project(x)
        yield record_batch(**{c: batch.column(c) for c in keep}, w=pa.array(list(points), pa.list_(pa.float64())), deviation=pa.array(sent.value.deviations(x), pa.int64()))

    return map_batches(vectors.select(*keep, "x"), step, ", ".join([*[f"`{c}` {k}" for c, k in kinds.items()], "w array<double>, deviation bigint"]))


def identity_error(vectors: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = len(model.values)
    points = whitened(vectors, model).select(*[F.col("w")[i].alias(f"w{i}") for i in range(k)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = points.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(got, pairs))


def whiten(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: the id, component (from 1), n, deviation, whitened, explained and
    identity_error."""
    source = scaled(rows, vector, row_id)
    distinct = store(source.select("x").distinct())
    model = fit(distinct, components)
    kind = rows.schema[row_id].dataType.simpleString()
    if model is None:
        return rows.sparkSession.createDataFrame([], f"`{row_id}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    out = whitened(source, model, row_id).select(row_id, "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(row_id, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.get(shares, F.col("at")).alias("explained"), F.lit(float(identity_error(distinct, model))).alias("identity_error"))
