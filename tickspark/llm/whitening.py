"""PCA whitening of integer vectors from their weighted multiplicities.

Components become integers, x = floor(scale * c) + shift. Equal vectors are grouped; a distinct vector weighs its
count, or one with ``weights="ones"``. Sums are exact integers; vectors are centred exactly, as n * x - S, before
they are divided and multiplied, so a common offset costs no digits. The weighted product of the centred vectors is a
matrix of their length squared, summed over the tasks; its eigenvectors turn every distinct vector once, and the rows
take their results back by a join, in which copies of one vector are dealt over many tasks.

Only n, the sums, and two matrices pass the driver: the covariance (length squared) and that of the whitened
vectors (``components`` squared), from which ``identity_error`` is read.

Defined cases: rows are dropped whose vector is null or empty, has null or non-finite components, components of 2**40 or more
after scaling, or another length than the most frequent one (the smallest among equals). A component whose eigenvalue is
zero to double precision cannot be whitened: its ``whitened`` is null, its share 0, and it takes no part in
``identity_error``, which is null if no component has variance. Repeated rows count as often as they occur. Null keys are
keys like others. An empty table gives an empty one. Other columns are ignored, whatever their names. Eigenvectors
point where their largest component, the first among equals, is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import map_batches, stored
from tickspark.llm.spread import numbered, spread_join

LARGEST = 2**40


def quantised(column: pa.Array, scale: float, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the usable vectors of a list column and their integers, for each length in turn."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    for size in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == size)
        values = column.take(pa.array(at)).flatten()
        missing = np.asarray(values.is_null()).reshape(-1, size).any(axis=1)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(scale * values.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, size))
            ok = ~missing & (np.abs(x) < LARGEST).all(axis=1)  # false for NaN and infinity
        yield at[ok], x[ok].astype(np.int64) + shift


def as_bytes(x: np.ndarray) -> bytes:
    """Four bytes per component where all fit, else eight: the first byte tells which."""
    return b"i" + x.astype("<i4").tobytes() if (np.abs(x) < 2**31).all() else b"l" + x.astype("<i8").tobytes()


def from_bytes(column: pa.Array) -> np.ndarray:
    """Rows of :func:`as_bytes`, all of one length."""
    return np.array([np.frombuffer(v, "<i4" if v[:1] == b"i" else "<i8", offset=1).astype(np.int64) for v in column.to_pylist()])


def integer_rows(vectors: DataFrame, key: str, column: str, scale: float, shift: int) -> DataFrame:
    """``row``, ``key``, ``size``, ``x`` and its 128-bit hash ``h`` of each usable vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, xs in quantised(batch.column(1), scale, shift):
                rows = [numbered(seen + i, task) for i in range(len(at))]
                seen += len(at)
                x = [as_bytes(v) for v in xs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), batch.column(0).take(pa.array(at)), pa.array([xs.shape[1]] * len(at), pa.int32()),
                     pa.array(x, pa.binary()), pa.array([xxhash.xxh3_128_digest(v) for v in x], pa.binary())], ["row", key, "size", "x", "h"])

    kind = vectors.schema[key].dataType.simpleString()
    return map_batches(vectors.select(key, column), run, f"row bigint, `{key}` {kind}, size int, x binary, h binary")


def exact_sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """n and the weighted sum of every dimension, as integers of any size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * d, 0
        for batch in batches:
            if batch.num_rows:
                x, w = from_bytes(batch.column(0)), batch.column(1).to_pylist()
                n += sum(w)
                if int(np.abs(x).max()) * sum(w) < 2**63:
                    part = (x * np.array(w)[:, None]).sum(axis=0).tolist()
                else:
                    part = [sum(a * b for a, b in zip(column, w)) for column in x.T.tolist()]
                total = [a + b for a, b in zip(total, part)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d + 1), pa.int32()), pa.array([Decimal(v) for v in [*total, n]], pa.decimal128(38, 0))], ["at", "s"])

    got = dict(map_batches(distinct.select("x", "w"), run, "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s")).collect())
    return int(got.get(d, 0)), [int(got.get(i, 0)) for i in range(d)]  # d + 1 numbers


def scaled_deviation(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit where everything fits, else Python's integers."""
    if int(np.abs(x).max(initial=0)) * n + max(map(abs, s)) < 2**63:
        return x * np.int64(n) - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def squared_sums(deviation: np.ndarray) -> list[int]:
    """Exact sums of squares of the rows."""
    if deviation.dtype != object and int(np.abs(deviation).max(initial=0)) ** 2 * deviation.shape[1] < 2**63:
        return (deviation * deviation).sum(axis=1).tolist()
    return [sum(v * v for v in row) for row in deviation.tolist()]


def added_matrix(rows: DataFrame, make, d: int) -> np.ndarray:
    """The sum over all tasks of the d x d matrix that ``make`` gives for a task's batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                total += make(batch)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i * d + j), pa.array(total[i, j])], ["at", "s"])

    out = np.zeros(d * d)
    for at, s in map_batches(rows, run, "at bigint, s double").groupBy("at").agg(F.sum("s")).collect():  # d * (d + 1) / 2 numbers
        out[at] = s
    out = out.reshape(d, d)
    return np.triu(out) + np.triu(out, 1).T


def weighted_product(centred: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (centred * w[:, None]).T @ centred


def principal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues by falling size, unit eigenvectors in columns, and which eigenvalues are not zero."""
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(v))]
    return values, vectors * np.where(lead < 0, -1.0, 1.0), values > values.max(initial=0) * len(v) * np.finfo(float).eps


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", scale: float = 64, shift: int = 1_000_000,
           components: int = 32, weights: str = "counts") -> DataFrame:
    """A row per usable vector and component: ``key``, ``component``, ``n``, ``deviation`` (decimal), ``whitened``,
    ``explained`` and ``identity_error``. ``n`` is the sum of the weights."""
    if weights not in ("counts", "ones"):
        raise ValueError("weights are 'counts' or 'ones'")
    kind = vectors.schema[key].dataType.simpleString()
    empty = vectors.sparkSession.createDataFrame([], (
        f"`{key}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"))
    rows = stored(integer_rows(vectors, key, column, scale, shift), "integers")
    usual = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not usual:
        return empty
    d = usual[0]["size"]
    rows = rows.where(F.col("size") == d)
    weight = F.count("*") if weights == "counts" else F.max(F.lit(1).cast("bigint"))
    distinct = stored(rows.groupBy("h", "x").agg(weight.alias("w")), "distinct")
    n, s = exact_sums(distinct, d)

    def moment(batch: pa.RecordBatch) -> np.ndarray:
        centred = scaled_deviation(from_bytes(batch.column(0)), n, s).astype(np.float64) / n
        return weighted_product(centred, batch.column(1).to_numpy().astype(np.float64))

    v = added_matrix(distinct.select("x", "w"), moment, d) / n
    e, basis, varied = principal(v)
    k = min(components, d)
    live = np.flatnonzero(varied[:k])
    turn = basis[:, live] / np.sqrt(e[live])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = scaled_deviation(from_bytes(batch.column(1)), n, s)
                y = far.astype(np.float64) / n @ turn
                sums = [v if abs(v) < 10**38 else None for v in map(Decimal, squared_sums(far))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sums, pa.decimal128(38, 0)), pa.array(list(y), pa.list_(pa.float64())), batch.column(2)],
                    ["h", "deviation", "y", "w"])

    turned = stored(map_batches(distinct.select("h", "x", "w"), run, "h binary, deviation decimal(38,0), y array<double>, w bigint"), "whitened")
    error = None
    if len(live):
        m = len(live)
        means = dict(turned.select(F.posexplode("y"), "w").groupBy("pos").agg(F.sum(F.col("col") * F.col("w")) / n).collect())  # m numbers
        mean = np.array([means[i] for i in range(m)])

        def product(batch: pa.RecordBatch) -> np.ndarray:
            y = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, m) - mean
            return weighted_product(y, batch.column(1).to_numpy().astype(np.float64))

        error = float(np.abs(added_matrix(turned.select("y", "w"), product, m) / n - np.eye(m)).max())
    trace = float(np.trace(v))
    shares = [float(e[i] / trace) if varied[i] else 0.0 for i in range(k)]
    places = np.full(k, None, object)
    places[live] = range(len(live))
    listed = F.array(*[F.struct(
        F.lit(i + 1).alias("component"), (F.lit(None).cast("double") if places[i] is None else F.col("y")[int(places[i])]).alias("whitened"),
        F.lit(shares[i]).alias("explained")) for i in range(k)])
    joined = spread_join(rows.select("row", F.col(key).alias("_key"), "h"), turned.select("h", "deviation", "y"), ["h"])
    return joined.select("_key", "deviation", F.inline(listed)).select(
        F.col("_key").alias(key), "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).cast("double").alias("identity_error"))
