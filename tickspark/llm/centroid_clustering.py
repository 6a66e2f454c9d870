"""Lloyd's clustering of integer vectors by popcounts of bit planes.

Components become integers, floor(scale * x). Each bit plane of 64 components is one 64-bit word, in two's
complement, so a vector of b-bit components is b words. With the centroids cut alike, the product of two vectors is
the sum of popcount(x_i AND c_j) * w_i * w_j over the planes i and j, where a plane weighs its power of two, and the
last one, the sign, that power negated. Dot products, norms and squared distances come out exact.

A round maps every block of vectors to the nearest centroids and leaves, per task, one row of counts and sums for
each cluster; Spark adds them up. Only k centroids and k rows of sums pass the driver, so equal vectors, however
many, never meet in a task.

Defined cases: vectors of another length than ``size``, null ones and ones with null or non-finite components are
dropped; so are those with a component beyond 2**26 after scaling, since squared distances of such vectors need not fit a
long. Fewer vectors than ``k`` give that many centroids, an empty table gives an empty one. Repeated rows and null keys
are vectors like others; null keys come last among the first centroids, and rows of one key there are ordered by their
words. Equal distances go to the smaller centroid. A cluster without vectors keeps its centroid and has no row.
Inertias beyond a long are null. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import map_batches, stored

#: Largest magnitude of a component: 64 squared differences of twice this stay below 2**63.
LARGEST = 2**26
#: Vectors whose words meet the centroids' at a time; keeps the products in the processor's cache.
BLOCK = 2048


def quantised(column: pa.Array, size: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors of a list column and their integer components, a row each."""
    usable = np.asarray(column.is_valid()) & (np.asarray(column.value_lengths().fill_null(-1)) == size)
    at = np.flatnonzero(usable)
    values = column.take(pa.array(at)).flatten()
    missing = np.asarray(values.is_null()).reshape(-1, size)
    given = values.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, size)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(scale * given)
        ok = ~missing.any(axis=1) & np.isfinite(given).all(axis=1) & (np.abs(whole) <= LARGEST).all(axis=1)
    return at[ok], whole[ok].astype(np.int64)


def n_planes(values: np.ndarray) -> int:
    """Planes that hold all ``values`` in two's complement."""
    return max(int(values.max(initial=0)), ~int(values.min(initial=0))).bit_length() + 1


def bit_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, words): plane i holds bit i of 64 components in each word."""
    n, size = values.shape
    words = -(-size // 64)
    padded = np.zeros((n, words * 64), np.int64)
    padded[:, :size] = values
    bits = (padded[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8").reshape(n, planes, words)


def unpacked(planes: np.ndarray, size: int) -> np.ndarray:
    """The components back from their planes."""
    bits = np.unpackbits(planes.view(np.uint8).reshape(*planes.shape[:2], -1), axis=2, bitorder="little")[:, :, :size]
    return np.einsum("npd,p->nd", bits.astype(np.int64), weights(planes.shape[1]))


def weights(planes: int) -> np.ndarray:
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact products of all vectors with all centroids, both as planes."""
    out = np.zeros((len(x), len(c)), np.int64)
    for i, wi in enumerate(weights(x.shape[1])):
        row = np.zeros_like(out)
        for j, wj in enumerate(weights(c.shape[1])):
            for word in range(x.shape[2]):
                row += np.bitwise_count(x[:, i, word, None] & c[None, :, j, word]) * wj
        out += row * wi
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Exact squared norms from a vector's own planes."""
    out = np.zeros(len(x), np.int64)
    w = weights(x.shape[1])
    for i in range(len(w)):
        for j in range(i + 1):
            shared = np.bitwise_count(x[:, i] & x[:, j]).sum(axis=1, dtype=np.int64)
            out += shared * (w[i] * w[j] * (1 if i == j else 2))
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller among equals) and the squared distance to it."""
    home, far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    of_c = norms(c)
    for a in range(0, len(x), BLOCK):
        part = x[a: a + BLOCK]
        distance = norms(part)[:, None] + of_c[None, :] - 2 * dots(part, c)
        home[a: a + BLOCK] = distance.argmin(axis=1)
        far[a: a + BLOCK] = distance[np.arange(len(part)), home[a: a + BLOCK]]
    return home, far


def stacked(column: pa.Array, words: int) -> np.ndarray:
    """Planes of a batch. Vectors of fewer planes repeat their sign."""
    packed = [np.frombuffer(v, "<u8").reshape(-1, words) for v in column.to_pylist()]
    most = max(map(len, packed))
    return np.stack([np.concatenate([p, np.repeat(p[-1:], most - len(p), axis=0)]) for p in packed])


def packed_vectors(vectors: DataFrame, key: str, column: str, size: int, scale: float) -> DataFrame:
    """``key`` and ``planes``, the words of all bit planes, of each usable vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = quantised(batch.column(1), size, scale)
            planes = bit_planes(values, n_planes(values))
            own = [p[:n_planes(v)].tobytes() for p, v in zip(planes, values)]  # equal vectors, equal words, in any batch
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(own, pa.binary())], [key, "planes"])

    kind = vectors.schema[key].dataType.simpleString()
    given = vectors.select(key, F.col(column).cast("array<double>").alias("planes"))
    return map_batches(given, run, f"`{key}` {kind}, planes binary")


def cluster_sums(packed: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """Number, count and componentwise sums of every cluster that has vectors."""
    k, size = centroids.shape
    words = -(-size // 64)
    c = bit_planes(centroids, n_planes(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = stacked(batch.column(0), words)
                home, _ = nearest(x, c)
                np.add.at(total, home, unpacked(x, size))
                count += np.bincount(home, minlength=k)
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(count[seen]), *[pa.array(total[seen, d]) for d in range(size)]],
            ["cluster", "n", *[f"s{d}" for d in range(size)]])

    sums = [f"s{d}" for d in range(size)]
    rows = map_batches(packed.select("planes"), run, ", ".join(f"{c_} bigint" for c_ in ("cluster", "n", *sums)))
    added = rows.groupBy("cluster").agg(F.sum("n"), *[F.sum(s) for s in sums]).collect()  # k rows
    return [(r[0], r[1], list(r[2:])) for r in added]


def cluster(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", size: int = 64, scale: float = 256, k: int = 40,
            rounds: int = 5, seed: str = "2") -> DataFrame:
    """One row per usable vector: ``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``<seed>:<key>``, in that order.
    """
    spark, words = vectors.sparkSession, -(-size // 64)
    packed = stored(packed_vectors(vectors, key, column, size, scale), "planes")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    first = packed.orderBy(order.asc_nulls_last(), "planes").limit(k).collect()
    centroids = np.array([unpacked(np.frombuffer(r["planes"], "<u8").reshape(1, -1, words), size)[0] for r in first], np.int64)
    kind = vectors.schema[key].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame(
            [], f"`{key}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    for _ in range(rounds):
        for number, n, total in cluster_sums(packed, centroids):
            centroids[number] = [s // n for s in total]
    c = bit_planes(centroids, n_planes(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home, far = nearest(stacked(batch.column(1), words), c)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(home, pa.int32()), pa.array(far)], [key, "cluster", "distance"])

    assigned = stored(map_batches(packed, run, f"`{key}` {kind}, cluster int, distance bigint"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    per = {r["cluster"]: int(r["s"]) for r in sums}
    fits = lambda v: v if v < 2**63 else None
    rows = [(number, fits(s), fits(sum(per.values())), hashlib.sha256(",".join(map(str, centroids[number])).encode()).hexdigest())
            for number, s in per.items()]
    totals = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(totals), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
