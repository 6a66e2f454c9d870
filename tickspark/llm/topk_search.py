"""Exact top-k inner-product search with two cover trees.

Vectors become integers, ``floor(scale * x)``. A bounded sample of pivots cuts the table into cells, and cells
into parts of a few thousand rows. Each query's k-th best score in its own part is a first lower bound. A group
of queries meets a part only if its ball can beat the group's worst k-th score. There a cover tree over the
queries and one over the part's vectors are walked together: a pair of nodes is dropped when

    <q, p> + r_q |p| + r_p |q| + r_q r_p

with the nodes' points and covering radii is below the worst k-th score of the queries under the node. Below a
leaf of queries each query goes on by itself, r_q = 0, down to leaves or to small nodes whose children would
rule out next to nothing.

Groups of queries and parts are compared in blocks by their balls alone. The work per query grows with the parts
that its bound cannot rule out.

A node of a cover tree is a point, the rows under it and their greatest distance from it. Its children are a net,
built farthest point first, of half that radius, or of the radius that ``FAN`` points reach where half would take more.
So a tree goes down to its leaves whatever the data; how much it rules out is up to the data.

Defined cases: rows with a null key, or a vector that is null, empty or holds null or non-finite components, take no
part. All others do, also where a key is repeated: each of its rows is a candidate of other keys, and its rows ask as
one query, whose pairs are ranked together; they are no candidates of their own. Ties go to the
smaller key. Vectors meet only vectors of their length. A query without candidates has no rows. Scores beyond
64 bits stop at the largest number. Empty tables give empty tables. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.llm.common import map_batches, map_groups, stored
from tickspark.llm.spread import spread_join

PART = 2048
MAX_PIVOTS = 256
QUERY_GROUP = 512
GROUPS_PER_TASK = 64
PARTS_PER_BLOCK = 64
LEAF = 32
FAN = 16
# A node of at most WHOLE rows is compared whole if its children rule out less than the share WORTH of its pairs.
WHOLE = 256
WORTH = 0.125
TOP = np.iinfo(np.int64).max


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows as 64-bit integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    x, y = (np.array([[int(v) for v in r] for r in m], object) for m in (a, b))
    return np.array([[max(-TOP - 1, min(TOP, int(v))) for v in r] for r in x @ y.T], np.int64)


class Node:
    __slots__ = ("point", "norm", "radius", "rows", "children", "below")

    def __init__(self, x: np.ndarray, rows: np.ndarray, center: int):
        self.point, self.rows, self.children = x[center], rows, []
        self.norm = float(np.linalg.norm(self.point))
        far = np.linalg.norm(x[rows] - self.point, axis=1)
        self.radius = float(far.max(initial=0.0))
        if len(rows) <= LEAF or not self.radius:
            return
        # each new centre is the point farthest from the centres so far
        near, owner, centers = far, np.zeros(len(rows), np.int64), [center]
        while near.max() > self.radius / 2 and len(centers) < FAN:
            i = int(near.argmax())
            centers.append(int(rows[i]))
            d = np.linalg.norm(x[rows] - x[rows[i]], axis=1)
            closer = d < near
            owner[closer], near = len(centers) - 1, np.minimum(near, d)
        if len(centers) > 1:  # distances may overflow
            self.children = [Node(x, rows[owner == k], c) for k, c in enumerate(centers)]
            self.below = (x[centers], np.array([c.radius for c in self.children]), np.array([len(c.rows) for c in self.children]))


def dual_search(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray
                ) -> tuple[list[tuple[int, int, int]], int]:
    """(query index, row index, score) of every query's k best rows among those that score at least ``least``, and
    how many pairs of a query and a row were not ruled out by their nodes."""
    kth = least.astype(np.float64).copy()
    best: list[list[tuple[int, int, int]]] = [[] for _ in query_ids]
    compared = 0
    if not len(queries) or not len(x):
        return [], compared

    lengths = np.linalg.norm(queries, axis=1)

    def ask(rows: np.ndarray, p: Node) -> None:
        """Queries of one leaf, each a node of its own with radius 0, against the rows under ``p``."""
        nonlocal compared
        if p.children:
            points, radii, sizes = p.below
            product = queries[rows] @ points.T
            bound = product + radii * lengths[rows][:, None]
            bound += 1e-6 * (1 + np.abs(bound))
            left = ~(bound < kth[rows][:, None]) @ sizes
            if len(p.rows) > WHOLE or left.sum() <= (1 - WORTH) * len(rows) * len(p.rows):
                for i in np.argsort(-product.max(axis=0)):
                    some = rows[~(bound[:, i] < kth[rows])]  # bounds have risen meanwhile
                    if len(some):
                        ask(some, p.children[i])
                return
        s = products(queries[rows], x[p.rows])
        compared += s.size
        hit = (s >= kth[rows][:, None]) & (query_ids[rows][:, None] != ids[p.rows][None, :])
        for i in np.flatnonzero(hit.any(axis=1)):
            row = int(rows[i])
            at = np.flatnonzero(hit[i])
            found = best[row] + [(-int(s[i, j]), int(ids[p.rows[j]]), int(p.rows[j])) for j in at]
            found.sort()
            best[row] = found[:k]
            if len(found) >= k:
                kth[row] = max(kth[row], -found[k - 1][0])

    def visit(q: Node, p: Node, product: float) -> None:
        bound = product + q.radius * p.norm + p.radius * q.norm + q.radius * p.radius
        if bound + 1e-6 * (1 + abs(bound)) < kth[q.rows].min():
            return
        if not q.children:
            alone = queries[q.rows] @ p.point + p.radius * lengths[q.rows]
            some = q.rows[~(alone + 1e-6 * (1 + np.abs(alone)) < kth[q.rows])]
            if len(some):
                ask(some, p)
            return
        if not p.children or q.radius * p.norm > p.radius * q.norm:
            for c in q.children:
                visit(c, p, float(c.point @ p.point))
            return
        nearest = sorted(((float(q.point @ c.point), i) for i, c in enumerate(p.children)), reverse=True)
        for s, i in nearest:
            visit(q, p.children[i], s)

    a, b = Node(queries, np.arange(len(queries)), 0), Node(x, np.arange(len(x)), 0)
    visit(a, b, float(a.point @ b.point))
    return [(i, row, -s) for i, found in enumerate(best) for s, _, row in found], compared


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v) for v in column.to_pylist()])


def whole_vectors(vectors: DataFrame, key: str, column: str, scale: float) -> DataFrame:
    """``id``, ``dim``, ``vec`` (doubles that are whole numbers) and ``n`` (how many rows are alike) of the rows that
    take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, dims, out = [], [], []
            for i, values in enumerate(batch.column(1).to_pylist()):
                if values and None not in values:
                    v = np.asarray(values, np.float64)
                    if np.isfinite(v).all() and np.isfinite(v * scale).all():
                        at.append(i)
                        dims.append(len(v))
                        out.append((np.floor(v * scale) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(dims, pa.int32()),
                                              pa.array(out, pa.binary())], ["id", "dim", "vec"])

    rows = vectors.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), column)
    return map_batches(rows, run, "id bigint, dim int, vec binary").groupBy("id", "dim", "vec").agg(F.count("*").alias("n"))


def _in_cells(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``cell``: the nearest of at most about ``MAX_PIVOTS`` pivots of their length."""
    pivots = max(1, min(MAX_PIVOTS, total // PART))
    rate = min(1.0, pivots / max(total, 1))
    sample = rows.where(F.pmod(F.xxhash64("id", "vec"), F.lit(1 << 30)) < int(rate * (1 << 30)) + 1).select("dim", "vec").limit(2 * MAX_PIVOTS).collect()
    by_dim: dict[int, np.ndarray] = {}
    for d in {r.dim for r in sample}:
        by_dim[d] = np.array(sorted(np.frombuffer(r.vec).tolist() for r in sample if r.dim == d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vecs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            cell = np.zeros(len(dims), np.int32)
            for d, p in by_dim.items():
                at = np.array([i for i, v in enumerate(dims) if v == d], np.int64)
                if len(at):
                    m = np.array([np.frombuffer(vecs[i]) for i in at])
                    cell[at] = np.argmin((p * p).sum(axis=1)[None, :] - 2 * (m @ p.T), axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return map_batches(rows.select("id", "dim", "vec", "n"), run, "id bigint, dim int, vec binary, n bigint, cell int")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", column: str = "embedding", scale: float = 1024.0
          ) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: each query's ``k`` best rows of other keys.

    ``is_query`` is a condition on ``id``, the key as a 64-bit number.
    """
    rows = stored(whole_vectors(vectors, key, column, scale), "whole-vectors")
    celled = stored(_in_cells(rows, rows.count()).withColumn("query", F.coalesce(is_query, F.lit(False))), "celled")
    sizes = stored(celled.groupBy("dim", "cell").agg(
        F.ceil(F.count("*") / PART).cast("int").alias("parts"),
        F.greatest(F.lit(1), F.ceil(F.count_if("query") / QUERY_GROUP)).cast("int").alias("groups")), "cells")
    spread = F.xxhash64("id", "vec")
    placed = stored(celled.join(sizes, ["dim", "cell"]).select(
        "id", "dim", "vec", "n", "query", F.xxhash64("dim", "cell", F.pmod(spread, F.col("parts"))).alias("part"),
        F.when(F.col("query"), F.xxhash64(F.lit("q"), "dim", "cell", F.pmod(spread, F.col("groups")))).alias("grp")), "placed")

    def seed(group: pa.Table) -> dict[str, list]:
        """The part's ball, and for each of its queries the k-th best score in the part."""
        ids, x = group.column("id").to_numpy(), _matrix(group.column("vec"))
        center = x.mean(axis=0)
        radius = float(np.linalg.norm(x - center, axis=1).max())
        q = np.flatnonzero(group.column("query").to_numpy(zero_copy_only=False))
        bounds = []
        for i in range(0, len(q), 256):
            s = products(x[q[i: i + 256]], x)
            s[ids[q[i: i + 256]][:, None] == ids[None, :]] = -TOP - 1
            bounds += (np.partition(s, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(s), -TOP - 1)).tolist()
        n = len(q)
        part, dim = group.column("part")[0].as_py(), group.column("dim")[0].as_py()
        return {"part": [part] * (n + 1), "dim": [dim] * (n + 1), "id": [*ids[q], None], "least": [*bounds, None],
                "center": [None] * n + [center.tobytes()], "radius": [None] * n + [radius]}

    seeded = stored(map_groups(placed.select("part", "dim", "id", "vec", "query"), ["part"], seed,
                               "part bigint, dim int, id bigint, least bigint, center binary, radius double"), "seeded")
    # the rows of one key ask together: the best of their bounds holds for all
    bounds = seeded.where("id IS NOT NULL").groupBy("id").agg(F.max("least").alias("least"))
    queries = stored(spread_join(placed.where("query").select("id", "dim", "vec", "n", "grp", spread.alias("row")), bounds, ["id"]), "queries")

    def ball(group: pa.Table) -> dict[str, list]:
        x = _matrix(group.column("vec"))
        center = x.mean(axis=0)
        return {"grp": [group.column("grp")[0].as_py()], "dim": [group.column("dim")[0].as_py()], "qc": [center.tobytes()],
                "qr": [float(np.linalg.norm(x - center, axis=1).max())], "worst": [min(group.column("least").to_pylist())]}

    balls = stored(map_groups(queries, ["grp"], ball, "grp bigint, dim int, qc binary, qr double, worst bigint"), "balls")
    # Query groups against parts, in blocks: every block of parts meets every group once, as balls only.
    parts = seeded.where("center IS NOT NULL").select("part", "dim", "center", "radius")
    n = max(64, parts.count() // PARTS_PER_BLOCK)
    blocks = parts.withColumn("block", F.pmod("part", F.lit(n)))
    met = balls.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(blocks, ["dim", "block"])

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                qc, pc = _matrix(rows.column(3)), _matrix(rows.column(4))
                qr, pr, worst = (rows.column(i).to_numpy() for i in (5, 6, 7))
                bound = (qc * pc).sum(axis=1) + qr * np.linalg.norm(pc, axis=1) + pr * np.linalg.norm(qc, axis=1) + qr * pr
                keep = pa.array(~(bound + 1e-6 * (1 + np.abs(bound)) < worst))  # a bound that overflows rules nothing out
                yield pa.RecordBatch.from_arrays([rows.column(0).filter(keep), rows.column(1).filter(keep)], ["grp", "part"])

    pairs = map_batches(met.select("grp", "part", "dim", "qc", "center", "qr", "radius", "worst"), reach, "grp bigint, part bigint")
    pairs = stored(pairs.withColumn("task", F.pmod(F.xxhash64("grp"), F.lit(max(1, balls.count() // GROUPS_PER_TASK)))), "pairs")
    asked = queries.join(pairs, "grp").select("part", "task", "id", "vec", "n", "least", F.lit(True).alias("query"))
    given = placed.select("part", "id", "vec", "n").join(pairs.select("part", "task").distinct(), "part").select(
        "part", "task", "id", "vec", "n", F.lit(None).cast("bigint").alias("least"), F.lit(False).alias("query"))

    def search(group: pa.Table) -> dict[str, list] | None:
        is_q = group.column("query").to_numpy(zero_copy_only=False).astype(bool)
        ids, x = group.column("id").to_numpy(), _matrix(group.column("vec"))
        least = np.array([v for v in group.column("least").to_pylist() if v is not None], np.int64)
        q, p = ids[is_q], ids[~is_q]
        n = np.minimum(group.column("n").to_numpy(), k)  # no pair has more than k places
        found, _ = dual_search(x[is_q], q, x[~is_q], p, k, least)
        if not found:
            return None
        i, j = (np.array([f[c] for f in found]) for c in (0, 1))
        return {"query_id": q[i], "vec_id": p[j], "score": [f[2] for f in found], "n": np.minimum(n[is_q][i] * n[~is_q][j], k)}

    found = map_groups(asked.unionByName(given), ["part", "task"], search, "query_id bigint, vec_id bigint, score bigint, n bigint")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

