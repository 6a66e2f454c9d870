"""Near-duplicate vectors within a label, by PCA-ordered tiled comparison.

Unit vectors are turned into the basis of their principal components, which changes no product. Their leading
coordinates cut a label into cells as wide as two linked vectors can be apart, so links stay within a cell
and its neighbours. A cell is cut by one coordinate more only where it holds more rows than a tile, so small labels are
one cell, and the rows that meet a cell do not grow with the table until the coordinates are used up; what is
larger even then is cut into tiles. A pair of tiles is one task: it rules out blocks by their bounding
boxes, adds up products over leading coordinates first, bounds the rest by the product of the suffix norms and drops a pair
as soon as its cosine cannot reach the threshold. What is left is decided by the cosine of the given vectors in double precision.

Equal vectors of one label are compared once. A task returns, per class of equal vectors, how many rows
it links to, and a spanning forest, never the pairs. The basis comes from sums over all vectors; it is one
matrix of the vectors' length, whatever the table. A vector is shuffled once for each cell it meets, as given, and turned
again in the task. Cells, tiles and partners are found without the vectors.

Defined cases: rows with a null label, or a vector that is null, empty, zero or holds null or non-finite
components, link with nothing. Vectors of different lengths do not link. Repeated rows link with each other; a
component is named by its smallest key. Empty tables give empty tables. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import map_batches, map_groups, stored
from tickspark.llm.components import named_groups, spanning_forest

#: At most so many rows and, down to LEAST_TILE rows, so many numbers in a tile.
TILE = 4096
TILE_NUMBERS = 1 << 21
LEAST_TILE = 512
BLOCK = 256
#: Leading coordinates that may cut cells, and those by which neighbours are looked up.
LEAD = 8
LOOKUP = 3
STEPS = (8, 16, 32)


def valid(values: list | None) -> np.ndarray | None:
    """The vector in double precision, or None where it links with nothing."""
    if not values or None in values:
        return None
    v = np.asarray(values, np.float64)
    return v if np.isfinite(v).all() and v.any() else None


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()
    return v / math.sqrt(float(v @ v))


def basis(vectors: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """The most frequent length and the principal directions of the unit vectors of that length."""
    sizes = vectors.groupBy(F.size(column).alias("d")).count().where("d > 0").orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return 0, np.zeros((0, 0))
    d = sizes[0]["d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moment = np.zeros((d, d))
        for batch in batches:
            rows = [unit(v) for v in map(valid, batch.column(0).to_pylist()) if v is not None]
            if rows:
                m = np.array(rows)
                moment += m.T @ m
        yield pa.RecordBatch.from_pydict({"at": np.arange(d * d), "s": moment.ravel()})

    moment = np.zeros(d * d)
    sums = map_batches(vectors.where(F.size(column) == d).select(column), run, "at bigint, s double").groupBy("at").agg(F.sum("s"))
    for r in sums.collect():  # d * d numbers
        moment[r[0]] = r[1]
    values, directions = np.linalg.eigh(moment.reshape(d, d))
    return d, directions[:, np.argsort(-values)]


def turn(v: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The unit vector of ``v`` in the basis, if it has the basis' length."""
    return unit(v) @ directions if len(v) == len(directions) else unit(v)


def _number(vectors: DataFrame, column: str) -> str:
    """The number type that holds the components exactly; floats stay short on their way."""
    return "<f4" if vectors.schema[column].dataType.simpleString() == "array<float>" else "<f8"


def placed(vectors: DataFrame, key: str, column: str, label: str, width: float, directions: np.ndarray) -> DataFrame:
    """Key, class, cell and vector of each row; no class where it links with nothing."""
    kind = vectors.schema[key].dataType.simpleString()
    number = _number(vectors, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, cell, space, given = [], [], [], []
            for values, mark in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                v = valid(values) if mark is not None else None
                if v is None:
                    for column_ in (cls, cell, space, given):
                        column_.append(None)
                    continue
                where = f"{mark!r}|{len(v)}".encode("utf-8", "surrogatepass")
                lead = np.floor(turn(v, directions)[:LEAD] / width).astype(np.int64)
                cls.append(xxhash.xxh3_64_intdigest(where + b"|" + v.tobytes()) - (1 << 63))
                space.append(xxhash.xxh3_64_intdigest(where) - (1 << 63))
                cell.append([*lead.tolist(), *[0] * (LEAD - len(lead))])
                top = np.abs(v).max()
                given.append((v if 1e-100 < top < 1e100 else v / top).astype(number).tobytes())  # squares must neither vanish nor overflow
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cls, pa.int64()), pa.array(space, pa.int64()), pa.array(cell, pa.list_(pa.int64())),
                 pa.array(given, pa.binary())], [key, "cls", "space", "cell", "given"])

    return map_batches(vectors.select(key, column, label), run,
                       f"`{key}` {kind}, cls bigint, space bigint, cell array<bigint>, given binary")


def cut(rows: DataFrame, tile: int) -> list[DataFrame]:
    """Cells by the number of coordinates that cut them: ``space``, ``at`` (their coordinates) and ``tiles``.

    Each row of ``rows`` (``space``, ``cell``) is in one cell. A cell of more than ``tile`` rows is cut by the next
    coordinate, so only as many cells are counted as a small multiple of rows / ``tile``.
    """
    levels, crowded = [], None
    for depth in range(LEAD + 1):
        at = F.slice("cell", 1, depth)
        if crowded is not None:
            rows_now = rows.join(crowded.withColumnRenamed("at", "above"), [
                rows["space"] == crowded["space"], F.slice("cell", 1, depth - 1) == F.col("above")], "left_semi")
        else:
            rows_now = rows
        counts = stored(rows_now.groupBy("space", at.alias("at")).agg(F.count("*").alias("n")), "cells")
        full = F.col("n") > (tile if depth < LEAD else 1 << 62)
        levels.append(counts.where(~full).select("space", "at", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
        crowded = counts.where(full).select("space", "at")
        if crowded.isEmpty():
            break
    return levels


def neighbours(levels: list[DataFrame]) -> DataFrame:
    """Pairs of cells that links may cross, each once: ``a`` and ``b`` (their numbers) and their tiles ``na``, ``nb``."""
    named = [c.select("space", "at", "tiles", F.xxhash64("space", "at").alias("id"), F.lit(d).alias("depth")) for d, c in enumerate(levels)]
    pairs = named[0].select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("tiles").alias("na"), F.col("tiles").alias("nb"))
    for d in range(1, min(LOOKUP, len(levels) - 1) + 1):
        deeper = named[d]
        for c in named[d + 1:]:
            deeper = deeper.unionByName(c)
        of = deeper if d == LOOKUP else named[d]
        steps = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in s]) for s in itertools.product((-1, 0, 1), repeat=d)])
        left = of.select("space", F.col("at").alias("x"), F.col("id").alias("a"), F.col("tiles").alias("na"), F.col("depth").alias("da"),
                         F.explode(steps).alias("step")).withColumn("near", F.zip_with(F.slice("x", 1, d), "step", lambda c, s: c + s))
        right = deeper.select("space", F.slice("at", 1, d).alias("near"), F.col("at").alias("y"), F.col("id").alias("b"),
                              F.col("tiles").alias("nb"), F.col("depth").alias("db"))
        # coordinates that both cells have are at most one apart; a missing one gives NULL
        apart = F.exists(F.zip_with("x", "y", lambda c, e: F.coalesce(F.abs(c - e), F.lit(0))), lambda v: v > 1)
        once = F.col("a") <= F.col("b")
        if d < LOOKUP:
            once = once | (F.col("db") > F.col("da"))
        pairs = pairs.unionByName(left.join(right, ["space", "near"]).where(~apart & once).select("a", "b", "na", "nb"))
    return pairs


def close_pairs(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> np.ndarray:
    """Indices (i, j) with cosine of ``x[i]`` and ``y[j]`` at or above the threshold; ``a``, ``b``: their turned units."""
    d = a.shape[1]
    ends = sorted({min(s, d) for s in (*STEPS, d)})
    rest_a, rest_b = (np.sqrt(np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]) for m in (a, b))
    rest_a, rest_b = (np.hstack([m, np.zeros((len(m), 1))]) for m in (rest_a, rest_b))
    low, begin = threshold - 1e-9, 0
    sums, alive = np.zeros((len(a), len(b))), np.ones((len(a), len(b)), bool)
    if same:
        alive = np.triu(alive, 1)
    pairs = None
    for end in ends:
        if pairs is None:
            sums += a[:, begin:end] @ b[:, begin:end].T
            alive &= sums + rest_a[:, end][:, None] * rest_b[:, end][None, :] >= low
            if alive.sum() * 8 < alive.size:
                pairs = np.argwhere(alive)
                part = sums[pairs[:, 0], pairs[:, 1]]
        else:
            i, j = pairs.T
            part = part + np.einsum("ij,ij->i", a[i, begin:end], b[j, begin:end])
            stay = part + rest_a[i, end] * rest_b[j, end] >= low
            pairs, part = pairs[stay], part[stay]
        if pairs is not None and not len(pairs):
            return pairs
        begin = end
    if pairs is None:
        pairs = np.argwhere(alive)
    norm_x, norm_y = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
    found = []
    for k in range(0, len(pairs), 65_536):
        i, j = pairs[k: k + 65_536].T
        cosine = np.einsum("ij,ij->i", x[i], y[j]) / (norm_x[i] * norm_y[j])
        found.append(pairs[k: k + 65_536][cosine >= threshold])
    return np.concatenate(found) if found else pairs


def blocks_of(u: np.ndarray, width: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows in blocks of near ones, with the least and the greatest of their coordinates."""
    lead = np.floor(u[:, :LEAD] / width)
    order = np.lexsort(lead.T[::-1])
    parts = [order[k: k + BLOCK] for k in range(0, len(order), BLOCK)]
    return [(p, u[p].min(axis=0), u[p].max(axis=0)) for p in parts]


def linked_pairs(u: np.ndarray, v: np.ndarray, side: np.ndarray | None, threshold: float) -> np.ndarray:
    """Pairs of linked rows, all or (``side`` given) those across; ``u``: turned units, ``v``: the given vectors."""
    reach = 2 - 2 * threshold + 1e-9
    width = math.sqrt(reach)
    if side is None:
        one = two = blocks_of(u, width)
    else:
        at = [np.flatnonzero(side == s) for s in (0, 1)]
        one, two = ([(a[p], lo, hi) for p, lo, hi in blocks_of(u[a], width)] for a in at)
    found = [np.zeros((0, 2), np.int64)]
    low, high = (np.array([b[k] for b in two]) for k in (1, 2))
    for k, (p, lo, hi) in enumerate(one):
        gap = np.maximum(0, np.maximum(low - hi, lo - high))
        for i in np.flatnonzero((gap * gap).sum(axis=1) <= reach):
            if side is None and i < k:
                continue
            q = two[i][0]
            pairs = close_pairs(u[p], u[q], v[p], v[q], threshold, side is None and i == k)
            if len(pairs):
                found.append(np.stack([p[pairs[:, 0]], q[pairs[:, 1]]], axis=1))
    return np.concatenate(found)


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label",
                    threshold: float = 0.98) -> DataFrame:
    """One row per vector: ``key``, ``class_id``, ``n_links``, ``component_id`` and ``kept``."""
    width = math.sqrt(2 - 2 * threshold) + 1e-9
    d, directions = basis(vectors, column)
    number, tile = _number(vectors, column), min(TILE, max(LEAST_TILE, TILE_NUMBERS // max(d, 1)))
    named = vectors.select(F.col(key).alias("row_key"), F.col(column).alias("vector"), F.col(label).alias("mark"))
    rows = stored(placed(named, "row_key", "vector", "mark", width, directions), "placed")
    held = rows.where("cls IS NOT NULL")
    counts = stored(held.groupBy("cls").agg(F.count("*").alias("copies"), F.min("row_key").alias("rep")), "classes")
    reps = stored(held.select("cls", "space", "cell", "given").dropDuplicates(["cls"]), "reps")
    levels = cut(reps.select("space", "cell"), tile)
    near = stored(neighbours(levels), "cell-pairs")
    homes = None
    for depth, cells in enumerate(levels):
        found = reps.select("cls", "space", F.slice("cell", 1, depth).alias("at")).join(cells, ["space", "at"]).select(
            "cls", F.xxhash64("space", "at").alias("id"), F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int").alias("tile"))
        homes = found if homes is None else homes.unionByName(found)
    homes = stored(homes, "homes")

    def met(mine: str, other: str, side: int) -> DataFrame:
        """The comparisons that a class takes part in as one side: pairs of (cell, tile)."""
        with_pairs = homes.join(near.withColumnRenamed(mine, "id"), "id")
        same = F.col("id") == F.col(other)
        tiles = F.sequence(F.lit(0), F.col("n" + other) - 1)
        tiles = F.filter(tiles, lambda t: ~same | (t >= F.col("tile") if side == 0 else t < F.col("tile")))
        me, you = F.xxhash64("id", "tile"), F.xxhash64(F.col(other), F.col("partner"))
        return with_pairs.withColumn("partner", F.explode(tiles)).select(
            "cls", (me if side == 0 else you).alias("a"), (you if side == 0 else me).alias("b"), F.lit(side).alias("side"))

    tasks = met("a", "b", 0).unionByName(met("b", "a", 1))
    compared = tasks.join(reps.select("cls", "given").join(counts.select("cls", "copies"), "cls"), "cls").select(
        "a", "b", "side", "cls", "copies", "given")

    def compare(group: pa.Table) -> dict[str, list] | None:
        if group.num_rows < 2:
            return None
        cls, copies, side = (group.column(c).to_numpy() for c in ("cls", "copies", "side"))
        same = group.column("a")[0] == group.column("b")[0]
        v = np.array([np.frombuffer(g, number) for g in group.column("given").to_pylist()], np.float64)
        u = v / np.abs(v).max(axis=1, keepdims=True)
        u /= np.sqrt(np.einsum("ij,ij->i", u, u))[:, None]
        if u.shape[1] == len(directions):
            u = u @ directions
        if not same and (side == side[0]).all():
            return None
        pairs = linked_pairs(u, v, None if same else side, threshold)
        if not len(pairs):
            return None
        i, j = pairs.T
        count = np.bincount(i, copies[j], len(cls)) + np.bincount(j, copies[i], len(cls))
        linked = np.flatnonzero(count)
        forest = np.array(spanning_forest(pairs, len(cls)))
        return {"u": [*cls[linked], *cls[forest[:, 0]]], "v": [*[None] * len(linked), *cls[forest[:, 1]]],
                "n": [*count[linked].astype(np.int64), *[None] * len(forest)]}

    found = stored(map_groups(compared, ["a", "b"], compare, "u bigint, v bigint, n bigint"), "links")
    per_class = counts.join(found.where("v IS NULL").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("n")), "cls", "left")
    return named_groups(rows.select("row_key", "cls"), per_class, found.where("v IS NOT NULL").select("u", "v"), "row_key"
                        ).withColumnRenamed("row_key", key)
