"""N-gram Jaccard self-join by MinHash banding.

Every text becomes its set of hashed word n-grams. Texts with equal sets are one class. Of each class
a signature is cut into bands; the number of bands and rows is the cheapest that finds a pair at the
threshold with the target recall. Band hashes are shuffled, and classes that meet in a bucket are
candidates. Candidates are verified on their full sets.

A bucket never emits its pairs. Its members hang on the first of them, which joins candidates into clusters; a
cluster is cut into tiles, and each pair of tiles is one task that compares the members that share a
band and returns, per class, its number of links, and a spanning forest of the links. So a group of many
near copies returns few rows and fills no task's memory; it costs its comparisons, and its sets are
shuffled once for each tile of their cluster.

Defined cases: a text of fewer than ``n`` words has one n-gram of all its words. A null text, or one
without words, links with nothing and is a class of its own row. Words are compared as they are. Repeated rows
are documents of their own, with links to each other. Null keys are allowed; a component is named by its
smallest key that is not null. Empty tables give empty tables. Other columns are ignored. Classes are told apart
by 64-bit hashes of their sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import map_batches, map_groups, stored, words
from tickspark.llm.components import components, named_groups, spanning_forest

TILE_DOCS = 256
TILE_GRAMS = 500_000
MAX_HASHES = 256


def choose_bands(threshold: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows) with the most rows, so the fewest false candidates, that reach ``recall`` at ``threshold``."""
    best = None
    for rows in range(1, most + 1):
        hit = threshold ** rows
        if not hit:
            break
        bands = 1 if hit >= recall else math.ceil(math.log1p(-recall) / math.log1p(-hit))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"no banding of {most} hashes finds similarity {threshold} with probability {recall}")
    return best


class Shingler:
    """Sets of hashed word n-grams."""

    def __init__(self, n: int):
        self.n, self.known = n, {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = words(text)
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.known) > 200_000:
            self.known.clear()
        known, h = self.known, np.empty(len(found), np.uint64)
        for i, w in enumerate(found):
            v = known.get(w)
            if v is None:
                v = known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            h[i] = v
        n = min(self.n, len(h))
        count = len(h) - n + 1
        grams = np.full(count, n, np.uint64)
        for k in range(n):
            grams = (grams ^ h[k: k + count]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(32)
        return np.unique(grams)


class Signer:
    """Band hashes of MinHash signatures."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = (rng.integers(0, 2**32, bands * rows, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 2**32, bands * rows, dtype=np.uint64).astype(np.uint32)[:, None]
        self.mix = (rng.integers(0, 2**63, rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        x = (grams >> np.uint64(32)).astype(np.uint32) ^ grams.astype(np.uint32)
        least = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 4096):
            least = np.minimum(least, ((x[None, i: i + 4096] ^ self.b) * self.a).min(axis=1))
        h = least.reshape(self.bands, self.rows).astype(np.uint64) * self.mix
        h = np.bitwise_xor.reduce(h ^ (h >> np.uint64(31)), axis=1) * np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(29))).view(np.int64)


def _class_of(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def signatures(docs: DataFrame, key: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """``key``, ``cls`` (null without words), ``grams`` (set size), ``bands`` and ``h`` (hash of the text) of every document."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign = Shingler(n), Signer(bands, rows)
        for batch in batches:
            cls, size, keys = [], [], []
            for t in batch.column(1).to_pylist():
                grams = shingle(t)
                size.append(len(grams))
                cls.append(_class_of(grams) if len(grams) else None)
                keys.append(sign(grams) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cls, pa.int64()), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64())), batch.column(2)],
                [key, "cls", "grams", "bands", "h"])

    return map_batches(docs.select(key, text, F.xxhash64(text)), run, f"`{key}` {kind}, cls bigint, grams bigint, bands array<bigint>, h bigint")


def stars(classes: DataFrame) -> DataFrame:
    """``u``, ``v``: every member of a bucket with the first one. ``classes`` has ``cls`` and ``bands``.

    The first ones are a minimum that combines before the shuffle, and only buckets of several members are joined
    back, so a bucket that holds many classes is no task of its own.
    """
    rows = classes.select("cls", F.posexplode("bands").alias("band", "hash"))
    heads = stored(rows.groupBy("band", "hash").agg(F.min("cls").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n"), "heads")
    return rows.join(heads, ["band", "hash"]).where("cls <> v").select(F.col("cls").alias("u"), "v").distinct()


def similar(sets: list[np.ndarray], pairs: np.ndarray, threshold: float) -> np.ndarray:
    """Which of ``pairs`` of sets reach the Jaccard similarity, decided on the full sets."""
    size = np.array([len(s) for s in sets], np.int64)
    a, b = pairs[:, 0], pairs[:, 1]
    possible = np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]) - 1e-9
    common = np.zeros(len(pairs), np.int64)
    order = np.flatnonzero(possible)
    order = order[np.argsort(a[order], kind="stable")]
    if len(order) > 4 * len(sets):
        # many pairs: count over a table of which set has which n-gram, some columns at a time
        vocab, where = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), size)
        total = np.zeros((len(sets), len(sets)), np.float32)
        by = np.argsort(where, kind="stable")
        where, owner = where[by], owner[by]
        step = max(1, (1 << 22) // max(1, len(sets)))
        for c in range(0, len(vocab), step):
            lo, hi = np.searchsorted(where, [c, c + step])
            has = np.zeros((len(sets), min(step, len(vocab) - c)), np.float32)
            has[owner[lo:hi], where[lo:hi] - c] = 1
            total += has @ has.T
        common[order] = np.rint(total[a[order], b[order]]).astype(np.int64)
    else:
        for i in order:
            x, y = sets[a[i]], sets[b[i]]
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            common[i] = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return possible & (common >= threshold * (size[a] + size[b] - common) - 1e-9)


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
          recall: float = 0.9999) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their class, links per class, a spanning forest of the links between classes)."""
    bands, rows = choose_bands(threshold, recall)
    signed = stored(signatures(docs, key, text, n, bands, rows), "signatures")
    classes = stored(signed.where("cls IS NOT NULL").groupBy("cls").agg(
        F.count("*").alias("copies"), F.min(key).alias("rep"), F.max("grams").alias("grams"), F.first("bands").alias("bands"),
        F.min("h").alias("h"), F.min_by(key, "h").alias("of")), "classes")
    clusters = stored(components(stars(classes)), "clusters")
    members = classes.join(clusters, F.col("cls") == F.col("node")).select(
        "cls", "copies", "h", "of", "bands", "component", "grams")
    sizes = clusters.join(classes, F.col("cls") == F.col("node")).groupBy("component").agg(
        F.count("*").alias("members"), F.sum("grams").alias("total"))
    tiles = stored(sizes.select("component", F.greatest(
        F.ceil(F.col("members") / TILE_DOCS), F.ceil(F.col("total") / TILE_GRAMS)).cast("int").alias("tiles")), "tiles")
    members = stored(members.join(tiles, "component").withColumn(
        "tile", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")), "members")
    shingles = stored(_sets_of(docs, members, key, text, n), "sets")
    a, b = F.least("tile", "other"), F.greatest("tile", "other")
    placed = shingles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "component", a.cast("int").alias("ta"), b.cast("int").alias("tb"), "tile", "cls", "copies", "bands", "grams")

    def compare(group: pa.Table) -> dict[str, list] | None:
        cls = group.column("cls").to_numpy()
        if len(cls) < 2:
            return None
        tile, copies = group.column("tile").to_numpy(), group.column("copies").to_numpy()
        ta, tb = group.column("ta")[0].as_py(), group.column("tb")[0].as_py()
        keys = np.array(group.column("bands").to_pylist(), np.int64)
        sets = [np.frombuffer(g, np.uint64) for g in group.column("grams").to_pylist()]
        share = np.zeros((len(cls), len(cls)), bool)
        for k in range(keys.shape[1]):
            share |= keys[:, k][:, None] == keys[:, k][None, :]
        share &= np.triu(np.ones_like(share), 1)
        if ta != tb:
            share &= tile[:, None] != tile[None, :]
        pairs = np.argwhere(share)
        pairs = pairs[similar(sets, pairs, threshold)] if len(pairs) else pairs
        if not len(pairs):
            return None
        count = np.bincount(pairs[:, 0], copies[pairs[:, 1]], len(cls)) + np.bincount(pairs[:, 1], copies[pairs[:, 0]], len(cls))
        linked = np.flatnonzero(count)
        forest = np.array(spanning_forest(pairs, len(cls)))
        return {"u": [*cls[linked], *cls[forest[:, 0]]], "v": [*[None] * len(linked), *cls[forest[:, 1]]],
                "n": [*count[linked].astype(np.int64), *[None] * len(forest)]}

    found = stored(map_groups(placed, ["component", "ta", "tb"], compare, "u bigint, v bigint, n bigint"), "links")
    per_class = classes.select("cls", "copies", "rep").join(
        found.where("v IS NULL").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("n")), "cls", "left")
    return signed.select(key, "cls"), per_class, found.where("v IS NOT NULL").select("u", "v")


def _sets_of(docs: DataFrame, members: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """``members`` with the n-gram set of one document of each class."""
    # A text of the class with one of its keys: a key that many rows share meets its own texts only.
    wanted = members.select("h", F.col("of").alias("_of"), "cls", "copies", "bands", "component", "tiles", "tile")
    joined = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_h")).join(
        wanted, (F.col("_h") == F.col("h")) & F.col("_key").eqNullSafe(F.col("_of"))).select(
        "cls", "copies", "bands", "component", "tiles", "tile", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in batches:
            sets = [shingle(t) for t in batch.column(6).to_pylist()]
            # texts of equal hashes are told apart
            same = [len(s) > 0 and _class_of(s) == c for s, c in zip(sets, batch.column(0).to_pylist())]
            at = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(at)) for c in batch.columns[:-1]], pa.array([sets[i].tobytes() for i in at], pa.binary())],
                [*batch.schema.names[:-1], "grams"])

    return map_batches(joined, run, "cls bigint, copies bigint, bands array<bigint>, component bigint, tiles int, tile int, grams binary"
                       ).dropDuplicates(["cls"])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
                    recall: float = 0.9999) -> DataFrame:
    """One row per document: ``key``, ``class_id`` (smallest key with the same set), ``n_links`` (other documents
    at or above the threshold), ``component_id`` (smallest key reachable by links) and ``kept``.

    ``kept`` is true for the row of each component whose key is its smallest; a repeated key is kept in each of
    its rows.
    """
    signed, per_class, forest = links(docs, key, text, n, threshold, recall)
    return named_groups(signed, per_class, forest, key)
