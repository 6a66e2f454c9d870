"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest connected node, for every node of an edge (``u``, ``v``).

    Each round hangs the neighbours of a node on the smallest of them, first the larger, then the smaller ones;
    when nothing changes, every component is a star around its smallest node. The smallest neighbours are
    written before they are joined, so that Spark can split the partition of a node with very many edges.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        now = stored(small.distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Count and two sums of hashes: equal for equal sets of edges."""
    mix = lambda seed: F.sum(F.xxhash64("u", "v", F.lit(seed)).cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mix(1), mix(2)).first())


def spanning_forest(links: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of ``links`` (pairs of indices)."""
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def named_groups(rows: DataFrame, per_class: DataFrame, forest: DataFrame, key: str) -> DataFrame:
    """One row for each of ``rows``: ``key``, ``class_id``, ``n_links``, ``component_id`` and ``kept``.

    ``rows`` has ``key`` and ``cls``, null where a row links with nothing; ``per_class`` has ``cls``, its ``copies``,
    its smallest key ``rep`` and ``n``, the rows of other classes it links to; ``forest`` connects classes.
    """
    groups = components(forest)
    named = stored(per_class.join(groups, F.col("cls") == F.col("node"), "left").select(
        "cls", "copies", "rep", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "cls").alias("component")), "named")
    smallest = named.groupBy("component").agg(F.min("rep").alias("smallest"))
    full = stored(named.join(smallest, "component").select(
        F.col("cls").alias("_cls"), "rep", (F.col("copies") - 1 + F.col("n")).alias("n"), "smallest"), "classes-named")
    with_class = rows.where("cls IS NOT NULL").join(full, F.col("cls") == F.col("_cls")).select(
        key, F.col("rep").alias("class_id"), F.col("n").alias("n_links"), F.col("smallest").alias("component_id"),
        F.col(key).eqNullSafe(F.col("smallest")).alias("kept"))
    alone = rows.where("cls IS NULL").select(
        key, F.col(key).alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.col(key).alias("component_id"),
        F.lit(True).alias("kept"))
    return with_class.unionByName(alone)
