import math
import random

import numpy as np
from pyspark.sql import functions as F

from tickspark.llm import topk_search as T


def brute(rows, k):
    whole = [(key, [math.floor(1024 * x) for x in v]) for key, v in rows
             if key is not None and v and None not in v and all(map(math.isfinite, v))]
    pairs = {}
    for q, v in whole:
        if q % 10 == 0:
            pairs.setdefault(q, []).extend(
                (-sum(a * b for a, b in zip(v, w)), key) for key, w in whole if key != q and len(w) == len(v))
    return {q: [(key, -s) for s, key in sorted(found)[:k]] for q, found in pairs.items()}


def search(spark, rows, k=3):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {}
    for r in T.top_k(df, F.col("id") % 10 == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    centers = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centers)]) for i in range(400)]
    rows += [(400 + i, rows[i % 7][1]) for i in range(30)]  # ties
    monkeypatch.setattr(T, "PART", 64)
    monkeypatch.setattr(T, "QUERY_GROUP", 8)
    want = {q: v for q, v in brute(rows, 3).items() if v}
    assert search(spark, [(*r, 1) for r in rows]) == want


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (10, [0.5, -0.5]), (20, [1.0]), (1, [2.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
            (5, []), (None, [1.0, 1.0]), (6, [1e300, 1e300]), (1, [2.0, 1.0])]
    got = search(spark, [(*r, 1) for r in rows])
    assert got[0][0] == (6, T.TOP) and (1, 4 * 1024 * 1024) in got[0] and 20 not in got
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<double>, label int")
    assert T.top_k(empty, F.col("id") % 10 == 0).count() == 0


def test_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(T, "PART", 16)
    monkeypatch.setattr(T, "QUERY_GROUP", 4)
    assert search(spark, [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (1, [3.0, 0.0], 1)])[0] == [(1, 3 << 20), (1, 2 << 20)]
    rng = random.Random(8)
    rows = [(rng.randrange(60), [float(rng.randrange(-3, 4)) for _ in range(3)]) for _ in range(300)]
    rows += [(20, [rng.gauss(0, 1) for _ in range(3)]) for _ in range(150)]  # a third of all rows
    rows += rows[:40] + [(7, [4.0, 4.0, 4.0])] * 5
    want = {q: v for q, v in brute(rows, 3).items() if v}
    assert search(spark, [(*r, 1) for r in rows]) == want


def test_other_columns(spark):
    df = spark.createDataFrame([(0, [1.0], 5, b"", 1, 1), (1, [2.0], 6, b"", 2, 2)],
                               "vec_id bigint, embedding array<float>, id bigint, vec binary, part int, query int")
    assert [tuple(r) for r in T.top_k(df, F.col("id") % 10 == 0).collect()] == [(0, 1, 1, 2 << 20)]


def nodes(node):
    yield node
    for c in node.children:
        yield from nodes(c)


def test_trees_reach_their_leaves():
    rng = np.random.default_rng(3)
    for x in (rng.normal(size=(2000, 64)), rng.normal(size=(3, 8))[rng.integers(0, 3, 500)], np.cumprod(np.full((900, 2), 1.1), axis=0)):
        root = T.Node(x, np.arange(len(x)), 0)
        leaves = [n for n in nodes(root) if not n.children]
        assert sorted(np.concatenate([n.rows for n in leaves])) == list(range(len(x)))
        assert all(len(n.rows) <= T.LEAF or not n.radius for n in leaves)
        for n in nodes(root):
            assert np.linalg.norm(x[n.rows] - n.point, axis=1).max() <= n.radius
            assert all(c.radius <= 2 * n.radius for c in n.children)


def test_share_of_pairs_ruled_out():
    """Clustered vectors: most pairs are ruled out by nodes. Vectors without clusters: few, and results are the same."""
    rng = np.random.default_rng(4)
    shares = []
    for x in (rng.normal(size=(40, 32))[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 32)) * 0.05, rng.normal(size=(2000, 32))):
        x = np.floor(x * 1024)
        ids, q = np.arange(len(x)), np.arange(0, len(x), 20)
        s = T.products(x[q], x)
        s[np.arange(len(q)), q] = -T.TOP - 1
        least = np.sort(s[:, :1000], axis=1)[:, -10]  # what a part of the rows gives
        found, compared = T.dual_search(x[q], q, x, ids, 10, least)
        for i in range(len(q)):
            want = sorted((-int(v), int(j)) for j, v in enumerate(s[i]))[:10]
            assert sorted((-v, j) for a, j, v in found if a == i) == want
        shares.append(1 - compared / s.size)
    print("share of pairs ruled out:", shares)
    assert shares[0] > 0.8
