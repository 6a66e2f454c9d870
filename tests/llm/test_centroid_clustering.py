import hashlib
import math
import random

import numpy as np

from tickspark.llm.centroid_clustering import bit_planes, cluster, dots, n_planes, norms, unpacked


def words(x):
    x = np.array([x])
    return bit_planes(x, n_planes(x)).tobytes()

NAN, INF = float("nan"), float("inf")


def brute(rows, size, k, rounds, scale=256, seed="2"):
    kept = [(key, [math.floor(scale * c) for c in v]) for key, v in rows
            if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    hashed = sorted((key is None, hashlib.sha256(f"{seed}:{key}".encode()).hexdigest() if key is not None else "", words(x), x) for key, x in kept)
    centroids = [x for *_, x in hashed[:k]]

    def assign():
        out = []
        for key, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((key, x, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        now = assign()
        for c in range(len(centroids)):
            own = [x for _, x, home, _ in now if home == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    now = assign()
    total = sum(d for *_, d in now)
    per = {c: sum(d for *_, home, d in now if home == c) for c in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(key), home, d, per[home], total, sha[home]) for key, _, home, d in now)


def found(df, key="vec_id"):
    return sorted((str(r[key]), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for size in (3, 64, 100):
        x = rng.integers(-700, 700, (40, size))
        x[0], x[1] = -1, 0
        c = rng.integers(-2**26, 2**26 + 1, (7, size))
        px, pc = bit_planes(x, n_planes(x)), bit_planes(c, n_planes(c))
        assert (unpacked(px, size) == x).all() and (unpacked(pc, size) == c).all()
        assert (dots(px, pc) == x @ c.T).all()
        assert (norms(px) == (x * x).sum(axis=1)).all()


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 5, 0.7) for _ in range(64)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # a group of copies
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(cluster(df)) == brute(rows, 64, 40, 5)


def test_other_sizes_and_keys(spark):
    rng = random.Random(4)
    rows = [(f"k{i}", [rng.uniform(-3, 3) for _ in range(70)]) for i in range(80)]
    df = spark.createDataFrame(rows, "name string, v array<double>")
    assert found(cluster(df, "name", "v", size=70, scale=10, k=6, rounds=2, seed="s"), "name") == brute(rows, 70, 6, 2, 10, "s")


def test_odd_rows(spark):
    one = [0.5, -0.25]
    rows = [(1, one), (1, one), (1, [0.25, 3.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [NAN, 1.0]), (7, [INF, 1.0]),
            (None, [2.0, 2.0]), (None, None), (8, one), (9, [1e30, 0.0]), (10, [-2.0, 1e-3])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id bigint, embedding array<double>, Cluster int, planes string")
    usable = [r for r in rows if r[0] != 9]
    for k in (1, 3, 40):
        assert found(cluster(df, size=2, k=k)) == brute(usable, 2, k, 5)
    assert cluster(df, size=2, k=1).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_ties_go_to_the_smaller_centroid(spark):
    rows = [(i, [0.0]) for i in range(20)]
    out = cluster(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), size=1, k=5).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in out} == {(0, 0, 0)} and len(out) == 20


def test_largest_components_and_empty_tables(spark):
    big = 2.0**26
    rows = [(1, [big] * 64), (2, [-big] * 64), (3, [0.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = found(cluster(df, scale=1, k=1, rounds=0))
    assert out == brute(rows, 64, 1, 0, 1)
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert cluster(empty).count() == 0 and cluster(empty).columns == cluster(df).columns
    assert cluster(spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")).count() == 0
