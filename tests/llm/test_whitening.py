import math
import random
from collections import Counter

import numpy as np
import pytest

from tickspark.llm.queries import QUERIES
from tickspark.llm.spread import spread_join
from tickspark.llm.whitening import scaled_deviation, squared_sums, whiten

NAN, INF = float("nan"), float("inf")


def brute(rows, weights="counts", components=32):
    """n, exact deviations, eigenvalues and covariance, over the usable rows."""
    usable = [(k, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for k, v in rows
              if v and all(c is not None and math.isfinite(c) and abs(64 * c) < 2**40 for c in v)]
    usual = Counter(len(x) for _, x in usable)
    d = min(usual, key=lambda s: (-usual[s], s))
    usable = [r for r in usable if len(r[1]) == d]
    fit = [x for _, x in usable] if weights == "counts" else sorted({x for _, x in usable})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - b) / n for a, b in zip(x, s)] for x in fit])
    v = centred.T @ centred / n
    values = np.linalg.eigvalsh(v)[::-1]
    deviation = Counter((k, sum((n * a - b) ** 2 for a, b in zip(x, s))) for k, x in usable)
    return n, s, v, values, deviation, usable


def check(df, rows, weights="counts", components=32):
    n, s, v, values, deviation, usable = brute(rows, weights)
    out = whiten(df, weights=weights, components=components).collect()
    k = min(components, len(v))
    assert len(out) == len(usable) * k and {r.n for r in out} == {n}
    assert Counter((r.vec_id, int(r.deviation)) for r in out if r.component == 1) == deviation
    errors = {r.identity_error for r in out}
    assert len(errors) == 1
    by_row = {}
    for r in out:
        by_row.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r.whitened)
        e = values[r.component - 1]
        if r.whitened is not None:
            assert r.explained == pytest.approx(e / v.trace(), rel=1e-6)
        else:
            assert e < values[0] * 1e-10 and r.explained == 0
    return by_row, errors.pop(), usable, (n, s, v, values)


def random_rows(seed, n, d=6):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.arange(1, d + 1)
    return [(i, [float(c) for c in row]) for i, row in enumerate(rng.normal(size=(n, d)) @ mix)]


@pytest.mark.parametrize("weights", ["counts", "ones"])
def test_equals_brute_force(spark, weights):
    rows = random_rows(1, 120)
    rows += [(1000 + i, rows[3][1]) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    by_row, error, usable, (n, s, v, values) = check(df, rows, weights)
    assert error < 1e-9
    vectors = np.linalg.eigh(v)[1][:, ::-1]
    centred = {k: (np.array([n * a - b for a, b in zip(x, s)], float) / n) for k, x in usable}
    for k in centred:
        want = centred[k] @ vectors / np.sqrt(values)
        (got,) = [parts for (key, _), parts in by_row.items() if key == k]
        assert [abs(got[c + 1][0]) for c in range(len(v))] == pytest.approx(np.abs(want).tolist(), abs=1e-8)
    # All rows share the sign of a component.
    signs = {c: {np.sign(got[c + 1][0] * (centred[k] @ vectors[:, c])) for (k, _), got in by_row.items()} for c in range(len(v))}
    assert all(len(s_ - {0.0}) == 1 for s_ in signs.values())


def test_whitened_vectors_have_unit_covariance(spark):
    rows = random_rows(2, 400, 40)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    out = whiten(df).toPandas().pivot(index="vec_id", columns="component", values="whitened")
    assert out.shape == (400, 32)
    assert np.abs(np.cov(out.to_numpy().T, bias=True) - np.eye(32)).max() < 1e-6


def test_odd_rows(spark):
    rows = [(1, [0.5, 1.0, 2.0]), (1, [0.5, 1.0, 2.0]), (1, [2.5, 0.0, -1.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None, 1.0]),
            (6, [NAN, 1.0, 1.0]), (7, [INF, 1.0, 2.0]), (None, [1.0, -7.0, 2.0]), (None, None), (8, [1e30, 0.0, 0.0]), (9, [1e9, 1.0, 2.0]),
            (10, [3.0, 1e-9, -1e-9])]
    df = spark.createDataFrame([(*r, 1, b"z") for r in rows], "vec_id bigint, embedding array<double>, component int, h binary")
    check(df, rows)
    assert whiten(df).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_components_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    by_row, error, *_ = check(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), rows)
    assert error < 1e-9 and all(parts[2] == [None] and parts[3] == [None] for parts in by_row.values())
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "vec_id bigint, embedding array<double>")
    assert {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in whiten(same).collect()} == {(None, 0.0, None, 0)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert whiten(empty).count() == 0
    assert whiten(spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")).count() == 0
    with pytest.raises(ValueError):
        whiten(empty, weights="none")


def test_exact_beyond_64_bits():
    x = np.array([[2**40, -5], [3, 2**39]])
    for n in (7, 10**9):
        s = [12345678901234567890 if n > 7 else 99, -3]
        far = scaled_deviation(x, n, s)
        want = [[n * int(a) - b for a, b in zip(row, s)] for row in x]
        assert far.tolist() == want and squared_sums(far) == [sum(v * v for v in row) for row in want]


def test_spread_join_deals_a_hot_key(spark):
    rows = spark.range(5000).select(F_key().alias("k"), "id")
    per = rows.groupBy("k").count()
    out = spread_join(rows, per, ["k"], "id")
    assert out.count() == 5000 and out.where("k = 0 AND count <> 4000").count() == 0 and out.columns == ["k", "id", "count"]


def F_key():
    from pyspark.sql import functions as F
    return F.when(F.col("id") < 4000, 0).otherwise(F.col("id"))


def test_query(spark, sf_dir):
    out = QUERIES["op12_whitening"](spark, sf_dir)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    n, _, v, values, deviation, usable = brute(rows)
    got = out.toPandas()
    assert dict(out.dtypes)["deviation"] == "bigint" and len(got) == len(usable) * 32
    assert got.identity_error.max() < 1e-6 and set(got.n) == {n}
    assert Counter(zip(got[got.component == 1].vec_id, got[got.component == 1].deviation)) == deviation
    assert got.groupby("component").explained.first().to_numpy() == pytest.approx(values[:32] / v.trace(), rel=1e-6)
