"""The piecewise helpers against brute force, with pieces far smaller than in production."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickspark.operators import ordered as O


def ticks(spark, n=600, seed=1, gap=40):
    """Irregular ticks: symbol 1 holds most rows, times repeat, some blocks are empty."""
    rnd, rows, t = random.Random(seed), [], 0
    for i in range(n):
        t += rnd.choice([0, 0, 1, 7, gap])
        symbol = 1 if rnd.random() < 0.7 else rnd.randint(2, 4)
        value = rnd.choice([None, float(rnd.randint(1, 50))])
        rows.append((symbol, t, i, float(i % 17), value))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "symbol_id long, s long, id long, x double, v double")
    return df.select("symbol_id", F.timestamp_seconds("s").alias("ts"), "id", "x", "v")


KEY, ORDER = ["symbol_id"], ["ts", "id"]


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def plain():
    return Window.partitionBy("symbol_id").orderBy("ts", "id")


@pytest.mark.parametrize("block", ["1 second", "10 seconds", "1 hour"])
def test_previous_row_equals_plain_lag(spark, block):
    df = ticks(spark)
    got = O.with_previous(df, KEY, ORDER, ["x", "ts"], block)
    want = df.withColumns({"prev_x": F.lag("x").over(plain()), "prev_ts": F.lag("ts").over(plain())})
    cols = ("id", "prev_x", "prev_ts")
    key = lambda r: (r[0],)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(map(tuple, want.select(*cols).collect()), key=key)


@pytest.mark.parametrize("block", ["1 second", "1 minute", "1 day"])
def test_row_index(spark, block):
    df = ticks(spark)
    got = O.with_row_index(df, KEY, ORDER, block)
    want = df.select("id", F.row_number().over(plain()).alias("r"),
                     F.count("*").over(Window.partitionBy("symbol_id")).alias("n"))
    assert rows_of(got, "id", O.INDEX, O.TOTAL) == rows_of(want, "id", "r", "n")


@pytest.mark.parametrize("before,after,rows", [(3, 0, 5), (0, 4, 4), (6, 6, 6), (2, 1, 1000), (9, 0, 1)])
def test_chunked_frames_equal_plain_frames(spark, before, after, rows):
    df = ticks(spark)
    chunks = O.row_chunks(df, KEY, ORDER, before=before, after=after, rows=rows, block="1 minute")
    got = O.own_rows(chunks.withColumns({
        "s": F.sum("x").over(O.chunk_window(KEY, -before, after)),
        "n": F.count("x").over(O.chunk_window(KEY, -before, after))}))
    frame = plain().rowsBetween(-before, after)
    want = df.withColumns({"s": F.sum("x").over(frame), "n": F.count("x").over(frame)})
    assert rows_of(got, "id", "s", "n") == rows_of(want, "id", "s", "n")


@pytest.mark.parametrize("block", ["1 second", "30 seconds", "1 day"])
def test_fill_forward(spark, block):
    df = ticks(spark)
    got = {r.id: r.v for r in O.fill_forward(df, KEY, ORDER, ["v"], block).collect()}
    want = {r.id: r.f for r in df.withColumn("f", F.last("v", True).over(
        plain().rowsBetween(Window.unboundedPreceding, 0))).collect()}
    assert got == want


def test_time_halo_range_sum(spark):
    df = ticks(spark)
    us = F.unix_micros("ts")
    halo = O.time_halo(df, "ts", "15 seconds", "20 seconds")
    got = halo.withColumn("s", F.sum("x").over(Window.partitionBy("symbol_id", O.CHUNK).orderBy(us).rangeBetween(
        -15_000_000, 0))).filter("NOT _halo")
    want = df.withColumn("s", F.sum("x").over(Window.partitionBy("symbol_id").orderBy(us).rangeBetween(-15_000_000, 0)))
    assert rows_of(got, "id", "s") == rows_of(want, "id", "s")


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("width", [1, 3, 10_000])
def test_quantiles(spark, p, width):
    rnd = random.Random(3)
    rows = [(1 if rnd.random() < 0.8 else 2, rnd.choice([-20, -7, 0, 3, rnd.randint(-100, 100)])) for _ in range(301)]
    rows.append((3, 42))
    df = spark.createDataFrame(rows, "symbol_id long, v long")
    cont = {r.symbol_id: r.q for r in O.quantile_cont(df, KEY, "v", p, "q", width).collect()}
    disc = {r.symbol_id: r.q for r in O.quantile_disc(df, KEY, "v", p, "q", width).collect()}
    for k, g in pd.DataFrame(rows, columns=["k", "v"]).groupby("k")["v"]:
        assert cont[k] == pytest.approx(g.quantile(p))
        ordered = sorted(g)
        assert disc[k] == ordered[max(math.ceil(p * len(ordered)) - 1, 0)]


def test_fit_block_follows_the_fullest_block(spark):
    rows = [(1, 60 * i) for i in range(100)] + [(2, 7200 + i % 30) for i in range(90)]
    df = spark.createDataFrame(rows, "symbol_id long, s long").select("symbol_id", F.timestamp_seconds("s").alias("ts"))
    assert O.fit_block(df, KEY, "ts", limit=1000) == "1 day"
    assert O.fit_block(df, KEY, "ts", limit=95) == "1 hour"
    assert O.fit_block(df, KEY, "ts", limit=10) == "1 second"
    assert O.fit_block(df, KEY, "ts", limit=1) == "1 millisecond"


def with_nulls(spark):
    """Ticks some of which have no symbol, no time or neither."""
    df = ticks(spark, 300, seed=7)
    return df.withColumns({
        "symbol_id": F.when(F.col("id") % 4 > 0, F.col("symbol_id")),
        "ts": F.when(F.col("id") % 7 > 0, F.col("ts"))})


def none_first(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("block", ["10 seconds", "1 hour"])
def test_null_keys_and_times_stay(spark, block):
    df = with_nulls(spark)
    got = O.with_previous(df, KEY, ORDER, ["x", "v"], block).select("id", "prev_x", "prev_v")
    want = df.select("id", F.lag("x").over(plain()), F.lag("v").over(plain()))
    assert none_first(got.collect()) == none_first(want.collect())
    got = O.with_row_index(df, KEY, ORDER, block, {"_odd": F.col("v") > 25}).select("id", O.INDEX, O.TOTAL, "_odd")
    want = df.select("id", F.row_number().over(plain()), F.count("*").over(Window.partitionBy("symbol_id")),
                     F.coalesce(F.sum(F.when(F.col("v") > 25, 1)).over(plain().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    assert none_first(got.collect()) == none_first(want.collect())
    chunks = O.row_chunks(df, KEY, ORDER, before=3, rows=8, block=block)
    got = O.own_rows(chunks.withColumn("m", F.max("x").over(O.chunk_window(KEY, -3, 0)))).select("id", "m")
    assert none_first(got.collect()) == none_first(df.select("id", F.max("x").over(plain().rowsBetween(-3, 0))).collect())
    got = O.fill_forward(df, KEY, ORDER, ["v"], block).select("id", "v")
    want = df.select("id", F.last("v", ignorenulls=True).over(plain().rowsBetween(Window.unboundedPreceding, 0)))
    assert none_first(got.collect()) == none_first(want.collect())


def test_ranks_of_null_keys(spark):
    df = with_nulls(spark).withColumn("y", F.col("v").cast("long"))
    got = O.quantile_disc(df, KEY, "y", 0.5, "q", 8)
    want = df.groupBy("symbol_id").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY y)").cast("long"))
    assert none_first(got.collect()) == none_first(want.collect())
    alone = df.withColumn("y", F.when(F.col("symbol_id") != 2, F.col("y")))
    ranks = O.value_ranks(alone, KEY, "y", 8, with_null=True)
    assert {r[0] for r in ranks.select("symbol_id").distinct().collect()} == {None, 1, 2, 3, 4}
    assert ranks.filter("y IS NULL AND lo IS NOT NULL").count() == 0


def test_chunks_by_counted_rows(spark):
    """Frames over the counted rows alone, the others kept aside."""
    df = ticks(spark)
    held = F.col("v") > 20
    indexed = O.with_row_index(df, KEY, ORDER, "1 minute", {"_held": held})
    chunks = O.chunks_by(indexed, "_held", before=2, rows=5, where=held)
    got = O.own_rows(chunks.withColumn("m", F.when(held, F.sum("x").over(O.chunk_window(KEY, -2, 0))))).select("id", "m")
    want = df.filter(held).select("id", F.sum("x").over(plain().rowsBetween(-2, 0)).alias("m")).unionByName(
        df.filter(F.coalesce(~held, F.lit(True))).select("id", F.lit(None).cast("double").alias("m")))
    assert none_first(got.collect()) == none_first(want.collect())
    assert chunks.groupBy("symbol_id", O.CHUNK).count().agg(F.max("count")).first()[0] <= 7
