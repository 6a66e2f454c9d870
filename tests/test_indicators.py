"""Indicators and rolling features against pandas, with chunks small enough to split every symbol."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickspark.operators import indicators as I
from tickspark.operators import micro as M
from tickspark.operators import ordered as O
from tickspark.plans import datasets as L


@pytest.fixture(scope="module")
def hourly(spark):
    rng = np.random.default_rng(5)
    rows = []
    for symbol, n in ((1, 2600), (2, 30), (3, 8)):
        hours = np.sort(rng.choice(np.arange(3 * n), n, replace=False))
        close = 100 + np.cumsum(rng.normal(size=n)).round(2)
        rows += [(symbol, int(h), float(c)) for h, c in zip(hours, close)]
    pdf = pd.DataFrame(rows, columns=["symbol_id", "h", "h_close"])
    df = spark.createDataFrame(pdf).select(
        F.col("symbol_id").cast("long"), F.timestamp_seconds(F.col("h") * 3600).alias("hour_bucket"), "h_close")
    return df, pdf


def check(got, pdf, column, expected, tol=1e-7):
    spark_values = got.select("symbol_id", F.unix_seconds("hour_bucket").alias("s"), column).toPandas()
    merged = pdf.assign(want=expected, s=pdf.h * 3600).merge(spark_values, on=["symbol_id", "s"])
    assert len(merged) == len(pdf)
    assert (merged.want.isna() == merged[column].isna()).all()
    np.testing.assert_allclose(merged[column].dropna(), merged.want.dropna(), atol=tol, rtol=0)


def by_symbol(pdf, fn):
    return pdf.groupby("symbol_id")["h_close"].transform(fn)


@pytest.mark.parametrize("rows", [7, 50_000])
def test_sma_rsi_bollinger(hourly, monkeypatch, rows):
    monkeypatch.setattr(O, "CHUNK_ROWS", rows)
    df, pdf = hourly
    check(I.sma(df, 20), pdf, "sma_20", by_symbol(pdf, lambda c: c.rolling(20).mean()))

    def rsi(c):
        d = c.diff()
        gain, loss = d.where(d > 0, 0).rolling(14).mean(), (-d.where(d < 0, 0)).rolling(14).mean()
        return 100 - 100 / (1 + gain / loss)

    check(I.rsi(df), pdf, "rsi", by_symbol(pdf, rsi))
    mean, sd = by_symbol(pdf, lambda c: c.rolling(20).mean()), by_symbol(pdf, lambda c: c.rolling(20).std())
    bands = I.bollinger(df)
    check(bands, pdf, "bb_upper", mean + 2 * sd)
    check(bands, pdf, "bb_position", (pdf.h_close - (mean - 2 * sd)) / (4 * sd))


def test_ema_and_macd_across_chunks(hourly):
    df, pdf = hourly
    for span in (9, 12, 26):
        check(I.ema(df, span), pdf, f"ema_{span}", by_symbol(pdf, lambda c: c.ewm(span=span).mean()))
    macd = by_symbol(pdf, lambda c: c.ewm(span=12).mean() - c.ewm(span=26).mean())
    signal = macd.groupby(pdf.symbol_id).transform(lambda c: c.ewm(span=9).mean())
    both = I.technical_indicators(df)
    check(both, pdf, "macd", macd)
    check(both, pdf, "macd_signal", signal)
    check(I.macd(df), pdf, "macd_signal", signal)
    check(both, pdf, "sma_5", by_symbol(pdf, lambda c: c.rolling(5).mean()))


def test_rsi_edges(spark):
    rows = [(1, i, 10.0 + i) for i in range(20)] + [(2, i, 5.0) for i in range(20)]
    df = spark.createDataFrame(rows, "symbol_id long, h long, h_close double").select(
        "symbol_id", F.timestamp_seconds(F.col("h") * 3600).alias("hour_bucket"), "h_close")
    got = I.rsi(df).collect()
    assert all(r.rsi == 100.0 for r in got if r.symbol_id == 1 and r.hour_bucket.day > 0 and r.rsi is not None)
    assert sum(r.rsi is not None for r in got if r.symbol_id == 1) == 7
    assert all(r.rsi is None for r in got if r.symbol_id == 2)


def bars(df):
    return df.select("symbol_id", F.col("hour_bucket").alias("ts_second"), F.col("h_close").alias("mid_close"))


@pytest.mark.parametrize("rows", [11, 50_000])
def test_rolling_forward_sequences(hourly, monkeypatch, rows):
    monkeypatch.setattr(O, "CHUNK_ROWS", rows)
    df, pdf = hourly
    rolled = I.rolling_sma_vol(bars(df), 30).withColumnRenamed("ts_second", "hour_bucket")
    check(rolled, pdf, "sma_5min", by_symbol(pdf, lambda c: c.rolling(31, min_periods=1).mean()))
    check(rolled, pdf, "volatility_5min", by_symbol(pdf, lambda c: c.rolling(31, min_periods=2).std()))

    ahead = I.forward_return(bars(df), 5).withColumnRenamed("ts_second", "hour_bucket")
    want = by_symbol(pdf, lambda c: (c.shift(-5) - c) / c)
    got = ahead.select("symbol_id", F.unix_seconds("hour_bucket").alias("s"), "ret_5s").toPandas()
    assert len(got) == want.notna().sum()
    merged = pdf.assign(want=want, s=pdf.h * 3600).merge(got, on=["symbol_id", "s"])
    np.testing.assert_allclose(merged.ret_5s, merged.want, atol=1e-12)

    built = L.sequences(bars(df), ["mid_close"], length=12, step=4, h=5).collect()
    expected = {}
    for symbol, g in pdf.sort_values("h").groupby("symbol_id"):
        c, h = g.h_close.to_numpy(), g.h.to_numpy()
        for i in range(0, len(c) - 12 - 5, 4):
            expected[symbol, h[i] * 3600] = (c[i:i + 12].tolist(), (c[i + 16] - c[i + 11]) / c[i + 11])
    assert len(built) == len(expected)
    for r in built:
        x, y = expected[r.symbol_id, int((r.ts_second - pd.Timestamp("1970-01-01")).total_seconds())]
        assert [v[0] for v in r.X] == x and r.y == pytest.approx(y)


@pytest.mark.parametrize("rows", [12, 50_000])
def test_market_features_walk(spark, monkeypatch, rows):
    """The windowed features equal a plain walk over the bars that keeps buffers per symbol."""
    monkeypatch.setattr(O, "CHUNK_ROWS", rows)
    rng = np.random.default_rng(9)
    data = []
    for symbol, n in ((1, 150), (2, 5)):
        for i in range(n):
            bid = float(rng.integers(0, 6))
            traded = rng.random() < 0.6
            data.append((symbol, i * 7, bid, bid + float(rng.integers(0, 3)), float(rng.integers(0, 4)),
                         float(rng.integers(0, 4)), float(rng.integers(0, 3)) if traded else None,
                         0.25 if traded else None))
    df = spark.createDataFrame(data, "symbol_id long, s long, bid_close double, ask_close double, bid_qty_close double, "
                                     "ask_qty_close double, volume double, buy_ratio double").select(
        "*", F.timestamp_seconds("s").alias("ts_bucket"), F.when(F.col("volume").isNotNull(), 0.0).alias("buy_volume"),
        F.when(F.col("volume").isNotNull(), 0.0).alias("sell_volume"))
    got = {(r.symbol_id, r.s): r for r in M.market_features(df).withColumn("s", F.unix_seconds("ts_exchange")).collect()}

    prev, prices, volumes = {}, {}, {}
    for symbol, s, b, a, bq, aq, volume, share in data:
        r, mid = got[symbol, s], (a + b) / 2
        p = prev.get(symbol)
        ofi, ret = 0.0, None
        if p:
            pb, pa, pbq, paq = p
            ofi = (bq - pbq) if b == pb else (bq if b > pb else -pbq)
            ofi += (aq - paq) if a == pa else (-aq if a < pa else paq)
            pm = (pb + pa) / 2
            ret = np.log(mid / pm) if pm > 0 and mid > 0 else None
        assert r.ofi == pytest.approx(ofi)
        assert (r.return_1s is None) == (ret is None) and (ret is None or r.return_1s == pytest.approx(ret))
        vpin = None
        if volume is not None and volume > 0:
            buf = volumes.setdefault(symbol, [])
            buf.append(volume)
            del buf[:-10]
            vpin = 0.0 if len(buf) < 2 else abs(volume * share - volume * (1 - share)) / np.mean(buf)
            assert r.buy_volume_ratio == pytest.approx(share)
        else:
            assert r.buy_volume_ratio == 0.5 and r.volume_imbalance == 0
        assert r.vpin == (vpin if vpin is None else pytest.approx(vpin))
        buf = prices.setdefault(symbol, [])
        buf.append(mid)
        del buf[:-10]
        steps = [0.0 if x <= 0 else (np.log(y / x) if y > 0 else None) for x, y in zip(buf, buf[1:])]
        steps = [x for x in steps if x is not None]
        assert r.price_volatility == pytest.approx(float(np.std(steps)) if steps else 0.0, abs=1e-9)
        prev[symbol] = (b, a, bq, aq)
    assert len(got) == len(data)


def test_exponential_means_of_any_span_and_nulls(spark):
    rng = random.Random(11)
    close = [None if rng.random() < 0.1 else 100 + rng.gauss(0, 5) for _ in range(3200)]
    rows = [(1, i * 3600, c) for i, c in enumerate(close)]
    bars = spark.createDataFrame(rows, "symbol_id bigint, s bigint, h_close double").withColumn(
        "hour_bucket", F.timestamp_seconds("s")).drop("s")
    series = pd.Series([math.nan if c is None else c for c in close])
    for span in (1, 2, 3, 12, 60, 200):
        got = [r[0] for r in I.ema(bars, span, name="e").orderBy("hour_bucket").select("e").collect()]
        for a, b in zip(got, series.ewm(span=span, adjust=True).mean()):
            assert (a is None and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9), span
    plain = pd.Series([100 + rng.gauss(0, 5) for _ in range(3000)])
    bars = spark.createDataFrame([(1, i * 3600, c) for i, c in enumerate(plain)], "symbol_id bigint, s bigint, h_close double").withColumn(
        "hour_bucket", F.timestamp_seconds("s")).drop("s")
    for fast, slow, signal in ((24, 52, 18), (2, 200, 3)):
        macd = plain.ewm(span=fast).mean() - plain.ewm(span=slow).mean()
        want = macd.ewm(span=signal).mean()
        got = [r[0] for r in I.macd(bars, fast, slow, signal).orderBy("hour_bucket").select("macd_signal").collect()]
        assert all(math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-9) for a, b in zip(got, want))
