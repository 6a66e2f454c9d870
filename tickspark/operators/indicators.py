"""Lags, rolling statistics and technical indicators over bars."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators.ordered import (
    CHUNK, HALO, INDEX, chunk_window, own_rows, row_chunks, time_halo, with_previous)

KEY = ["symbol_id"]
HOUR_BLOCK = "28 days"


def lag_features(bars: DataFrame, ts: str = "ts_second") -> DataFrame:
    """Previous mid close and previous trade imbalance per symbol."""
    lagged = with_previous(bars, KEY, [ts], ["mid_close", "imbalance_ratio"], "1 day")
    return lagged.withColumnsRenamed({"prev_mid_close": "prev_mid", "prev_imbalance_ratio": "prev_imbalance"})


def hour_lags(hourly: DataFrame) -> DataFrame:
    """Close and volume of the previous hour bar, as ``prev_h_close`` and ``prev_h_volume``."""
    return with_previous(hourly, KEY, ["hour_bucket"], ["h_close", "h_volume"], HOUR_BLOCK)


def rolling_sma_vol(bars: DataFrame, preceding: int = 300, ts: str = "ts_second") -> DataFrame:
    """Mean and sample deviation of the mid close over the last rows, current one included."""
    frame = chunk_window(KEY, -preceding, 0)
    return own_rows(
        row_chunks(bars, KEY, [ts], before=preceding)
        .withColumns({"sma_5min": F.avg("mid_close").over(frame),
                      "volatility_5min": F.stddev_samp("mid_close").over(frame)}))


def rolling_sma_vol_range(bars: DataFrame, reach: str = "5 minutes", ts: str = "ts_second", block: str = "1 day") -> DataFrame:
    """Mean and sample deviation of the mid close over the trailing time ``reach``, both ends included.

    Unlike :func:`rolling_sma_vol` it does not stretch over seconds without bars.
    """
    frame = Window.partitionBy(*KEY, CHUNK).orderBy(F.unix_micros(ts)).rangeBetween(-X.width_us(reach), 0)
    return (
        time_halo(bars, ts, reach, block)
        .withColumns({"sma_5min": F.avg("mid_close").over(frame), "volatility_5min": F.stddev_samp("mid_close").over(frame)})
        .filter(~F.col(HALO)).drop(CHUNK, HALO))


def forward_return(bars: DataFrame, h: int = 5, ts: str = "ts_second") -> DataFrame:
    """Return to the mid close h bars ahead; rows without such a bar are dropped."""
    ahead = f"mid_t_plus_{h}"
    out = own_rows(
        row_chunks(bars, KEY, [ts], after=h)
        .withColumn(ahead, F.lead("mid_close", h).over(chunk_window(KEY))))
    return out.filter(F.col(ahead).isNotNull()).withColumn(
        f"ret_{h}s", X.ratio(F.col(ahead) - F.col("mid_close"), F.col("mid_close")))


def _full(agg, column: str | Column, n: int) -> Column:
    """An aggregate over the last n rows, NULL until n rows are there."""
    frame = chunk_window(KEY, -(n - 1), 0)
    return F.when(F.col(INDEX) >= n, agg(column).over(frame))


def _sma(close: str, n: int) -> Column:
    return _full(F.avg, close, n)


def sma(bars: DataFrame, n: int | list[int], close: str = "h_close", ts: str = "hour_bucket") -> DataFrame:
    """Plain rolling means over one or more spans, in one chunking."""
    spans = [n] if isinstance(n, int) else n
    chunks = row_chunks(bars, KEY, [ts], before=max(spans) - 1, block=HOUR_BLOCK)
    return own_rows(chunks.withColumns({f"sma_{s}": _sma(close, s) for s in spans}))


def _with_rsi(chunks: DataFrame, close: str, n: int) -> DataFrame:
    """Relative strength from plain rolling means of gains and losses.

    The first row of a key counts as neither gain nor loss. Only losses of 0 give 100; without any
    move there is no value.
    """
    delta = F.col(close) - F.lag(close).over(chunk_window(KEY))
    moved = chunks.withColumn("_delta", F.coalesce(delta, F.lit(0.0)))
    rated = moved.withColumns({
        "_gain": _full(F.avg, F.greatest(F.col("_delta"), F.lit(0.0)), n),
        "_loss": _full(F.avg, F.greatest(-F.col("_delta"), F.lit(0.0)), n)})
    strength = F.col("_gain") / F.col("_loss")
    value = F.when(F.col("_loss") > 0, 100.0 - 100.0 / (1.0 + strength)).when(F.col("_gain") > 0, 100.0)
    return rated.withColumn("rsi", value).drop("_delta", "_gain", "_loss")


def rsi(bars: DataFrame, n: int = 14, close: str = "h_close", ts: str = "hour_bucket") -> DataFrame:
    return own_rows(_with_rsi(row_chunks(bars, KEY, [ts], before=n, block=HOUR_BLOCK), close, n))


def _reach(span: int) -> int:
    """Rows after which an exponential weight of this span is below double precision."""
    if span <= 1:
        return 1
    return math.ceil(-math.log(1e-17) / -math.log(1 - 2 / (span + 1)))


EMA_CHUNK = 1000
# Powers relative to the chunk's start stay within double range up to this natural logarithm.
MAX_POWER = 600.0


def _chunk_size(reach: int) -> int:
    return max(EMA_CHUNK, reach)


def _ema(value: str, span: int, size: int) -> Column:
    """Exponential mean with weights (1 - a)^age normalised by their sum, a = 2 / (span + 1), in chunks of ``size``.

    A NULL has no weight but counts as a step of age, and takes the mean of the rows before it. Weights
    are taken relative to the chunk's start, which turns the mean into two running sums: constant work
    per row. Where the powers of a long chunk leave double range, the few rows that still weigh
    anything, fewer than a fifteenth of the chunk, are folded instead.
    """
    if span <= 1:
        return F.last(value, ignorenulls=True).over(chunk_window(KEY, Window.unboundedPreceding, 0))
    keep = 1.0 - 2.0 / (span + 1.0)
    if -math.log(keep) * size > MAX_POWER:
        rows = F.collect_list(F.struct(F.col(value).alias("v"))).over(chunk_window(KEY, -_reach(span), 0))
        zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("weight"))
        return F.aggregate(rows, zero, lambda acc, row: F.struct(
            (acc["sum"] * keep + F.coalesce(row["v"].cast("double"), F.lit(0.0))).alias("sum"),
            (acc["weight"] * keep + F.when(row["v"].isNull(), 0.0).otherwise(1.0)).alias("weight")),
            lambda acc: F.when(acc["weight"] > 0, acc["sum"] / acc["weight"]))
    at = (F.col(INDEX) - 1 - F.col(CHUNK) * size).cast("double")
    weight = F.when(F.col(value).isNotNull(), F.pow(F.lit(keep), -at))
    past = chunk_window(KEY, Window.unboundedPreceding, 0)
    return F.sum(F.col(value) * weight).over(past) / F.sum(weight).over(past)


def ema(bars: DataFrame, span: int, value: str = "h_close", ts: str = "hour_bucket",
        name: str | None = None) -> DataFrame:
    size = _chunk_size(_reach(span))
    chunks = row_chunks(bars, KEY, [ts], before=_reach(span), rows=size, block=HOUR_BLOCK)
    return own_rows(chunks.withColumn(name or f"ema_{span}", _ema(value, span, size)))


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, close: str = "h_close",
         ts: str = "hour_bucket") -> DataFrame:
    """Difference of two exponential means and its own exponential mean, in one chunking."""
    reach = max(_reach(fast), _reach(slow)) + _reach(signal)
    chunks = row_chunks(bars, KEY, [ts], before=reach, rows=_chunk_size(reach), block=HOUR_BLOCK)
    return own_rows(_with_macd(chunks, close, fast, slow, signal, _chunk_size(reach)))


def _with_macd(chunks: DataFrame, close: str, fast: int, slow: int, signal: int, size: int) -> DataFrame:
    return (
        chunks.withColumn("macd", _ema(close, fast, size) - _ema(close, slow, size))
        .withColumn("macd_signal", _ema("macd", signal, size))
    )


def _with_bollinger(chunks: DataFrame, close: str, n: int, width: float) -> DataFrame:
    mean, sd = _full(F.avg, close, n), _full(F.stddev_samp, close, n)
    banded = chunks.withColumns({"_mean": mean, "_sd": sd}).withColumns({
        "bb_upper": F.col("_mean") + F.col("_sd") * width,
        "bb_lower": F.col("_mean") - F.col("_sd") * width})
    return banded.withColumn("bb_position", X.ratio(
        F.col(close) - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower"))).drop("_mean", "_sd")


def bollinger(bars: DataFrame, n: int = 20, width: float = 2.0, close: str = "h_close",
              ts: str = "hour_bucket") -> DataFrame:
    chunks = row_chunks(bars, KEY, [ts], before=n - 1, block=HOUR_BLOCK)
    return own_rows(_with_bollinger(chunks, close, n, width))


def hourly_returns(hourly: DataFrame) -> DataFrame:
    o = F.col("h_open")
    return hourly.withColumns({
        "h_return": X.ratio(F.col("h_close") - o, o),
        "h_range": X.ratio(F.col("h_high") - F.col("h_low"), o),
        "h_buy_ratio": X.buy_volume_ratio("h_buy_vol", "h_sell_vol"),
    })


def technical_indicators(hourly: DataFrame, close: str = "h_close", ts: str = "hour_bucket",
                         lagged: tuple[str, ...] = ()) -> DataFrame:
    """Moving averages, RSI, MACD and Bollinger bands sharing one chunking and one window sort.

    ``lagged`` columns get their previous value as ``prev_<column>`` on the way.
    """
    reach = _reach(26) + _reach(9)
    chunks = row_chunks(hourly, KEY, [ts], before=reach, rows=_chunk_size(reach), block=HOUR_BLOCK)
    if lagged:
        chunks = chunks.withColumns({"prev_" + c: F.lag(c).over(chunk_window(KEY)) for c in lagged})
    chunks = chunks.withColumns({"sma_5": _sma(close, 5), "sma_20": _sma(close, 20)})
    chunks = _with_macd(_with_rsi(chunks, close, 14), close, 12, 26, 9, _chunk_size(reach))
    return own_rows(_with_bollinger(chunks, close, 20, 2.0))
