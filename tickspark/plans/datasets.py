"""Training, hourly and real-time datasets assembled from bars."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators.bars import depth_hourly, hourly_rollup
from tickspark.operators.indicators import (
    forward_return, hourly_returns, lag_features, rolling_sma_vol, technical_indicators)
from tickspark.operators.joins import enrich_symbols, join_bars, merge_depth_hourly, pair_bars
from tickspark.operators.ordered import CHUNK, HALO, INDEX, TOTAL, fill_forward, row_chunks
from tickspark.operators.ticks import (
    active_symbols, day_slice, optional_symbol_filter, recent, time_slice, with_calendar)

ZSCORE_GUARD = 1e-9
LABEL_THRESHOLD = 5e-4
SEQUENCE_ROWS = 4096


def _listed(df: DataFrame) -> DataFrame:
    """Rows that can meet a symbol. An inner join drops the others anyway, but would do so on only one of the two
    readers of a shared exchange."""
    return df.filter(F.col("symbol_id").isNotNull())


def yesterday_dataset(bt_bars: DataFrame, tr_bars: DataFrame, symbols: DataFrame, day: str) -> DataFrame:
    """One day of bars of the active symbols with the previous mid and imbalance.

    The day and the active symbols are cut out before lagging, so the first bar has no previous one.
    """
    bars = pair_bars(day_slice(bt_bars, day, "ts_second"), day_slice(tr_bars, day, "ts_second"),
                     ["trade_count", "volume_sum", "vwap", "imbalance_ratio"])
    named = enrich_symbols(bars, active_symbols(symbols)).select(
        "symbol_id", "ts_second", "symbol", "mid_open", "mid_high", "mid_low", "mid_close", "spread_mean", "trade_count",
        "volume_sum", "vwap", "imbalance_ratio")
    return lag_features(named).drop("symbol_id")


def training_day(bt_bars: DataFrame, tr_bars: DataFrame, symbols: DataFrame, day: str,
                 ids: list[int] | None = None) -> DataFrame:
    """The 23-column training dataset of one day."""
    quotes = optional_symbol_filter(day_slice(bt_bars, day, "ts_second"), ids)
    joined = enrich_symbols(join_bars(quotes, day_slice(tr_bars, day, "ts_second")), active_symbols(symbols))
    return with_calendar(joined).select(
        "ts_second", "symbol", "symbol_id", "mid_open", "mid_high", "mid_low", "mid_close", "spread_mean",
        "spread_min", "spread_max", "spread_std", "total_qty_mean", "update_count", "avg_latency_ms",
        "trade_count", "volume", "vwap", "buy_volume", "sell_volume", "buy_sell_imbalance", "timestamp", "hour",
        "day_of_week")


def training_rows(bt_bars: DataFrame, tr_bars: DataFrame, day: str, symbol_id: int | None = None) -> DataFrame:
    """The 7-column training function: one symbol or, without a symbol, all of them."""
    quotes = day_slice(bt_bars, day, "ts_second")
    if symbol_id is not None:
        quotes = quotes.filter(F.col("symbol_id") == symbol_id)
    joined = pair_bars(quotes, day_slice(tr_bars, day, "ts_second"), ["trade_count", "vwap", "buy_vol", "sell_vol"])
    return joined.select(
        "ts_second", "symbol_id", "mid_close", "spread_mean",
        F.coalesce("trade_count", F.lit(0)).alias("trade_count"), "vwap",
        X.volume_imbalance("buy_vol", "sell_vol").alias("buy_sell_imbalance"))


def training_view(bt_bars: DataFrame, tr_bars: DataFrame, day: str, name: str | None = None) -> str:
    """Register :func:`training_rows` of a day as a temporary view and return its name."""
    name = name or f"training_{day.replace('-', '_')}"
    training_rows(bt_bars, tr_bars, day).createOrReplaceTempView(name)
    return name


def hourly_ml_features(bt_bars: DataFrame, tr_bars: DataFrame, symbols: DataFrame, start: str, end: str,
                       ids: list[int] | None = None, topn: DataFrame | None = None) -> DataFrame:
    """Hourly bars of ``[start, end]`` with returns, lags and indicators; depth means if given."""
    until = (date.fromisoformat(end) + timedelta(days=1)).isoformat()

    def cut(df, ts="ts_second"):
        return optional_symbol_filter(time_slice(df, start, until, ts), ids)

    hourly = hourly_returns(hourly_rollup(cut(_listed(bt_bars)), cut(tr_bars)))
    measured = technical_indicators(hourly, lagged=("h_close", "h_volume"))
    features = enrich_symbols(measured, symbols).withColumn(
        "timestamp", X.epoch_seconds("hour_bucket")).drop("h_buy_vol", "h_sell_vol")
    if topn is not None:
        features = merge_depth_hourly(features, depth_hourly(cut(topn, "ts_exchange")))
    return features


def trailing_features(bt_bars: DataFrame, tr_bars: DataFrame, symbols: DataFrame, today: str, days_back: int = 30,
                      ids: list[int] | None = None, topn: DataFrame | None = None) -> DataFrame:
    """Hourly features of the window that ends yesterday and starts ``days_back`` days earlier."""
    end = date.fromisoformat(today) - timedelta(days=1)
    start = end - timedelta(days=days_back)
    return hourly_ml_features(bt_bars, tr_bars, symbols, start.isoformat(), end.isoformat(), ids, topn)


def realtime_features(bt_bars: DataFrame, tr_bars: DataFrame, symbols: DataFrame, asof: str,
                      lookback: str = "60 MINUTES", ids: list[int] | None = None, preceding: int = 300) -> DataFrame:
    """Recent bars with short-term mean and deviation, for inference."""
    quotes = optional_symbol_filter(recent(_listed(bt_bars), asof, lookback, "ts_second"), ids).select(
        "symbol_id", "ts_second", "mid_close", "spread_mean", "total_qty_mean", "update_count")
    trades = recent(tr_bars, asof, lookback, "ts_second")
    rolled = enrich_symbols(rolling_sma_vol(quotes, preceding), active_symbols(symbols))
    return join_bars(rolled, trades).select(
        "ts_second", "symbol", "symbol_id", F.col("mid_close").alias("price"), F.col("spread_mean").alias("spread"),
        F.col("total_qty_mean").alias("liquidity"), "update_count", "volume", "vwap", "sma_5min", "volatility_5min",
        X.epoch_seconds("ts_second").alias("timestamp"))


def supervised_table(bt_bars: DataFrame, tr_bars: DataFrame, symbols: DataFrame, h: int = 5,
                     threshold: float = LABEL_THRESHOLD) -> DataFrame:
    """Features with the forward return, its sign and a three-class label."""
    # The return needs quotes only, so the windows run before the join.
    base = pair_bars(forward_return(_listed(bt_bars), h), tr_bars, ["trade_count", "volume_sum", "vwap", "imbalance_ratio"])
    ret = F.col(f"ret_{h}s")
    return enrich_symbols(base, symbols).withColumns({
        "label": F.signum(ret).cast("long"),
        "label3": F.when(ret > threshold, 1).when(ret < -threshold, -1).otherwise(0).cast("long"),
    })


def zscore(df: DataFrame, columns: list[str]) -> DataFrame:
    """Standardise columns per symbol as ``z_<column>``.

    The moments are aggregated and joined, one row per symbol; no window over a whole symbol.
    """
    moments = df.groupBy("symbol_id").agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"_s_{c}") for c in columns])
    moments = moments.withColumnRenamed("symbol_id", "_of")
    return df.join(moments, F.col("symbol_id").eqNullSafe(F.col("_of"))).select(*df.columns, *[
        ((F.col(c) - F.col(f"_m_{c}")) / (F.col(f"_s_{c}") + ZSCORE_GUARD)).alias(f"z_{c}") for c in columns])


def ffill_then_zero(df: DataFrame, columns: list[str], ts: str = "ts_second") -> DataFrame:
    """Fill NULLs by the symbol's latest earlier value, then by 0."""
    return fill_forward(df, ["symbol_id"], [ts], columns).fillna(0.0, columns)


def regular_grid(bars: DataFrame, w: str = "1 second", ts: str = "ts_second") -> DataFrame:
    """A gap-free grid from each symbol's first to last bar; missing bars have NULL measures.

    Expanded in two steps, days and then the slots of a day, so no row ever holds more than one
    day of slots.
    """
    step, day_us = X.width_us(w), X.width_us("1 day")
    if day_us % step:
        raise ValueError("the width must divide a day")
    span = bars.groupBy("symbol_id").agg(
        F.unix_micros(F.min(ts)).alias("_lo"), F.unix_micros(F.max(ts)).alias("_hi"))
    days = span.withColumn("_day", F.explode(F.sequence(
        F.floor(F.col("_lo") / day_us), F.floor(F.col("_hi") / day_us)))).repartition("symbol_id", "_day")
    first = F.greatest(F.col("_lo"), F.col("_day") * day_us)
    last = F.least(F.col("_hi"), F.col("_day") * day_us + (day_us - step))
    slots = days.select("symbol_id", F.explode(F.sequence(first, last, F.lit(step))).alias("_us")).select(
        "symbol_id", F.timestamp_micros("_us").alias(ts))
    return slots.join(bars, ["symbol_id", ts], "left")


def sequences(bars: DataFrame, features: list[str], length: int = 64, step: int = 5, h: int = 5,
              close: str = "mid_close", ts: str = "ts_second") -> DataFrame:
    """Sliding windows of ``length`` rows and the return h bars after their last row.

    Windows start at every ``step``-th row of a symbol while ``length + 5`` rows follow, as the
    fixed margin demands; windows without a target are skipped. A chunk of rows is gathered once, as one array of
    bounded length, and only the kept windows are cut out of it.
    """
    reach = length - 1 + h
    needed = bars.select(*dict.fromkeys(["symbol_id", ts, close, *features]))
    chunks = row_chunks(needed, ["symbol_id"], [ts], after=reach, rows=max(SEQUENCE_ROWS, reach))
    row = F.struct(INDEX, HALO, F.col(ts).alias("at"), F.col(close).cast("double").alias("close"),
                   F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    packed = chunks.groupBy("symbol_id", CHUNK).agg(F.sort_array(F.collect_list(row)).alias("_rows_"), F.max(TOTAL).alias(TOTAL))
    rows, x = F.col("_rows_"), F.col("_x")
    starts = F.filter(F.sequence(F.lit(1), F.size(rows)), lambda i: ~F.get(rows, i - 1)[HALO] & (
        F.pmod(F.get(rows, i - 1)[INDEX] - 1, F.lit(step)) == 0) & (F.get(rows, i - 1)[INDEX] - 1 < F.col(TOTAL) - length - 5))
    ends = lambda i: F.get(rows, i + length - 2)["close"]
    cut = F.transform(starts, lambda i: F.struct(
        F.get(rows, i - 1)["at"].alias(ts), F.slice(x, i, length).alias("X"),
        X.ratio(F.get(rows, i + length - 2 + h)["close"] - ends(i), ends(i)).alias("y")))
    windows = packed.withColumn("_x", F.transform(rows, lambda r: r["x"])).select("symbol_id", F.inline(cut))
    return windows.filter(F.col("y").isNotNull()).select("symbol_id", ts, "X", "y")


def symbol_one_hot(df: DataFrame, ids: list[int]) -> DataFrame:
    """One indicator column per listed symbol."""
    return df.select("*", *[(F.col("symbol_id") == i).cast("int").alias(f"is_symbol_{i}") for i in ids])


def symbol_metadata(symbols: DataFrame) -> DataFrame:
    return symbols.select(F.col("id").alias("symbol_id"), *[c for c in symbols.columns if c != "id"]).orderBy("symbol")


# Upper list positions (exclusive) of liquidity tiers, priority groups and frequency classes.
LIQUIDITY_TIERS = [
    ("tier1_medium", 10), ("tier2_moderate", 30), ("tier3_low", 50), ("tier4_very_low", 70), ("tier5_micro", 90),
    ("tier6_nano", 110), ("tier7_defi", 130), ("tier8_newer", 150), ("tier9_lowcap", 170), ("tier10_ultra", 200),
]
PRIORITY_GROUPS = [("critical", 20), ("high", 60), ("medium", 120), ("low", 200)]
FREQUENCY_CLASSES = [("high_frequency", 10), ("medium_frequency", 50), ("low_frequency", 200)]


def _band(position, bands):
    expr = F.lit(None).cast("string")
    for name, upper in reversed(bands):
        expr = F.when(position < upper, name).otherwise(expr)
    return expr


def tier_dimension(ranked: DataFrame, tiers=None, priorities=None, frequencies=None, position: str = "position",
                   priority_position: str | None = None, frequency_position: str | None = None) -> DataFrame:
    """Tier, priority and frequency class of each symbol from its 0-based places in the three symbol lists.

    The lists rank symbols differently; a symbol that a list lacks has a NULL place and no class there. Places not
    named are those in the first list.
    """
    at = {"liquidity_tier": (position, tiers or LIQUIDITY_TIERS),
          "priority": (priority_position or position, priorities or PRIORITY_GROUPS),
          "frequency": (frequency_position or position, frequencies or FREQUENCY_CLASSES)}
    return ranked.select("symbol", position, *[_band(F.col(p), bands).alias(name) for name, (p, bands) in at.items()])


def enrich_tier(df: DataFrame, tiers: DataFrame) -> DataFrame:
    return df.join(tiers, "symbol", "left")
