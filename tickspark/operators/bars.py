"""Time bars. Every bar is one groupBy of partially aggregable functions over primitive buffers: a hash
aggregate with map-side combine, one shuffle of pre-aggregated rows and no sort. A hot symbol or
bucket shuffles no more than any other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators.ordered import pick_row

SECOND = "1 second"


def _first(value, event_id: str, w: str) -> Column:
    return F.min_by(value, X.order_in_bucket("ts_exchange", event_id, w))


def _last(value, event_id: str, w: str) -> Column:
    return F.max_by(value, X.order_in_bucket("ts_exchange", event_id, w))


class _Bucketed:
    """Rows grouped by (bucket, symbol).

    A stream is grouped by an event-time window, whose state the watermark can close; a batch by
    the equal bucket start.
    """

    def __init__(self, df: DataFrame, w: str, name: str):
        self.df, self.w, self.name = df, w, name

    def agg(self, *aggs: Column) -> DataFrame:
        if not self.df.isStreaming:
            return self.df.groupBy(X.time_bucket("ts_exchange", self.w).alias(self.name), "symbol_id").agg(*aggs)
        bars = self.df.groupBy(F.window("ts_exchange", self.w).alias("window"), "symbol_id").agg(*aggs)
        return bars.withColumn(self.name, F.col("window.start"))


def _bucketed(df: DataFrame, w: str, name: str) -> _Bucketed:
    return _Bucketed(df, w, name)


def quote_bars_mid(bt: DataFrame, w: str = SECOND) -> DataFrame:
    """Mid OHLC, spread statistics, mean total quantity, update count and mean latency."""
    mid, spread = X.mid(), X.spread()
    return _bucketed(bt, w, "ts_second").agg(
        _first(mid, "update_id", w).alias("mid_open"),
        F.max(mid).alias("mid_high"),
        F.min(mid).alias("mid_low"),
        _last(mid, "update_id", w).alias("mid_close"),
        F.avg(spread).alias("spread_mean"),
        F.min(spread).alias("spread_min"),
        F.max(spread).alias("spread_max"),
        F.stddev_samp(spread).alias("spread_std"),
        F.avg(F.col("bid_qty") + F.col("ask_qty")).alias("total_qty_mean"),
        F.count(F.lit(1)).alias("update_count"),
        F.avg(X.elapsed_ms("ts_exchange", "ts_ingest")).alias("avg_latency_ms"),
    )


def quote_bars_bidask(bt: DataFrame, w: str = SECOND) -> DataFrame:
    """Bid and ask OHLC with averages, quantity open/close/extremes, spread statistics.

    ``mid_avg`` is the mean mid; ``microprice_avg`` repeats it under its compatibility name.
    """
    aggs = []
    for side, price in (("bid", "best_bid"), ("ask", "best_ask")):
        aggs += [
            _first(price, "update_id", w).alias(f"{side}_open"), _last(price, "update_id", w).alias(f"{side}_close"),
            F.max(price).alias(f"{side}_high"), F.min(price).alias(f"{side}_low"), F.avg(price).alias(f"{side}_avg"),
        ]
    for q in ("bid_qty", "ask_qty"):
        aggs += [
            _first(q, "update_id", w).alias(f"{q}_open"), _last(q, "update_id", w).alias(f"{q}_close"),
            F.max(q).alias(f"{q}_max"), F.min(q).alias(f"{q}_min"), F.avg(q).alias(f"{q}_avg"),
        ]
    return _bucketed(bt, w, "ts_bucket").agg(
        *aggs,
        F.avg(X.spread()).alias("spread_avg"), F.max(X.spread()).alias("spread_max"),
        F.min(X.spread()).alias("spread_min"),
        F.count(F.lit(1)).alias("tick_count"),
        F.avg(X.mid()).alias("mid_avg"),
    ).withColumn("microprice_avg", F.col("mid_avg"))


def quote_bars_table(bt: DataFrame, w: str = SECOND) -> DataFrame:
    """The table form of the quote bar with quantity means and the quantity-weighted mid."""
    mid, spread, qty = X.mid(), X.spread(), F.col("bid_qty") + F.col("ask_qty")
    return _bucketed(bt, w, "ts_second").agg(
        _first(mid, "update_id", w).alias("mid_open"), F.max(mid).alias("mid_high"),
        F.min(mid).alias("mid_low"), _last(mid, "update_id", w).alias("mid_close"),
        F.avg(spread).alias("spread_mean"), F.stddev_samp(spread).alias("spread_std"),
        F.min(spread).alias("spread_min"), F.max(spread).alias("spread_max"),
        F.avg("bid_qty").alias("bid_qty_mean"), F.avg("ask_qty").alias("ask_qty_mean"),
        F.count(F.lit(1)).alias("updates_count"),
        X.ratio(F.sum(mid * qty), F.sum(qty)).alias("volume_weighted_mid"),
    )


def quote_bars_migrated(bt: DataFrame, w: str = SECOND) -> DataFrame:
    bars = quote_bars_mid(bt, w)
    return bars.select("ts_second", "symbol_id", "mid_open", "mid_high", "mid_low", "mid_close", "spread_mean",
                       "spread_std", "spread_min", "spread_max", F.col("update_count").alias("total_updates"))


def _side_sum(value, buy: bool) -> Column:
    return F.sum(F.when(X.is_buy() == F.lit(buy), value).otherwise(0.0))


def trade_bars(tr: DataFrame, w: str = SECOND) -> DataFrame:
    """Trade count, volume, VWAP (NULL without volume), side volumes and price OHLC."""
    vol = F.sum("qty")
    return _bucketed(tr, w, "ts_second").agg(
        F.count(F.lit(1)).alias("trade_count"),
        vol.alias("vol_sum"),
        F.when(vol > 0, F.sum(X.trade_value()) / vol).alias("vwap"),
        _side_sum(F.col("qty"), True).alias("buy_vol"),
        _side_sum(F.col("qty"), False).alias("sell_vol"),
        _first("price", "agg_trade_id", w).alias("price_open"),
        F.max("price").alias("price_high"),
        F.min("price").alias("price_low"),
        _last("price", "agg_trade_id", w).alias("price_close"),
    )


def trade_bars_ext(tr: DataFrame, w: str = SECOND) -> DataFrame:
    """Trade bars with quote volume, trade sizes, side counts and the share of buys."""
    n = F.count(F.lit(1))
    return _bucketed(tr, w, "ts_bucket").agg(
        _first("price", "agg_trade_id", w).alias("price_open"), _last("price", "agg_trade_id", w).alias("price_close"),
        F.max("price").alias("price_high"), F.min("price").alias("price_low"),
        F.sum("qty").alias("volume"), F.sum(X.trade_value()).alias("quote_volume"), n.alias("trade_count"),
        F.avg("qty").alias("avg_trade_size"), F.max("qty").alias("max_trade_size"),
        F.min("qty").alias("min_trade_size"),
        _side_sum(F.col("qty"), True).alias("buy_volume"), _side_sum(F.col("qty"), False).alias("sell_volume"),
        F.count_if(X.is_buy()).alias("buy_count"), F.count_if(~X.is_buy()).alias("sell_count"),
        X.ratio(F.sum(X.trade_value()), F.sum("qty")).alias("vwap"),
        (F.count_if(X.is_buy()) / n).alias("buy_ratio"),
    )


def trade_bars_table(tr: DataFrame, w: str = SECOND) -> DataFrame:
    """The table form of the trade bar with traded value and imbalance ratio."""
    vol = F.sum("qty")
    return _bucketed(tr, w, "ts_second").agg(
        F.count(F.lit(1)).alias("trade_count"), vol.alias("volume_sum"), F.sum(X.trade_value()).alias("value_sum"),
        X.ratio(F.sum(X.trade_value()), vol).alias("vwap"),
        _side_sum(F.col("qty"), True).alias("buy_volume"), _side_sum(F.col("qty"), False).alias("sell_volume"),
        F.count_if(X.is_buy()).alias("buy_count"), F.count_if(~X.is_buy()).alias("sell_count"),
        F.min("price").alias("price_min"), F.max("price").alias("price_max"),
    ).withColumn("imbalance_ratio", X.volume_imbalance())


def trade_bars_migrated(tr: DataFrame, w: str = SECOND) -> DataFrame:
    return trade_bars_ext(tr, w).select(
        F.col("ts_bucket").alias("ts_second"), "symbol_id", "price_open", "price_high", "price_low", "price_close",
        F.col("volume").alias("volume_base"), F.col("quote_volume").alias("volume_quote"),
        F.col("trade_count").alias("trades_count"), F.col("buy_count").alias("buy_trades_count"),
        F.col("sell_count").alias("sell_trades_count"), "buy_volume", "sell_volume")


def depth_bars(de: DataFrame, w: str = SECOND) -> DataFrame:
    """Update count and the first and last best level of each side in the bucket."""
    best = {
        "bid_price": F.try_element_at("bids", F.lit(1))["price"], "ask_price": F.try_element_at("asks", F.lit(1))["price"],
        "bid_qty": F.try_element_at("bids", F.lit(1))["qty"], "ask_qty": F.try_element_at("asks", F.lit(1))["qty"],
    }
    slim = de.select("ts_exchange", "symbol_id", "final_update_id", *[c.alias(n) for n, c in best.items()])
    return _bucketed(slim, w, "ts_bucket").agg(
        F.count(F.lit(1)).alias("update_count"),
        *[_last(n, "final_update_id", w).alias(f"last_{n}") for n in best],
        *[_first(n, "final_update_id", w).alias(f"first_{n}") for n in best],
    )


def hourly_rollup(bt_bars: DataFrame, tr_bars: DataFrame) -> DataFrame:
    """Hourly OHLC, volume, spread, volatility and side volumes from finer bars."""
    from tickspark.operators.joins import pair_bars

    bar_at = F.col("ts_second")
    return (
        pair_bars(bt_bars, tr_bars, ["vol_sum", "buy_vol", "sell_vol"])
        .groupBy(F.date_trunc("hour", "ts_second").alias("hour_bucket"), "symbol_id")
        .agg(
            F.min_by("mid_open", bar_at).alias("h_open"), F.max("mid_high").alias("h_high"),
            F.min("mid_low").alias("h_low"), F.max_by("mid_close", bar_at).alias("h_close"),
            F.sum(F.coalesce("vol_sum", F.lit(0.0))).alias("h_volume"),
            F.avg("spread_mean").alias("h_avg_spread"), F.stddev_samp("mid_close").alias("h_volatility"),
            F.sum("update_count").alias("h_updates"),
            F.sum(F.coalesce("buy_vol", F.lit(0.0))).alias("h_buy_vol"),
            F.sum(F.coalesce("sell_vol", F.lit(0.0))).alias("h_sell_vol"),
        )
    )


def depth_hourly(topn: DataFrame) -> DataFrame:
    """Hourly means of book features and the spread's mean and deviation."""
    gap = F.col("a1_price") - F.col("b1_price")
    return topn.groupBy(F.date_trunc("hour", "ts_exchange").alias("hour_bucket"), "symbol_id").agg(
        F.avg("i1").alias("avg_i1"), F.avg("i5").alias("avg_i5"), F.avg("microprice").alias("avg_microprice"),
        F.avg("wall_size_bps").alias("avg_wall_size"), F.avg(gap).alias("avg_spread"),
        F.stddev_samp(gap).alias("spread_volatility"))


def subsecond_bars(bt: DataFrame, w: str = "100 milliseconds") -> DataFrame:
    return quote_bars_mid(bt, w)


def topn_resample(topn: DataFrame, w: str = "100 milliseconds") -> DataFrame:
    """The last flat book of every bucket."""
    return bucket_pick(topn.withColumn("ts_bucket", X.time_bucket("ts_exchange", w)),
                       ["ts_bucket", "symbol_id"], ["ts_exchange", "final_update_id"], "last")


def bucket_pick(df: DataFrame, keys: list[str], order: list[str], which: str) -> DataFrame:
    """The first or last row of every group by a time, or a time and a whole number, as one aggregation
    instead of a ranked window."""
    return pick_row(df, keys, X.order_of_rows(*order), which == "last").select(*keys, *[c for c in df.columns if c not in keys])


def bucket_window_stats(bt: DataFrame, w: str = SECOND) -> DataFrame:
    """Bucket statistics repeated on every tick of the bucket.

    Aggregated first and joined back, so that no bucket has to sit in one task as it would in a
    window; the adaptive skew join splits a hot bucket.
    """
    ticks = bt.select("ts_exchange", "symbol_id", "update_id", X.mid().alias("mid"), X.spread().alias("spread"),
                      X.time_bucket("ts_exchange", w).alias("ts_second"))
    stats = ticks.groupBy("symbol_id", "ts_second").agg(
        F.avg("spread").alias("spread_mean"), F.min("spread").alias("spread_min"),
        F.max("spread").alias("spread_max"), F.stddev_samp("spread").alias("spread_std"),
        F.max("mid").alias("mid_high"), F.min("mid").alias("mid_low"), F.count(F.lit(1)).alias("update_count"))
    stats = stats.withColumnsRenamed({"symbol_id": "_symbol", "ts_second": "_second"})
    same = F.col("symbol_id").eqNullSafe(F.col("_symbol")) & F.col("ts_second").eqNullSafe(F.col("_second"))
    return ticks.join(stats, same).drop("_symbol", "_second")
