"""Joins. Facts are aggregated before they meet a dimension or another fact, so join inputs are
bars or per-symbol rows. Dimension sides carry no broadcast hint: Spark broadcasts them when their
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark import functions as X

BAR_KEY = ["symbol_id", "ts_second"]


def pair_bars(bt_bars: DataFrame, tr_bars: DataFrame, trade_columns: list[str]) -> DataFrame:
    """Quote bars with the given trade-bar columns, NULL where nothing traded."""
    return bt_bars.join(tr_bars.select(*BAR_KEY, *trade_columns), BAR_KEY, "left")


def join_bars(bt_bars: DataFrame, tr_bars: DataFrame) -> DataFrame:
    """Quote bars with trade measures; counts and volumes default to 0, VWAP to the mid close."""
    zero = F.lit(0.0)
    paired = pair_bars(bt_bars, tr_bars, ["trade_count", "vol_sum", "vwap", "buy_vol", "sell_vol"])
    return paired.select(
        *bt_bars.columns,
        F.coalesce("trade_count", F.lit(0)).alias("trade_count"),
        F.coalesce("vol_sum", zero).alias("volume"),
        F.coalesce("vwap", "mid_close").alias("vwap"),
        F.coalesce("buy_vol", zero).alias("buy_volume"),
        F.coalesce("sell_vol", zero).alias("sell_volume"),
        X.volume_imbalance("buy_vol", "sell_vol").alias("buy_sell_imbalance"),
    )


def enrich_symbols(df: DataFrame, symbols: DataFrame, how: str = "inner") -> DataFrame:
    """Attach the symbol text to rows that carry a symbol id."""
    dim = symbols.select(F.col("id").alias("symbol_id"), "symbol")
    return df.join(dim, "symbol_id", how)


def market_data_bars(quotes: DataFrame, trades: DataFrame, depth: DataFrame) -> DataFrame:
    """Quote bars with trade and depth bars of the same bucket.

    Besides the joined view's columns it carries closing quantities and side volumes, which the
    feature rows need.
    """
    keys = ["ts_bucket", "symbol_id"]
    q = quotes.select(*keys, "bid_close", "ask_close", "bid_qty_close", "ask_qty_close", "spread_avg",
                      "microprice_avg", F.col("tick_count").alias("bt_ticks"))
    t = trades.select(*keys, "price_close", "volume", "trade_count", "vwap", "buy_ratio", "buy_volume",
                      "sell_volume")
    d = depth.select(*keys, F.col("update_count").alias("depth_updates"))
    return q.join(t, keys, "left").join(d, keys, "left")


def range_join_topn(bt_bars: DataFrame, topn: DataFrame, w: str = "1 second") -> DataFrame:
    """Every book row inside each bar's interval; bars without a book stay.

    The interval predicate becomes an equality on the bucket start: one left join, each side read once. A
    (symbol, second) holds what the feed sends in a second, so no key is hot. Books that carry their ``ts_second``
    and are stored in the buckets of the bars (:func:`tickspark.sources.tables.write_bucketed`) are not moved either.
    """
    second = F.col("ts_second") if "ts_second" in topn.columns else X.time_bucket("ts_exchange", w).alias("ts_second")
    books = topn.select("symbol_id", second, F.col("ts_exchange").alias("book_ts"), "i1", "i5", "microprice")
    return bt_bars.select(*BAR_KEY, "mid_close", "spread_mean").join(books, BAR_KEY, "left")


def latest_in_bucket_join(bt_bars: DataFrame, topn: DataFrame, w: str = "1 second") -> DataFrame:
    """The last book row inside each bar's interval; bars without a book stay."""
    cols = ["ts_exchange", "b1_price", "b1_qty", "a1_price", "a1_qty", "microprice", "i1", "i5",
            "total_bid_qty", "total_ask_qty"]
    at = X.order_in_bucket("ts_exchange", "final_update_id", w)
    latest = topn.groupBy("symbol_id", X.time_bucket("ts_exchange", w).alias("ts_second")).agg(
        *[F.max_by(c, at).alias("book_ts" if c == "ts_exchange" else c) for c in cols])
    return bt_bars.select(*BAR_KEY, "mid_close", "spread_mean", "update_count").join(latest, BAR_KEY, "left")


def left_recent_join(symbols: DataFrame, bt: DataFrame, tr: DataFrame) -> DataFrame:
    """Per symbol the counts and last ingest of both facts; symbols without data stay.

    Each fact is aggregated on its own, so counts do not multiply.
    """
    quotes = bt.groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("bt_count"), F.max("ts_exchange").alias("last_bt"),
        F.max("ts_ingest").alias("last_bt_ingest"),
        F.avg(X.elapsed_ms("ts_exchange", "ts_ingest")).alias("avg_latency_ms"))
    trades = tr.groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("tr_count"), F.max("ts_exchange").alias("last_tr"),
        F.max("ts_ingest").alias("last_tr_ingest"))
    return (
        symbols.select(F.col("id").alias("symbol_id"), "symbol", "is_active")
        .join(quotes, "symbol_id", "left").join(trades, "symbol_id", "left")
        .withColumns({"bt_count": F.coalesce("bt_count", F.lit(0)), "tr_count": F.coalesce("tr_count", F.lit(0))})
    )


def semi_symbols(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose symbol_id occurs in ``wanted(symbol_id)``."""
    return df.join(wanted.select("symbol_id"), "symbol_id", "left_semi")


def anti_existing(new: DataFrame, live: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored in ``live`` yet. NULL is a key value like any other."""
    stored = live.select(*[F.col(k).alias(f"_stored_{k}") for k in key])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in key])
    return new.join(stored, same, "left_anti")


def merge_depth_hourly(hourly: DataFrame, depth: DataFrame) -> DataFrame:
    return hourly.join(depth, ["hour_bucket", "symbol_id"], "left")


def stream_counts(bt: DataFrame, tr: DataFrame) -> DataFrame:
    """Quote records, trade records and last quote per quoted symbol."""
    quotes = bt.groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("bt_records"), F.max("ts_exchange").alias("last_bt_update"))
    trades = tr.groupBy("symbol_id").agg(F.count(F.lit(1)).alias("trade_records"))
    return quotes.join(trades, "symbol_id", "left").withColumn(
        "trade_records", F.coalesce("trade_records", F.lit(0)))


def current_hour_stats_join(offsets: DataFrame, stats: DataFrame, asof: str) -> DataFrame:
    """Offsets with the ingestion statistics of the hour that holds ``asof``."""
    now = stats.filter(F.col("date_hour") == F.date_trunc("hour", X.instant(asof))).drop("date_hour")
    return offsets.join(now, ["symbol_id", "stream_type"], "left")
