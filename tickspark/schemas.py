"""Fixed schemas of wire messages, facts and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

ENVELOPE = T.StructType([
    T.StructField("stream", T.StringType()),
    T.StructField("data", T.StringType()),
])

# Field names differ only by case (b and B), so a message is read as a map, whose keys are exact. All
# values are text; they are cast with try_cast, so that one bad field sends one message to
# quarantine instead of failing the job.
MESSAGE = T.MapType(T.StringType(), T.StringType())
LEVELS_WIRE = T.ArrayType(T.ArrayType(T.StringType()))

LEVEL = T.StructType([T.StructField("price", T.DoubleType()), T.StructField("qty", T.DoubleType())])

BOOK_TICKER = T.StructType([
    T.StructField("ts_exchange", T.TimestampType()),
    T.StructField("ts_ingest", T.TimestampType()),
    T.StructField("symbol_id", T.LongType()),
    T.StructField("update_id", T.LongType()),
    T.StructField("best_bid", T.DoubleType()),
    T.StructField("best_ask", T.DoubleType()),
    T.StructField("bid_qty", T.DoubleType()),
    T.StructField("ask_qty", T.DoubleType()),
])

TRADES = T.StructType([
    T.StructField("ts_exchange", T.TimestampType()),
    T.StructField("ts_ingest", T.TimestampType()),
    T.StructField("symbol_id", T.LongType()),
    T.StructField("agg_trade_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty", T.DoubleType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
])

DEPTH_EVENTS = T.StructType([
    T.StructField("ts_exchange", T.TimestampType()),
    T.StructField("ts_ingest", T.TimestampType()),
    T.StructField("symbol_id", T.LongType()),
    T.StructField("first_update_id", T.LongType()),
    T.StructField("final_update_id", T.LongType()),
    T.StructField("prev_final_update_id", T.LongType()),
    T.StructField("bids", T.ArrayType(LEVEL)),
    T.StructField("asks", T.ArrayType(LEVEL)),
])

# Unique keys of the raw facts. Re-delivery changes ts_ingest, so it is never part of a key.
KEYS = {
    "book_ticker": ["symbol_id", "ts_exchange", "update_id"],
    "trades": ["symbol_id", "agg_trade_id"],
    "depth_events": ["symbol_id", "ts_exchange", "final_update_id"],
}

L1_CSV = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("local_timestamp", T.LongType()),
    T.StructField("ask_amount", T.DoubleType()),
    T.StructField("ask_price", T.DoubleType()),
    T.StructField("bid_price", T.DoubleType()),
    T.StructField("bid_amount", T.DoubleType()),
])

# Precision and scale of the feature sink columns.
FEATURE_DECIMALS = {
    "microprice": (20, 8),
    "mid_price": (20, 8),
    "spread_abs": (20, 8),
    "spread_rel": (10, 6),
    "i1": (10, 6),
    "i10": (10, 6),
    "ofi": (20, 4),
    "volume_imbalance": (10, 6),
    "buy_volume_ratio": (10, 6),
    "vpin": (10, 6),
    "price_volatility": (10, 6),
    "return_1s": (12, 8),
}
