"""Profiling aggregates, top lists and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators.joins import enrich_symbols, left_recent_join
from tickspark.operators.ordered import ranked_quantile, value_ranks
from tickspark.operators.ticks import active_symbols, recent

BYTES_PER_QUOTE = 76
# The numeric features summarised by feature_summary.
SUMMARY_FEATURES = ["microprice", "spread_rel", "i1", "ofi", "volume_imbalance", "buy_volume_ratio",
                    "price_volatility"]
SIDE_STATS = ["count", "mean", "std", "min", "max"]


def _n():
    return F.count(F.lit(1))


def _span_seconds():
    return X.elapsed_seconds(F.min("ts_exchange"), F.max("ts_exchange"))


def _latency():
    return X.elapsed_ms("ts_exchange", "ts_ingest")


def update_rate(bt: DataFrame) -> DataFrame:
    """Count, first, last, duration and update rates; rates are NULL for a zero duration."""
    return bt.groupBy("symbol_id").agg(
        _n().alias("updates_count"), F.min("ts_exchange").alias("first_update"),
        F.max("ts_exchange").alias("last_update"), (_span_seconds() / 60.0).alias("duration_minutes"),
        X.ratio(_n().cast("double"), _span_seconds() / 60.0).alias("updates_per_minute"),
        X.ratio(_n().cast("double"), _span_seconds()).alias("updates_per_second"))


def rate_compliance(bt: DataFrame, per_minute: float = 1.0) -> DataFrame:
    """Whether each symbol seen for over a minute reaches the required update rate."""
    return (
        update_rate(bt).filter("duration_minutes > 1")
        .select("symbol_id", F.col("updates_count").alias("total_updates"), "duration_minutes",
                "updates_per_minute",
                F.when(F.col("updates_per_minute") >= per_minute, "COMPLIANT").otherwise("NON_COMPLIANT")
                .alias("compliance"))
    )


def symbol_stats(bt: DataFrame) -> DataFrame:
    return bt.groupBy("symbol_id").agg(
        _n().alias("updates_count"), F.min("best_bid").alias("min_bid"), F.max("best_ask").alias("max_ask"),
        F.avg(X.mid()).alias("avg_mid_price"), F.avg(X.spread()).alias("avg_spread"),
        F.min("ts_exchange").alias("first_update"), F.max("ts_exchange").alias("last_update"))


def spread_stats(bt: DataFrame, denominator: str = "bid") -> DataFrame:
    return bt.groupBy("symbol_id").agg(
        F.avg(X.spread()).alias("avg_spread"), F.min(X.spread()).alias("min_spread"),
        F.max(X.spread()).alias("max_spread"), F.stddev_samp(X.spread()).alias("spread_volatility"),
        F.avg(X.spread_pct(denominator)).alias("avg_spread_percent"))


def latency_stats(df: DataFrame, p: float = 0.95) -> DataFrame:
    """Latency moments and the exact interpolated quantile per symbol, all from the counts of equal latencies.

    Symbols without a latency stay, by their count of NULL.
    """
    us = df.select("symbol_id", X.elapsed_us("ts_exchange", "ts_ingest").alias("us"))
    ranks = value_ranks(us, ["symbol_id"], "us", 65_536, with_null=True)
    n, ms = (F.col("hi") - F.col("lo") + 1).cast("double"), F.col("us") / 1000.0
    # Deviations from the symbol's least latency: sums of squares of large numbers would lose digits.
    off = (F.col("us") - F.col("least")) / 1000.0
    total, first, second = F.sum(n), F.sum(n * off), F.sum(n * off * off)
    sums = ranks.groupBy("symbol_id").agg(
        F.min(ms).alias("min_latency_ms"), F.max(ms).alias("max_latency_ms"), total.alias("_n"), first.alias("_first"),
        second.alias("_second"), (ranked_quantile("us", p) / 1000.0).alias("p95_latency_ms"))
    spread = (F.col("_second") - F.col("_first") * F.col("_first") / F.col("_n")) / (F.col("_n") - 1)
    return sums.select(
        "symbol_id", (F.col("min_latency_ms") + F.col("_first") / F.col("_n")).alias("avg_latency_ms"), "min_latency_ms",
        "max_latency_ms", F.when(F.col("_n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("latency_stddev"), "p95_latency_ms")


def daily_volume(bt: DataFrame) -> DataFrame:
    """Rows, distinct symbols and estimated bytes per day.

    Counted per (day, symbol) first, so that distinct counting moves one row per pair.
    """
    per_symbol = bt.groupBy(F.to_date("ts_exchange").alias("date"), "symbol_id").agg(_n().alias("_n"))
    return per_symbol.groupBy("date").agg(
        F.sum("_n").alias("total_records"), F.count("symbol_id").alias("unique_symbols"),
        (F.sum("_n") * BYTES_PER_QUOTE).alias("estimated_bytes"))


def trade_bar_summary(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol_id").agg(
        _n().alias("data_points"), F.avg("volume").alias("avg_volume"),
        F.avg("trade_count").alias("avg_trades_per_bar"), F.avg("buy_ratio").alias("avg_buy_ratio"))


def feature_summary(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, population deviation, minimum and maximum of each feature, in long form."""
    columns = columns or SUMMARY_FEATURES
    measure = {"count": F.count, "mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    # A single distinct aggregate is planned as a pre-aggregation per symbol.
    wide = features.agg(
        _n().alias("total_records"), F.count_distinct("symbol_id").alias("symbols"),
        F.min("ts_exchange").alias("range_start"), F.max("ts_exchange").alias("range_end"),
        *[measure[m](c).alias(f"{c}__{m}") for c in columns for m in SIDE_STATS])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{m}").alias(m) for m in SIDE_STATS])
                     for c in columns])
    return wide.select("total_records", "symbols", "range_start", "range_end", F.explode(rows).alias("_f")).select(
        "_f.feature", *[F.col(f"_f.{m}").alias(m) for m in SIDE_STATS], "total_records", "symbols", "range_start",
        "range_end")


def ingestion_counts(symbols: DataFrame, bt: DataFrame, tr: DataFrame, asof: str, interval: str = "1 HOUR"):
    """Counts, last ingests and mean latency of every active symbol in the recent interval."""
    return left_recent_join(active_symbols(symbols), recent(bt, asof, interval), recent(tr, asof, interval)).select(
        "symbol", F.col("bt_count").alias("book_ticker_count_1h"), F.col("tr_count").alias("trades_count_1h"),
        F.col("last_bt_ingest").alias("last_book_ticker"), F.col("last_tr_ingest").alias("last_trade"),
        "avg_latency_ms")


def _heartbeat(df: DataFrame, name: str, asof: str, windows: dict[str, str]) -> DataFrame:
    return df.agg(
        F.max("ts_exchange").alias("last_ts"),
        *[F.count_if(F.col("ts_exchange") >= X.before(asof, w)).alias(n) for n, w in windows.items()],
    ).select(F.lit(name).alias("table_name"), "last_ts", *windows)


# The look-back windows of the heartbeat.
HEARTBEAT_WINDOWS = {"count_1m": "1 MINUTE", "count_5m": "5 MINUTES", "count_60m": "60 MINUTES"}


def table_heartbeat(tables: dict[str, DataFrame], asof: str, windows: dict[str, str] | None = None) -> DataFrame:
    """Newest timestamp and recent counts of each table, one scan per table."""
    return union_all(*[_heartbeat(df, name, asof, windows or HEARTBEAT_WINDOWS) for name, df in tables.items()])


def symbol_probe(symbols: DataFrame, bt: DataFrame, tr: DataFrame, asof: str, short: str = "5 MINUTES",
                 long: str = "60 MINUTES") -> DataFrame:
    """Newest quote and the recent quote and trade counts per symbol."""
    def counts(df, tag):
        recently = [F.count_if(F.col("ts_exchange") >= X.before(asof, w)).alias(f"{tag}_{n}")
                    for n, w in (("short", short), ("long", long))]
        return df.groupBy("symbol_id").agg(F.max("ts_exchange").alias(f"last_{tag}"), *recently)

    joined = (
        symbols.select(F.col("id").alias("symbol_id"), "symbol")
        .join(counts(bt, "bt"), "symbol_id", "left")
        .join(counts(tr, "tr").drop("last_tr"), "symbol_id", "left")
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("bt_short", "bt_long", "tr_short", "tr_long")]
    return joined.select("symbol", "last_bt", *zero)


def collection_stats(batch: DataFrame, prior: DataFrame | None = None, ts: str = "ts_ingest",
                     key: str = "symbol_id") -> DataFrame:
    """Record counter and last update per symbol, carried on from ``prior``."""
    fresh = batch.groupBy(key).agg(_n().alias("records_count"), F.max(ts).alias("last_update"))
    both = fresh if prior is None else fresh.unionByName(prior.select(*fresh.columns))
    return both.groupBy(key).agg(
        F.sum("records_count").alias("records_count"), F.max("last_update").alias("last_update"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(*[df.agg(_n().alias("records")).select(F.lit(name).alias("table_name"), "records")
                       for name, df in tables.items()])


def system_rollup(symbols: DataFrame, bt: DataFrame, tr: DataFrame, asof: str, interval: str = "1 HOUR",
                  minutes: float = 60.0) -> DataFrame:
    """Symbols in total and with quotes, updates per minute, mean of the symbols' mean latencies."""
    per_symbol = left_recent_join(active_symbols(symbols), recent(bt, asof, interval), recent(tr, asof, interval))
    return per_symbol.agg(
        _n().alias("total_symbols"), F.count_if(F.col("bt_count") > 0).alias("active_symbols"),
        (F.coalesce(F.sum(F.col("bt_count") + F.col("tr_count")), F.lit(0)) / minutes)
        .alias("total_updates_per_minute"),
        F.coalesce(F.avg("avg_latency_ms"), F.lit(0.0)).alias("average_latency_ms"))


def trade_side_balance(tr: DataFrame) -> DataFrame:
    maker = F.count_if(F.col("is_buyer_maker"))
    return tr.agg(
        _n().alias("total_trades"), maker.alias("maker_trades"), F.count_if(~F.col("is_buyer_maker")).alias("taker_trades"),
        F.avg("qty").alias("avg_trade_size"), X.ratio(maker.cast("double"), _n()).alias("maker_ratio"),
        F.count_if(F.col("price") <= 0).alias("invalid_prices"), F.count_if(F.col("qty") <= 0).alias("invalid_quantities"))


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol_id").distinct().orderBy("symbol_id")


def ingestion_stats_hourly(events: DataFrame) -> DataFrame:
    """Processed and failed events and the last latency per hour, symbol and stream.

    Takes ``ts_exchange, ts_ingest, symbol_id, stream_type, event_id, ok``.
    """
    return events.groupBy(F.date_trunc("hour", "ts_exchange").alias("date_hour"), "symbol_id", "stream_type").agg(
        F.count_if("ok").alias("events_processed"), F.count_if(~F.col("ok")).alias("events_failed"),
        F.max_by(_latency(), X.order_in_bucket("ts_exchange", "event_id", "1 hour")).alias("last_latency_ms"))


def ingestion_offsets(events: DataFrame) -> DataFrame:
    """Last update id, event time and processing time per symbol and stream.

    Hours are reduced first in a hash aggregate; what is ordered by (time, id) is one row per hour.
    """
    keys = ["symbol_id", "stream_type"]
    hours = events.groupBy(*keys, X.time_bucket("ts_exchange", "1 hour").alias("_hour")).agg(
        F.max_by("event_id", X.order_in_bucket("ts_exchange", "event_id", "1 hour")).alias("_id"),
        F.max("ts_exchange").alias("_ts"), F.max("ts_ingest").alias("_in"))
    return hours.groupBy(*keys).agg(
        F.max_by("_id", F.col("_ts")).alias("last_update_id"), F.max("_ts").alias("last_event_time"),
        F.max("_in").alias("last_processed_at"))


def volatility_stats(bt: DataFrame, min_rows: int = 100) -> DataFrame:
    sd, mean = F.stddev_samp(X.mid()), F.avg(X.mid())
    return bt.groupBy("symbol_id").agg(
        _n().alias("_n"), sd.alias("price_volatility"), mean.alias("avg_price"),
        (X.ratio(sd, mean) * 100.0).alias("volatility_percent"),
    ).filter(F.col("_n") > min_rows).drop("_n")


def recent_rows(df: DataFrame, n: int, symbol_id: int | None = None, order=("ts_exchange", "update_id")):
    """The newest n rows, of one symbol or of all."""
    picked = df if symbol_id is None else df.filter(F.col("symbol_id") == symbol_id)
    return picked.orderBy(*[F.desc(c) for c in order]).limit(n)


def top_active(bt: DataFrame, n: int = 20, min_rows: int = 100) -> DataFrame:
    rate = update_rate(bt).select("symbol_id", "updates_count", F.col("first_update").alias("first_seen"),
                                  F.col("last_update").alias("last_seen"), "updates_per_second")
    return rate.filter(F.col("updates_count") > min_rows).orderBy(F.desc("updates_count"), "symbol_id").limit(n)


def top_volatile(bt: DataFrame, n: int = 10, min_rows: int = 100) -> DataFrame:
    return volatility_stats(bt, min_rows).orderBy(F.desc("volatility_percent"), "symbol_id").limit(n)


def active_recently(bt: DataFrame, asof: str, interval: str = "5 MINUTES") -> DataFrame:
    return recent(bt, asof, interval).groupBy("symbol_id").agg(
        _n().alias("records"), F.max("ts_exchange").alias("last_update")).orderBy(F.desc("last_update"), "symbol_id")


def ordered_dataset(df: DataFrame, order=("symbol_id", "ts_second")) -> DataFrame:
    """A total order over all partitions: ranges split a hot symbol by time, each range is sorted."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def book_snapshot_asof(topn: DataFrame, at: str, lookback: str | None = None) -> DataFrame:
    """The latest book of every symbol at or before an instant."""
    seen = topn.filter(F.col("ts_exchange") <= X.instant(at))
    if lookback:
        seen = seen.filter(F.col("ts_exchange") >= X.before(at, lookback))
    rest = [c for c in topn.columns if c != "symbol_id"]
    # The newest instants come from two narrow columns; whole books are read for those instants only.
    newest = seen.groupBy("symbol_id").agg(F.max("ts_exchange").alias("ts_exchange"))
    return (
        seen.join(newest, ["symbol_id", "ts_exchange"]).groupBy("symbol_id")
        .agg(F.max_by(F.struct(*rest), F.col("final_update_id")).alias("_book"))
        .select("symbol_id", *[F.col("_book")[c].alias(c) for c in rest])
    )


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def both_sides(de: DataFrame, head: list, bid: str, ask: str, level: str, qty: str) -> DataFrame:
    """``head``, ``side``, ``level`` (from 0), ``price`` and ``qty`` of every level, from one pass over the updates."""
    def tagged(name, column):
        return F.transform(F.coalesce(column, F.array()), lambda v, i: F.struct(
            F.lit(name).alias("side"), i.alias(level), v["price"].alias("price"), v["qty"].alias(qty)))

    return de.select(*head, F.inline(F.concat(tagged(bid, "bids"), tagged(ask, "asks"))))


def depth_to_levels(de: DataFrame) -> DataFrame:
    """One row per side and level of every depth update."""
    head = ["symbol_id", "ts_exchange", "ts_ingest", F.col("final_update_id").alias("update_id")]
    return both_sides(de, head, "bid", "ask", "price_level", "quantity")


def top_updated(bt: DataFrame, symbols: DataFrame, asof: str, interval: str = "60 MINUTES", n: int = 15):
    """Most updated symbols of the recent interval, by name."""
    counts = recent(bt, asof, interval).groupBy("symbol_id").agg(
        _n().alias("updates"), F.max("ts_exchange").alias("last_update_utc"))
    return enrich_symbols(counts, symbols).select("symbol", "updates", "last_update_utc").orderBy(
        F.desc("updates"), "symbol").limit(n)
