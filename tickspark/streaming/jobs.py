"""Continuous bars, deduplication, feed fan-out, heartbeats and alerts."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickspark import functions as X
from tickspark.operators.bars import depth_bars, quote_bars_bidask, quote_bars_mid, trade_bars_ext
from tickspark.operators.joins import market_data_bars
from tickspark.operators.micro import feature_tails, flatten_topn, market_features, split_volume
from tickspark.operators.ticks import time_slice
from tickspark.schemas import KEYS
from tickspark.sources import wire
from tickspark.sources.tables import (
    DATE, day_files, drop_days, export_parquet, is_marked, latest_version, listing_hash, mark_day, scan_ticks, staged, stored_days,
    write_partitioned, write_ticks_idempotent)

LATENESS = "2 hours"
REFRESH = "30 seconds"
VERSION = "batch_id"
BAR_STARTS = ("ts_second", "ts_bucket", "window_start")
# Alert limits per second over the rate window, and the silence that marks staleness.
MIN_ROWS_PER_SECOND = 100.0
MAX_ERRORS_PER_SECOND = 0.1
STALE_SECONDS = 30


def stream_dedup(src: DataFrame, key: list[str], lateness: str = LATENESS, ts: str = "ts_exchange") -> DataFrame:
    """Make at-least-once delivery idempotent: the first row of a key within the watermark stays."""
    return src.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(key)


def stream_bars(src: DataFrame, w: str = "1 second", bars: Callable = quote_bars_mid, lateness: str = LATENESS,
                watermarked: bool = False) -> DataFrame:
    """Windowed bars of a tick stream; rows later than ``lateness`` are left to a refresh."""
    return bars(src if watermarked else src.withWatermark("ts_exchange", lateness), w)


def _start(stream: DataFrame, write: Callable, checkpoint: str, mode: str, every: str | None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(**trigger).start())


def store_bars(bars: DataFrame, path: str, checkpoint: str, every: str | None = REFRESH) -> StreamingQuery:
    """Keep changed bars in a table of versions, one partition per day and micro-batch.

    A replayed batch overwrites its own partitions, so the table is exactly-once without any
    read-modify-write. ``every=None`` drains what is available and stops. :func:`fold_bars` keeps it small.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        start = next(c for c in BAR_STARTS if c in batch.columns)
        (batch.drop("window").withColumns({DATE: F.to_date(start), VERSION: F.lit(batch_id)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(DATE, VERSION).parquet(f"{path}/versions"))

    return _start(bars, write, checkpoint, "update", every)


def _bar_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored versions of bars; folded ones are version -1, older than any batch."""
    parts = [spark.read.parquet(f"{path}/{name}") for name in ("versions", "folded") if stored_days(spark, f"{path}/{name}")]
    parts = [p if VERSION in p.columns else p.withColumn(VERSION, F.lit(-1)) for p in parts]
    return reduce(DataFrame.unionByName, parts) if parts else None


def read_bars(spark: SparkSession, path: str, ts: str = "ts_second", asof: str | None = None, lag: str = "30 SECONDS",
              start: str | None = None, end: str | None = None) -> DataFrame:
    """The newest version of each stored bar; with ``asof`` only bars older than the refresh lag.

    ``start`` and ``end`` (exclusive) prune the days that are read.
    """
    bars = _bar_versions(spark, path)
    if bars is None:
        raise ValueError(f"no bars under {path}")
    if start:
        bars = bars.filter((F.col(ts) >= X.instant(start)) & (F.col(DATE) >= F.lit(X.utc_instant(start).date())))
    if end:
        bars = bars.filter((F.col(ts) < X.instant(end)) & (F.col(DATE) <= F.lit(X.utc_instant(end).date())))
    if asof:
        bars = bars.filter(F.col(ts) <= X.before(asof, lag))
    return latest_version(bars.drop(DATE), [ts, "symbol_id"], VERSION).drop(VERSION)


def fold_bars(spark: SparkSession, path: str, before: str, ts: str = "ts_second", sort: list[str] | None = None) -> list[str]:
    """Fold the versions of days before the day of ``before`` into one sorted partition per day; returns the days.

    Choose ``before`` behind the watermark, so the stream no longer writes those days. The folded days are
    committed first and their versions dropped after; a run that was cut short is repeated with the same result.
    """
    limit = X.utc_instant(before).date().isoformat()
    days = [d for d in stored_days(spark, f"{path}/versions") if d < limit]
    if days:
        bars = _bar_versions(spark, path).filter(F.col(DATE).cast("string").isin(days))
        newest = latest_version(bars, [ts, "symbol_id"], VERSION).drop(VERSION)
        write_partitioned(newest, f"{path}/folded", sort or ["symbol_id", ts], "overwrite", partitionOverwriteMode="dynamic")
        drop_days(spark, f"{path}/versions", days)
    return days


def refresh_bars(spark: SparkSession, ticks: str, bars_path: str, start: str, end: str, w: str = "1 second",
                 bars: Callable = quote_bars_mid, ts: str = "ts_second") -> None:
    """Recompute the bars of the days that ``[start, end)`` touches from the stored ticks."""
    first, last = _whole_days(start, end)
    export_parquet(bars(scan_ticks(spark, ticks, first, last), w), bars_path, ts)


def _whole_days(start: str, end: str) -> tuple[str, str]:
    """The days that ``[start, end)`` touches, as dates with an exclusive end."""
    first = X.utc_instant(start).date()
    last = (X.utc_instant(end) - timedelta(microseconds=1)).date() + timedelta(days=1)
    return first.isoformat(), last.isoformat()


def refresh_topn(spark: SparkSession, depth: str, path: str, start: str, end: str, n: int = 5) -> None:
    """Recompute the flat book of the days that ``[start, end)`` touches from the stored depth updates."""
    export_parquet(flatten_topn(scan_ticks(spark, depth, *_whole_days(start, end)), n), path, "ts_exchange")


def update_feature_tails(spark: SparkSession, bars: str, tails: str, days: list[str], n: int = 10) -> list[str]:
    """Bring the tails of ``days`` of stored joined bars up to date; returns the days that had to be read.

    Tails are, per symbol and day, the last n bars and the last n traded ones: what the features of later days
    look back at, a few thousandths of the bars. A day's tails carry the listing they were made from, so only
    days written since are read again.
    """
    made_from = {day: listing_hash([*day_files(spark, bars, day), ("n", n)]) for day in days}
    stale = [day for day, value in made_from.items() if not is_marked(spark, tails, day, "tails", value)]
    if stale:
        rows = spark.read.parquet(bars).filter(F.col(DATE).isin([date.fromisoformat(d) for d in stale]))
        write_partitioned(feature_tails(rows, [DATE, "symbol_id"], n), tails, ["symbol_id", "ts_bucket"], "overwrite",
                          partitionOverwriteMode="dynamic")
        for day in stale:
            mark_day(spark, tails, day, "tails", made_from[day])
    return stale


def feature_history(spark: SparkSession, bars: str, tails: str, wanted: DataFrame, before: str, n: int = 10) -> DataFrame | None:
    """The last n bars and the last n traded bars before the day ``before`` of each symbol in ``wanted(symbol_id)``.

    Goes back over the days' tails, twice as many days each time, until every symbol has both or the days end. A symbol
    that trades seldom, or is new, costs the reading of older tails, never of older bars.
    """
    days = [d for d in reversed(stored_days(spark, bars)) if d < before]
    symbols = wanted.select(F.col("symbol_id").alias("_wanted")).distinct()
    reach = 1
    while days:
        update_feature_tails(spark, bars, tails, days[:reach], n)
        oldest = date.fromisoformat(days[:reach][-1])
        rows = spark.read.parquet(tails).filter((F.col(DATE) >= F.lit(oldest)) & (F.col(DATE) < F.lit(date.fromisoformat(before))))
        found = feature_tails(rows.drop(DATE).join(symbols, F.col("symbol_id").eqNullSafe(F.col("_wanted")), "left_semi"), ["symbol_id"], n)
        if reach >= len(days):
            return found
        traded = split_volume(found).withColumn("_traded", F.col("buy_volume") + F.col("sell_volume") > 0)
        counts = traded.groupBy("symbol_id").agg(F.count(F.lit(1)).alias("_n"), F.count_if("_traded").alias("_t"))
        short = symbols.join(counts, F.col("symbol_id").eqNullSafe(F.col("_wanted")), "left").filter(
            (F.coalesce("_n", F.lit(0)) < n) | (F.coalesce("_t", F.lit(0)) < n))
        if short.isEmpty():
            return found
        reach *= 2
    return None


def refresh_features(spark: SparkSession, bars: str, path: str, start: str, end: str, n: int = 10, tails: str | None = None) -> None:
    """Recompute the features of the days that ``[start, end)`` touches from the stored joined bars.

    Features look back a number of rows, however far that is in time: see :func:`feature_history`. The tails are kept
    beside the bars, or in ``tails``.
    """
    first, last = _whole_days(start, end)
    fresh = scan_ticks(spark, bars, first, last, ts="ts_bucket").drop(DATE)
    older = feature_history(spark, bars, tails or f"{bars.rstrip('/')}_tails", fresh, first, n)
    history = fresh if older is None else fresh.unionByName(older)
    export_parquet(time_slice(market_features(history, n), first, last), path, "ts_exchange")


def stream_market_data(bt: DataFrame, tr: DataFrame, de: DataFrame, root: str, w: str = "1 second",
                       every: str | None = REFRESH) -> list[StreamingQuery]:
    """Keep the quote, trade and depth bars of three feeds; read them with :func:`read_market_data`."""
    feeds = {"quotes": (bt, quote_bars_bidask), "trades": (tr, trade_bars_ext), "depth": (de, depth_bars)}
    return [store_bars(stream_bars(src, w, bars), f"{root}/{name}", f"{root}/_checkpoint/{name}", every)
            for name, (src, bars) in feeds.items()]


def read_market_data(spark: SparkSession, root: str, asof: str | None = None) -> DataFrame:
    """The joined bars over the stored ones."""
    return market_data_bars(*[read_bars(spark, f"{root}/{name}", "ts_bucket", asof)
                              for name in ("quotes", "trades", "depth")])


def stream_joined_bars(bt: DataFrame, tr: DataFrame, w: str = "1 second", lateness: str = LATENESS) -> DataFrame:
    """Quote bars left-joined with trade bars inside one stream.

    Append mode: a bar appears once the watermark has passed it, with or without a trade bar.
    """
    q = stream_bars(bt, w, quote_bars_bidask, lateness).drop("ts_bucket")
    t = stream_bars(tr, w, trade_bars_ext, lateness).select(
        F.col("window"), F.col("symbol_id"), "price_close", "volume", "trade_count", "vwap")
    return q.join(t, ["window", "symbol_id"], "left").withColumn("ts_bucket", F.col("window.start"))


def registered_symbols(spark: SparkSession, symbols: DataFrame, root: str, before: int | None = None) -> DataFrame:
    """``symbols`` and those that an ingest into ``root`` has added (by batches ``before`` a number)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/symbols")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return symbols
    added = spark.read.schema(f"id bigint, symbol string, {VERSION} bigint").parquet(f"{root}/symbols")
    added = added if before is None else added.filter(F.col(VERSION) < before)
    return symbols.select("id", "symbol").unionByName(added.select(F.col("id").cast(symbols.schema["id"].dataType), "symbol"))


def stream_ingest(messages: DataFrame, symbols: DataFrame, root: str, checkpoint: str,
                  every: str | None = "10 seconds", time_field: str = "E", exchange: str = "feed") -> StreamingQuery:
    """Fan one feed out into the three fact tables, a table of added symbols and a table of rejects.

    Symbols not listed yet are registered before their rows are written, in a partition of the batch. Each batch
    is parsed and written idempotently by key, so replays after a failure add nothing. Every message is either in a
    fact table or, with a reason, among the rejects. The checkpoint takes the place of in-memory
    buffers: stopping loses no message.
    """
    parsers = {
        "book_ticker": wire.parse_book_ticker,
        "trades": lambda env: wire.parse_agg_trade(env, time_field),
        "depth_events": wire.parse_depth,
    }

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with ExitStack() as stages:  # everything below reads what was parsed once, and leaves nothing behind
            held = lambda df: stages.enter_context(staged(df, root))
            env = held(wire.read_envelope(batch))
            parsed = {table: held(parse(env)) for table, parse in parsers.items()}
            seen = reduce(DataFrame.unionByName, [wire.accepted(p).select("symbol") for p in parsed.values()])
            known = registered_symbols(spark, symbols, root, batch_id)
            added = wire.new_symbols(seen, known, exchange)
            (added.withColumn("id", F.col("id").cast("bigint")).withColumn(VERSION, F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(VERSION).parquet(f"{root}/symbols"))
            listed = registered_symbols(spark, symbols, root, batch_id + 1)
            bad = wire.unrouted(env).withColumn("table_name", F.lit(None).cast("string"))
            for table, rows in parsed.items():
                write_ticks_idempotent(wire.attach_symbol_id(wire.accepted(rows), listed), f"{root}/{table}", KEYS[table])
                bad = bad.unionByName(wire.rejected(rows).withColumn("table_name", F.lit(table)))
            (bad.withColumn(VERSION, F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(VERSION).parquet(f"{root}/rejects"))

    return _start(messages, write, checkpoint, "append", every)


def stream_heartbeat(src: DataFrame, w: str = "1 minute", lateness: str = LATENESS,
                     by: list[str] | None = None) -> DataFrame:
    """Message counts and the last message time per window and shard or symbol."""
    by = by or ["symbol_id"]
    counts = src.withWatermark("ts_exchange", lateness).groupBy(F.window("ts_exchange", w).alias("window"), *by).agg(
        F.count(F.lit(1)).alias("messages"), F.max("ts_exchange").alias("last_message"))
    return counts.withColumn("window_start", F.col("window.start"))


def heartbeat_status(beats: DataFrame, asof: str, by: list[str] | None = None,
                     stale_seconds: float = STALE_SECONDS) -> DataFrame:
    """Totals per shard or symbol; stale after ``stale_seconds`` without a message."""
    lag = X.elapsed_seconds("last_message", X.instant(asof))
    return (
        beats.groupBy(*(by or ["symbol_id"]))
        .agg(F.sum("messages").alias("messages"), F.max("last_message").alias("last_message"))
        .withColumn("lag_seconds", lag)
        .withColumn("status", F.when(F.col("lag_seconds") < stale_seconds, "OK").otherwise("STALE"))
    )


def ingest_rates(events: DataFrame, length: str = "5 minutes", slide: str = "1 minute",
                 lateness: str = LATENESS) -> DataFrame:
    """Rows and errors per second over sliding windows, from ``ts_exchange`` and ``ok``."""
    src = events.withWatermark("ts_exchange", lateness) if events.isStreaming else events
    seconds = X.width_us(length) / 1e6
    return src.groupBy(F.window("ts_exchange", length, slide).alias("window")).agg(
        (F.count_if("ok") / seconds).alias("rows_per_second"),
        (F.count_if(~F.col("ok")) / seconds).alias("errors_per_second"),
    ).select(F.col("window"), F.col("window.start").alias("window_start"), "rows_per_second", "errors_per_second")


def with_silent_windows(rates: DataFrame, asof: str | None = None, slide: str = "1 minute") -> DataFrame:
    """Stored rates with a row of zeros for every window in which nothing came, from the first window to the last
    one, or to the last that starts before ``asof``."""
    ends = rates.agg(F.min("window_start").alias("first"), F.max("window_start").alias("last"))
    last = F.col("last") if asof is None else X.time_bucket(X.instant(asof), slide)
    step = F.make_dt_interval(secs=F.lit(X.width_us(slide) / 1e6))
    grid = ends.filter("first IS NOT NULL").select(F.explode(F.sequence("first", last, step)).alias("window_start"))
    filled = grid.join(rates.drop("window"), "window_start", "left")
    return filled.select("window_start", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("rows_per_second", "errors_per_second")])


def low_ingest_alert(rates: DataFrame, min_rows: float = MIN_ROWS_PER_SECOND, max_errors: float = MAX_ERRORS_PER_SECOND,
                     hold: int = 1, slide: str = "1 minute") -> DataFrame:
    """Windows in which too few rows arrived or too many failed.

    With ``hold``, only where the same limit was broken in that many windows in a row. Silence is seen in rates that
    went through :func:`with_silent_windows`.
    """
    flagged = rates.withColumns({
        "low_ingest": F.col("rows_per_second") < min_rows,
        "high_errors": F.col("errors_per_second") > max_errors,
    })
    if hold > 1:
        # A window within limits clears itself and the ones that would need it; so do those before the first.
        steps = F.sequence(F.lit(0), F.lit(hold - 1))
        step = X.width_us(slide)
        start = F.unix_micros("window_start")
        for flag in ("low_ingest", "high_errors"):
            good = flagged.filter(~F.col(flag)).select(start.alias("_at"))
            early = flagged.agg((F.min(start) - step).alias("_at")).filter("_at IS NOT NULL")
            cleared = good.unionByName(early).select(F.explode(F.transform(steps, lambda i: F.col("_at") + i * step)).alias("_cleared")).distinct()
            flagged = flagged.withColumn("_start", start).join(cleared, F.col("_start") == F.col("_cleared"), "left").withColumn(
                flag, F.col(flag) & F.col("_cleared").isNull()).drop("_start", "_cleared")
    return flagged.filter("low_ingest OR high_errors")
