"""Row-wise tick columns, filters, and order-dependent tick measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark import functions as X
from tickspark.operators.ordered import TICK_BLOCK, disc_rank, value_ranks, with_previous
from tickspark.schemas import FEATURE_DECIMALS

TICK_ORDER = ["ts_exchange", "update_id"]


def with_spread_mid(bt: DataFrame) -> DataFrame:
    return bt.withColumns({"spread": X.spread(), "mid": X.mid()})


def with_spread_bps(bt: DataFrame) -> DataFrame:
    return bt.withColumn("spread_bps", X.spread_bps())


def with_spread_pct(bt: DataFrame, denominator: str = "mid") -> DataFrame:
    return bt.withColumn("spread_percent", X.spread_pct(denominator))


def with_latency(df: DataFrame) -> DataFrame:
    return df.withColumn("latency_ms", X.elapsed_ms("ts_exchange", "ts_ingest"))


def with_trade_value(tr: DataFrame) -> DataFrame:
    return tr.withColumn("trade_value", X.trade_value())


def with_level_counts(de: DataFrame) -> DataFrame:
    return de.withColumns({"bids_count": X.level_count("bids"), "asks_count": X.level_count("asks")})


def active_symbols(symbols: DataFrame, exchange: str | None = None) -> DataFrame:
    active = symbols.filter("is_active")
    return active if exchange is None else active.filter(F.col("exchange") == exchange)


def time_slice(df: DataFrame, start: str, end: str, ts: str = "ts_exchange") -> DataFrame:
    """Rows in ``[start, end)``; tables with an event_date partition are pruned as well."""
    sliced = df.filter((F.col(ts) >= X.instant(start)) & (F.col(ts) < X.instant(end)))
    if "event_date" in df.columns:
        sliced = sliced.filter(F.col("event_date").between(
            F.lit(X.utc_instant(start).date()), F.lit(X.utc_instant(end).date())))
    return sliced


def day_slice(df: DataFrame, date: str, ts: str = "ts_exchange") -> DataFrame:
    day = F.to_date(F.lit(date))
    sliced = df.filter((F.col(ts) >= day.cast("timestamp")) & (F.col(ts) < F.date_add(day, 1).cast("timestamp")))
    return sliced.filter(F.col("event_date") == day) if "event_date" in df.columns else sliced


def recent(df: DataFrame, asof: str, interval: str, ts: str = "ts_exchange") -> DataFrame:
    """Rows no older than ``interval`` (such as ``"5 MINUTES"``) at the instant ``asof``."""
    start = X.before(asof, interval)
    sliced = df.filter(F.col(ts) >= start)
    return sliced.filter(F.col("event_date") >= F.to_date(start)) if "event_date" in df.columns else sliced


def optional_symbol_filter(df: DataFrame, ids: list[int] | DataFrame | None) -> DataFrame:
    """Rows of the symbols in ``ids``, a short list or a table with ``symbol_id`` for a long one."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select("symbol_id").distinct(), "symbol_id", "left_semi")
    return df if ids is None else df.filter(F.col("symbol_id").isin(ids))


def with_calendar(df: DataFrame, ts: str = "ts_second") -> DataFrame:
    return df.withColumns({
        "timestamp": X.epoch_seconds(ts),
        "hour": F.hour(ts).cast("long"),
        "day_of_week": X.day_of_week(ts).cast("long"),
    })


def decimal_to_double(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema])


def to_feature_decimals(features: DataFrame) -> DataFrame:
    """Cast features to the sink's decimals; a value that does not fit becomes NULL.

    :func:`feature_overflows` lists those values.
    """
    return features.select(*[
        F.col(c).try_cast(T.DecimalType(*FEATURE_DECIMALS[c])).alias(c) if c in FEATURE_DECIMALS else F.col(c)
        for c in features.columns])


def feature_overflows(features: DataFrame, key: list[str]) -> DataFrame:
    """``key``, ``feature`` and ``value`` of every value that :func:`to_feature_decimals` cannot keep."""
    listed = F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
        F.col(c).try_cast(T.DecimalType(*FEATURE_DECIMALS[c])).isNull().alias("lost"))
        for c in features.columns if c in FEATURE_DECIMALS])
    return features.select(*key, F.inline(F.filter(listed, lambda v: v["value"].isNotNull() & v["lost"]))).drop("lost")


def tick_gaps(bt: DataFrame, block: str = TICK_BLOCK) -> DataFrame:
    """Gaps between consecutive ticks per symbol; only symbols with a gap over a minute."""
    us = X.elapsed_us("prev_ts_exchange", "ts_exchange")
    gaps = (
        with_previous(bt.select("symbol_id", *TICK_ORDER), ["symbol_id"], TICK_ORDER, ["ts_exchange"], block)
        .select("symbol_id", (us / 1e6).alias("gap"))
        .filter("gap IS NOT NULL")
    )
    return gaps.groupBy("symbol_id").agg(
        F.count_if(F.col("gap") > 60).alias("gaps_over_1min"),
        F.max("gap").alias("max_gap_seconds"),
        F.avg(F.when(F.col("gap") < 300, F.col("gap"))).alias("avg_gap_seconds"),
    ).filter("gaps_over_1min > 0")


def update_intervals(bt: DataFrame, block: str = TICK_BLOCK) -> DataFrame:
    """Microseconds between consecutive updates of a symbol."""
    return (
        with_previous(bt.select("symbol_id", *TICK_ORDER), ["symbol_id"], TICK_ORDER, ["ts_exchange"], block)
        .select("symbol_id", X.elapsed_us("prev_ts_exchange", "ts_exchange").alias("interval_us"))
        .filter("interval_us IS NOT NULL")
    )


def interval_stats(bt: DataFrame, min_updates: int = 10, top: int | None = 5,
                   block: str = TICK_BLOCK) -> DataFrame:
    """Mean, maximum and discrete p95 of the inter-update time for the most updated symbols."""
    # Equal intervals are counted first; every statistic, the quantile too, comes from the counts.
    counts = value_ranks(update_intervals(bt, block), ["symbol_id"], "interval_us", bin_width=1_000_000)
    times, rank = F.col("hi") - F.col("lo") + 1, disc_rank(0.95)
    stats = counts.groupBy("symbol_id").agg(
        F.sum(times).alias("updates"),
        (F.sum(F.col("interval_us") * times) / F.sum(times) / 1000.0).alias("avg_interval_ms"),
        (F.max("interval_us") / 1000.0).alias("max_interval_ms"),
        (F.max(F.when(F.col("lo") <= rank, F.col("interval_us"))) / 1000.0).alias("p95_interval_ms"),
    ).filter(F.col("updates") > min_updates)
    return stats if top is None else stats.orderBy(F.desc("updates"), "symbol_id").limit(top)


def quote_change_bps(bt: DataFrame, block: str = TICK_BLOCK) -> DataFrame:
    """Microprice, tick imbalance and quote moves in bps against the previous quote."""
    cols = ["symbol_id", *TICK_ORDER, "best_bid", "best_ask", "bid_qty", "ask_qty"]
    quotes = with_previous(bt.select(*cols), ["symbol_id"], TICK_ORDER, ["best_bid", "best_ask"], block)

    def move(now, prev):
        return X.ratio(F.col(now) - F.col(prev), F.col(prev)) * 10000.0

    return quotes.filter("prev_best_bid IS NOT NULL").select(
        "ts_exchange", "symbol_id", "update_id",
        X.microprice().alias("microprice"),
        X.tick_imbalance().alias("ofi"),
        move("best_bid", "prev_best_bid").alias("bid_change_bps"),
        move("best_ask", "prev_best_ask").alias("ask_change_bps"),
        X.microprice_deviation().alias("microprice_deviation"),
    )


def latest_per_symbol(bt: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` most recent quotes of every symbol, newest first.

    The rank filter is pushed below the shuffle, so a map task sends at most n rows per symbol.
    """
    newest = Window.partitionBy("symbol_id").orderBy(F.desc("ts_exchange"), F.desc("update_id"))
    return (
        bt.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= n)
        .select("symbol_id", "recency", "best_bid", "best_ask",
                X.spread().alias("spread"), X.spread_pct("bid").alias("spread_percent"),
                "ts_exchange", "ts_ingest", X.elapsed_ms("ts_exchange", "ts_ingest").alias("latency_ms"))
    )
