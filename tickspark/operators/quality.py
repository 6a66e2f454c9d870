"""Data quality and ingestion health.

Checks return one row per test with ``test_name, passed, severity, actual``; ``severity`` is
``info`` for a passed test, else ``error`` or ``warning``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark import functions as X
from tickspark.operators.joins import enrich_symbols, left_recent_join
from tickspark.operators.ordered import ranked_quantile, value_ranks
from tickspark.operators.profile import trade_side_balance, union_all
from tickspark.operators.ticks import active_symbols, interval_stats, recent

# Limits of the checks.
MIN_RECORDS = 1000
STALE_MINUTES = 10.0
MAX_SPREAD_PERCENT = 1.0
MAKER_RATIO = (0.3, 0.7)
CADENCE_MS = 100.0
ERROR_PENALTY = 10
WARNING_PENALTY = 3

NUMERIC = (T.DoubleType, T.DecimalType, T.FloatType)


def _result(name: Column, passed: Column, severity: str, actual: Column) -> Column:
    return F.struct(name.alias("test_name"), passed.alias("passed"),
                    F.when(passed, "info").otherwise(severity).alias("severity"),
                    actual.cast("string").alias("actual"))


def _results(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*rows)))


def schema_conformance(df: DataFrame, table: str, required: dict[str, str | None]) -> DataFrame:
    """Presence, numeric type, NULL counts and cast failures of the required columns.

    ``required`` maps a column to the type its values must cast to, or to None. One aggregation
    counts everything; what the schema alone decides is a literal in the plan.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    aggs, rows = [F.lit(0).alias("_")], []
    for column, cast in required.items():
        name = F.lit(f"{table}.{column}")
        present = column in kinds
        rows.append(_result(F.concat(F.lit("present: "), name), F.lit(present), "error", F.lit(present)))
        if not present:
            continue
        nulls, broken = f"_null_{column}", f"_cast_{column}"
        aggs.append(F.count_if(F.col(column).isNull()).alias(nulls))
        rows.append(_result(F.concat(F.lit("no nulls: "), name), F.col(nulls) == 0, "warning", F.col(nulls)))
        if cast:
            numeric = isinstance(kinds[column], NUMERIC)
            aggs.append(F.count_if(F.col(column).isNotNull() & F.col(column).try_cast(cast).isNull()).alias(broken))
            rows.append(_result(F.concat(F.lit("numeric: "), name), F.lit(numeric), "warning", F.lit(numeric)))
            rows.append(_result(F.concat(F.lit("castable: "), name), F.col(broken) == 0, "warning", F.col(broken)))
    return _results(df.agg(*aggs), rows)


def _recent_totals(df: DataFrame, asof: str, interval: str, ts: str = "ts_exchange") -> DataFrame:
    return recent(df, asof, interval, ts).agg(F.max(ts).alias("last"), F.count(F.lit(1)).alias("n"))


def freshness_check(df: DataFrame, table: str, asof: str, interval: str = "1 HOUR",
                    stale_minutes: float = STALE_MINUTES) -> DataFrame:
    """Error without rows in the interval, warning when the newest row is too old."""
    age = X.elapsed_seconds("last", X.instant(asof)) / 60.0
    severity = F.when(F.col("last").isNull(), "error").when(age > stale_minutes, "warning").otherwise("info")
    return _recent_totals(df, asof, interval).select(
        F.lit(f"freshness: {table}").alias("test_name"), (severity == "info").alias("passed"),
        severity.alias("severity"), F.round(age, 1).cast("string").alias("actual"))


def volume_check(df: DataFrame, table: str, asof: str, interval: str = "1 HOUR",
                 minimum: int = MIN_RECORDS) -> DataFrame:
    totals = _recent_totals(df, asof, interval)
    return _results(totals, [_result(F.lit(f"volume: {table}"), F.col("n") >= minimum, "warning", F.col("n"))])


def freshness_label(bt: DataFrame, asof: str) -> DataFrame:
    """FRESH up to 5 minutes, STALE up to 15, then OLD, by the newest quote of each symbol."""
    minutes = X.elapsed_seconds("last_update", X.instant(asof)) / 60.0
    return bt.groupBy("symbol_id").agg(F.max("ts_exchange").alias("last_update")).select(
        "symbol_id", "last_update", minutes.alias("minutes_since_last_update"),
        F.when(minutes <= 5, "FRESH").when(minutes <= 15, "STALE").otherwise("OLD").alias("data_status"))


def _bad_counts(counts: dict[str, Column]) -> list[Column]:
    return [F.count_if(cond).alias(name) for name, cond in counts.items()]


def quote_quality(symbols: DataFrame, bt: DataFrame) -> DataFrame:
    """Counts of invalid values per active symbol; symbols without quotes count 0."""
    bad = {
        "invalid_bid_price": F.col("best_bid") <= 0, "invalid_ask_price": F.col("best_ask") <= 0,
        "invalid_bid_qty": F.col("bid_qty") <= 0, "invalid_ask_qty": F.col("ask_qty") <= 0,
        "invalid_spread": X.spread() <= 0, "invalid_latency": F.col("ts_ingest") < F.col("ts_exchange"),
    }
    counts = bt.groupBy("symbol_id").agg(F.count(F.lit(1)).alias("total_records"), *_bad_counts(bad))
    return (
        active_symbols(symbols).select(F.col("id").alias("symbol_id"), "symbol").join(counts, "symbol_id", "left")
        .select("symbol", *[F.coalesce(c, F.lit(0)).alias(c) for c in ["total_records", *bad]])
    )


def quote_quality_ext(bt: DataFrame) -> DataFrame:
    bad = {
        "null_prices": F.col("best_bid").isNull() | F.col("best_ask").isNull(),
        "invalid_prices": (F.col("best_bid") <= 0) | (F.col("best_ask") <= 0),
        "inverted_spread": F.col("best_bid") >= F.col("best_ask"),
        "wide_spread": X.spread() > F.col("best_ask") * 0.01,
    }
    return bt.groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("total_records"), *_bad_counts(bad), F.avg(X.spread()).alias("avg_spread"),
        F.stddev_samp(X.spread()).alias("spread_volatility"), F.avg(X.spread_pct("ask")).alias("avg_spread_percent"))


def spread_quality(bt: DataFrame, top: int | None = 10) -> DataFrame:
    """Spread of the mid in percent and invalid counts of the most quoted symbols."""
    pct = X.spread_pct("mid")
    bad = {
        "invalid_prices": (F.col("best_bid") <= 0) | (F.col("best_ask") <= 0),
        "invalid_quantities": (F.col("bid_qty") <= 0) | (F.col("ask_qty") <= 0),
        "inverted_spread": F.col("best_ask") <= F.col("best_bid"),
    }
    stats = bt.groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("records"), F.avg(pct).alias("avg_spread_percent"),
        F.max(pct).alias("max_spread_percent"), *_bad_counts(bad))
    return stats if top is None else stats.orderBy(F.desc("records"), "symbol_id").limit(top)


def spread_quality_results(bt: DataFrame, top: int | None = 10, limit: float = MAX_SPREAD_PERCENT) -> DataFrame:
    sid = F.col("symbol_id").cast("string")
    worst = F.coalesce("max_spread_percent", F.lit(0.0))
    return _results(spread_quality(bt, top), [
        _result(F.concat(F.lit("spread: "), sid), worst <= limit, "warning", F.round(worst, 3)),
        _result(F.concat(F.lit("prices: "), sid), F.col("invalid_prices") == 0, "error", F.col("invalid_prices")),
        _result(F.concat(F.lit("direction: "), sid), F.col("inverted_spread") == 0, "error", F.col("inverted_spread")),
    ])


def trade_quality_results(tr: DataFrame) -> DataFrame:
    low, high = MAKER_RATIO
    bad = F.col("invalid_prices") + F.col("invalid_quantities")
    return _results(trade_side_balance(tr).filter("total_trades > 0"), [
        _result(F.lit("maker balance"), F.col("maker_ratio").between(low, high), "warning",
                F.round("maker_ratio", 4)),
        _result(F.lit("trade values"), bad == 0, "error", bad),
    ])


def cadence_results(bt: DataFrame, limit_ms: float = CADENCE_MS, min_updates: int = 10,
                    top: int | None = 5) -> DataFrame:
    """Mean interval against the limit; the p95 row appears only where it exceeds 3 limits."""
    sid = F.col("symbol_id").cast("string")
    p95 = F.col("p95_interval_ms")
    rows = _results(interval_stats(bt, min_updates, top), [
        _result(F.concat(F.lit("cadence: "), sid), F.col("avg_interval_ms") <= limit_ms, "warning",
                F.round("avg_interval_ms", 1)),
        F.when(p95 > 3 * limit_ms, _result(F.concat(F.lit("cadence p95: "), sid), F.lit(False), "warning",
                                           F.round(p95, 1))),
    ])
    return rows.filter("test_name IS NOT NULL")


def aggregate_coverage(bars: dict[str, DataFrame], asof: str, interval: str = "1 HOUR", ts: str = "ts_bucket"):
    """Every expected bar table has a bar in the interval."""
    return union_all(*[
        _results(_recent_totals(df, asof, interval, ts),
                 [_result(F.lit(f"bars: {name}"), F.col("n") > 0, "warning", F.col("n"))])
        for name, df in bars.items()])


def quality_report(results: DataFrame) -> DataFrame:
    """Totals and the score, which falls with errors and, less, with warnings."""
    failed = ~F.col("passed")
    errors = F.count_if(failed & (F.col("severity") == "error"))
    warnings = F.count_if(failed & (F.col("severity") == "warning"))
    score = F.greatest(F.lit(0), F.lit(100) - errors * ERROR_PENALTY - warnings * WARNING_PENALTY)
    return results.agg(
        F.count(F.lit(1)).alias("total_tests"), F.count_if("passed").alias("passed_tests"),
        errors.alias("failed_tests"), warnings.alias("warnings"),
        F.when(F.count(F.lit(1)) > 0, score).otherwise(0).cast("double").alias("overall_score"))


def symbol_health(symbols: DataFrame, bt: DataFrame, tr: DataFrame, asof: str, interval: str = "1 HOUR",
                  stale_seconds: float = 300, max_invalid: int = 10, max_latency_ms: float = 1000) -> DataFrame:
    """Three health rules per symbol; high latency outranks invalid spreads, which outrank staleness.

    Every measure of the quotes, the exact p95 latency too, comes from the counts of equal latencies: one reading.
    """
    quotes = recent(bt, asof, interval).filter("symbol_id IS NOT NULL").withColumn("us", X.elapsed_us("ts_exchange", "ts_ingest"))
    ranks = value_ranks(quotes, ["symbol_id"], "us", 65_536, with_null=True, also={
        "_rows": F.count(F.lit(1)), "_last": F.max("ts_exchange"), "_spreads": F.count_if(X.spread() <= 0),
        "_prices": F.count_if((F.col("best_bid") <= 0) | (F.col("best_ask") <= 0))})
    times = F.when(F.col("us").isNotNull(), F.col("_rows"))
    measured = ranks.groupBy("symbol_id").agg(
        F.sum("_rows").alias("bt_count"), F.max("_last").alias("last_bt"), F.sum("_spreads").alias("invalid_spreads"),
        F.sum("_prices").alias("invalid_prices"), (F.max("us") / 1000.0).alias("max_latency_ms"),
        (F.sum(F.col("us") * times) / F.sum(times) / 1000.0).alias("avg_latency_ms"),
        (ranked_quantile("us", 0.95) / 1000.0).alias("p95_latency_ms"))
    trades = recent(tr, asof, interval).groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("tr_count"), F.max("ts_exchange").alias("last_tr"))
    base = (
        symbols.select(F.col("id").alias("symbol_id"), "symbol")
        .join(measured, "symbol_id", "left").join(trades, "symbol_id", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("bt_count", "tr_count")}))
    age = X.elapsed_seconds("last_bt", X.instant(asof))
    latency = F.coalesce("avg_latency_ms", F.lit(0.0))
    invalid = F.coalesce("invalid_spreads", F.lit(0))
    status = (
        F.when(latency > max_latency_ms, "High latency")
        .when(invalid > max_invalid, "High invalid spreads")
        .when(F.col("last_bt").isNull(), "No data")
        .when(age > stale_seconds, "No updates")
        .otherwise("OK")
    )
    return base.select(
        "symbol", F.col("bt_count").alias("book_ticker_count"), F.col("tr_count").alias("trades_count"),
        F.col("last_bt").alias("last_book_ticker"), F.col("last_tr").alias("last_trade"),
        latency.alias("avg_latency_ms"), F.coalesce("max_latency_ms", F.lit(0.0)).alias("max_latency_ms"),
        F.coalesce("p95_latency_ms", F.lit(0.0)).alias("p95_latency_ms"),
        invalid.alias("invalid_spreads"), F.coalesce("invalid_prices", F.lit(0)).alias("invalid_prices"),
        (status == "OK").alias("is_healthy"), status.alias("status_message"))


def ingestion_health(symbols: DataFrame, offsets_with_stats: DataFrame, asof: str) -> DataFrame:
    """Seconds since the last processed event per active symbol and stream."""
    return enrich_symbols(offsets_with_stats, active_symbols(symbols)).select(
        "symbol", "stream_type", "last_event_time", "last_processed_at",
        X.elapsed_seconds("last_processed_at", X.instant(asof)).alias("seconds_since_last"),
        "events_processed", "events_failed", "last_latency_ms")


def verify_ingestion(tables: dict[str, DataFrame], asof: str, required: list[str], max_age_seconds: float = 60,
                     min_rows: int = 10, window: str = "1 MINUTE") -> DataFrame:
    """Freshness and rate of each table, and whether all required tables pass."""
    def one(name, df):
        age = F.floor(X.elapsed_seconds(F.max("ts_exchange"), X.instant(asof)))
        count = F.count_if(F.col("ts_exchange") >= X.before(asof, window))
        return df.agg(age.alias("fresh_seconds"), count.alias("count_recent")).select(
            F.lit(name).alias("table_name"), "fresh_seconds", "count_recent",
            F.coalesce(F.col("fresh_seconds") <= max_age_seconds, F.lit(False)).alias("fresh_ok"),
            (F.col("count_recent") >= min_rows).alias("rate_ok"))

    checks = union_all(*[one(name, df) for name, df in tables.items()])
    needed = F.col("table_name").isin(required)
    ok = F.bool_and(~needed | (F.col("fresh_ok") & F.col("rate_ok")))
    rows = F.collect_list(F.struct(*checks.columns))  # one row per table
    return checks.agg(rows.alias("_rows"), ok.alias("overall_ok")).select(F.inline("_rows"), "overall_ok")


def check_freshness(symbols: DataFrame, bt: DataFrame, tr: DataFrame, asof: str, interval: str = "1 HOUR"):
    joined = left_recent_join(active_symbols(symbols), recent(bt, asof, interval), recent(tr, asof, interval))
    return joined.select(
        "symbol", F.col("last_bt").alias("last_book_ticker"), F.col("last_tr").alias("last_trade"),
        F.col("bt_count").alias("bt_count_1h"), F.col("tr_count").alias("trade_count_1h"),
        X.elapsed_seconds("last_bt", X.instant(asof)).alias("seconds_since_last_bt"))


def key_uniqueness(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys stored more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def symbol_universe_check(symbols: DataFrame, facts: DataFrame, expected: int, quote_suffix: str,
                          tiers: DataFrame) -> DataFrame:
    """Findings about the symbol list: one row per rule with the number of offending symbols."""
    listed = symbols.select("id", "symbol")
    traded = facts.groupBy("symbol_id").agg(F.lit(True).alias("_t")).select(F.col("symbol_id").alias("id"))
    n = F.count(F.lit(1))

    def finding(df: DataFrame, rule: str, count: Column = n) -> DataFrame:
        return df.agg(count.cast("long").alias("offending")).select(F.lit(rule).alias("rule"), "offending")

    return union_all(
        finding(listed.groupBy("symbol").agg(n.alias("_n")).filter("_n > 1"), "duplicate"),
        finding(listed, "expected count", F.abs(n - expected)),
        finding(listed.filter(F.col("symbol") != F.upper("symbol")), "not upper case"),
        finding(listed.filter(~F.col("symbol").endswith(quote_suffix)), "wrong quote suffix"),
        finding(listed.join(tiers.select("symbol"), "symbol", "left_anti"), "without tier"),
        finding(traded.join(listed, "id", "left_anti"), "traded but not listed"),
        finding(listed.join(traded, "id", "left_anti"), "listed but never traded"),
    ).withColumn("passed", F.col("offending") == 0)


def rejects_summary(messages: DataFrame) -> DataFrame:
    """Processed and rejected messages and the error rate, from a ``reject_reason`` column."""
    bad = F.count(F.col("reject_reason"))
    return messages.agg(
        (F.count(F.lit(1)) - bad).alias("processed_count"), bad.alias("error_count"),
        (bad / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("error_rate"))
