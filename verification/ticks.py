"""P, F, O, U and raw-tick W queries."""

from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators import bars as B
from tickspark.operators import micro as M
from tickspark.operators import profile as P
from tickspark.operators import ticks as K
from tickspark.plans.datasets import symbol_metadata
from verification.registry import ASOF, D, DAY, H, LAT, MICRO, RECENT, bucket, query

QUOTE = "best_bid best_ask bid_qty ask_qty"


@query("p1_with_spread_mid", "SELECT * FROM quotes", dbl=QUOTE + " spread mid")
def _(m):
    return K.with_spread_mid(m.bt)


@query("p2_spread_bps", "SELECT *, CASE WHEN (best_bid + best_ask) / 2 > 0 THEN (best_ask - best_bid) / "
       "((best_bid + best_ask) / 2) * 10000 END AS spread_bps FROM book_ticker", dbl=QUOTE + " spread_bps")
def _(m):
    return K.with_spread_bps(m.bt)


@query("p3_spread_pct", """SELECT update_id, spread / nullif(mid, 0) * 100 AS of_mid, spread / nullif(best_ask, 0) * 100
       AS of_ask, spread / nullif(best_bid, 0) * 100 AS of_bid FROM quotes""", dbl="of_mid of_ask of_bid")
def _(m):
    return m.bt.select("update_id", *[X.spread_pct(d).alias(f"of_{d}") for d in ("mid", "ask", "bid")])


@query("p4_latency_ms", f"SELECT update_id, {LAT} AS latency_ms FROM book_ticker", dbl="latency_ms")
def _(m):
    return K.with_latency(m.bt).select("update_id", "latency_ms")


@query("p5_trade_value", "SELECT *, price * qty AS trade_value FROM trades", dbl="price qty trade_value")
def _(m):
    return K.with_trade_value(m.tr)


@query("p6_level_counts", """SELECT final_update_id, symbol_id, count(*) FILTER (WHERE side = 'b') AS bids_count,
       count(*) FILTER (WHERE side = 'a') AS asks_count FROM levels GROUP BY 1, 2""")
def _(m):
    return K.with_level_counts(m.de).select("final_update_id", "symbol_id", "bids_count", "asks_count")


@query("p7_active_symbols", "SELECT * FROM active")
def _(m):
    return K.active_symbols(m.symbols)


@query("p8_day_slice", f"SELECT * FROM book_ticker WHERE ts_exchange >= TIMESTAMP '{DAY}' AND ts_exchange < "
       f"TIMESTAMP '{DAY}' + INTERVAL 1 DAY", dbl=QUOTE)
def _(m):
    return K.day_slice(m.bt, DAY)


@query("p9_recent", "SELECT * EXCLUDE (spread, mid) FROM recent_bt", dbl=QUOTE)
def _(m):
    return K.recent(m.bt, ASOF, RECENT)


@query("p10_optional_symbol_filter", """SELECT 'all' AS mode, symbol_id, count(*) AS n FROM book_ticker GROUP BY 2
       UNION ALL SELECT 'listed', symbol_id, count(*) FROM book_ticker WHERE symbol_id IN (2, 3, 5, 7) GROUP BY 2""")
def _(m):
    def counted(ids, mode):
        return K.optional_symbol_filter(m.bt, ids).groupBy("symbol_id").count().select(
            F.lit(mode).alias("mode"), "symbol_id", F.col("count").alias("n"))

    return P.union_all(counted(None, "all"), counted([2, 3, 5, 7], "listed"))


@query("p11_calendar_cols", """SELECT ts_second, symbol_id, epoch_us(ts_second) / 1000000 AS timestamp,
       hour(ts_second) AS hour, dayofweek(ts_second) AS day_of_week FROM bt_hour""", dbl="timestamp",
       big="hour day_of_week")
def _(m):
    return K.with_calendar(B.quote_bars_mid(m.bt, "1 hour")).select(
        "ts_second", "symbol_id", "timestamp", "hour", "day_of_week")


@query("f1_time_bucket", f"""SELECT event_id, {bucket(100_000)} AS tenth, {bucket(7_000_000)} AS seven_seconds,
       {bucket(H)} AS one_hour, {bucket(D)} AS one_day FROM keyed""")
def _(m):
    widths = {"tenth": "100 milliseconds", "seven_seconds": "7 seconds", "one_hour": "1 hour", "one_day": "1 day"}
    return m.events.select("event_id", *[X.time_bucket("ts", w).alias(n) for n, w in widths.items()])


@query("f2_date_trunc", "SELECT event_id, date_trunc('day', ts) AS day, date_trunc('hour', ts) AS hour FROM ev")
def _(m):
    return m.events.select("event_id", F.date_trunc("day", "ts").alias("day"), F.date_trunc("hour", "ts").alias("hour"))


@query("f3_extract", """SELECT event_id, epoch_us(ts) / 1000000.0E0 AS epoch, hour(ts) AS hour, dayofweek(ts) AS dow
       FROM ev""", dbl="epoch", big="hour dow")
def _(m):
    return m.events.select("event_id", X.epoch_seconds("ts").alias("epoch"), F.hour("ts").alias("hour"),
                           X.day_of_week("ts").alias("dow"))


@query("f4_elapsed_ms", """SELECT event_id, (epoch_us(ts_ingest) - epoch_us(ts_exchange)) / 1000.0E0 AS ms,
       (epoch_us(ts_ingest) - epoch_us(ts_exchange)) / 1000000.0E0 AS seconds FROM keyed""", dbl="ms seconds")
def _(m):
    return m.events.select("event_id", X.elapsed_ms("ts", "ts_ingest").alias("ms"),
                           X.elapsed_seconds("ts", "ts_ingest").alias("seconds"))


@query("f5_from_epoch_ms", "SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts_ms FROM ev")
def _(m):
    return m.events.select("event_id", X.from_epoch_ms(F.unix_millis("ts")).alias("ts_ms"))


@query("f6_conditionals", """SELECT update_id, spread / nullif(bid_qty, 0) AS per_qty,
       coalesce(nullif(ask_qty, 0), -1) AS qty_or_minus_one,
       CASE WHEN spread > 0 THEN 'open' WHEN spread = 0 THEN 'locked' ELSE 'crossed' END AS state FROM quotes""",
       dbl="per_qty qty_or_minus_one")
def _(m):
    s = X.spread()
    return m.bt.select(
        "update_id", X.ratio(s, F.col("bid_qty")).alias("per_qty"),
        F.coalesce(F.nullif("ask_qty", F.lit(0.0)), F.lit(-1.0)).alias("qty_or_minus_one"),
        F.when(s > 0, "open").when(s == 0, "locked").otherwise("crossed").alias("state"))


@query("f7_base_asset", "SELECT id, symbol || 'USDT' AS pair, split_part(symbol || 'USDT', 'USDT', 1) AS base_asset "
       "FROM symbols")
def _(m):
    pairs = m.symbols.select("id", F.concat("symbol", F.lit("USDT")).alias("pair"))
    return pairs.withColumn("base_asset", X.base_asset("pair"))


@query("f8_stream_symbol", """SELECT event_id, upper(regexp_extract(stream, '^([^@]+)@', 1)) AS symbol,
       contains(stream, '@aggTrade') AS is_trade, replace(stream, '@', '/') AS path FROM (
       SELECT event_id, 'nation_' || symbol_id || '@' || stream_type AS stream FROM log)""")
def _(m):
    s = m.ingest_log.select("event_id", F.concat(F.lit("nation_"), F.col("symbol_id").cast("string"), F.lit("@"),
                                                 "stream_type").alias("stream"))
    return s.select("event_id", X.stream_symbol().alias("symbol"), F.col("stream").contains("@aggTrade").alias("is_trade"),
                    F.replace("stream", F.lit("@"), F.lit("/")).alias("path"))


@query("f9_json_path", "SELECT event_id, k FROM ev")
def _(m):
    return m.table("events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("f10_array_length", """SELECT final_update_id, count(*) AS bids, sum(qty) AS bid_qty FROM levels
       WHERE side = 'b' GROUP BY 1""", dbl="bid_qty")
def _(m):
    return m.de.select("final_update_id", F.size("bids").alias("bids"), X.side_qty("bids").alias("bid_qty"))


@query("f11_math", """SELECT update_id, abs(spread) AS abs_spread, CASE WHEN best_bid > 0 THEN ln(best_bid) END AS log_bid, round(best_bid, 1) AS r1,
       sign(best_ask - best_bid) AS s FROM quotes""", dbl="abs_spread log_bid r1 s")
def _(m):
    return m.bt.select("update_id", F.abs(X.spread()).alias("abs_spread"), F.ln("best_bid").alias("log_bid"),
                       F.round("best_bid", 1).alias("r1"), F.signum(X.spread()).alias("s"))


@query("f12_filtered_aggregates", """SELECT symbol_id, count(*) FILTER (WHERE bid_qty > 50) AS heavy,
       avg(best_bid) FILTER (WHERE ask_qty > 0) AS avg_bid FROM book_ticker GROUP BY 1""", dbl="avg_bid")
def _(m):
    return m.bt.groupBy("symbol_id").agg(
        F.count_if(F.col("bid_qty") > 50).alias("heavy"),
        F.avg(F.when(F.col("ask_qty") > 0, F.col("best_bid"))).alias("avg_bid"))


@query("w5_bucket_pick", f"""SELECT b AS ts_bucket, symbol_id, 'first' AS which, update_id, best_bid, best_ask FROM (
         SELECT *, {bucket(D)} AS b FROM book_ticker QUALIFY row_number() OVER (
           PARTITION BY symbol_id, b ORDER BY ts_exchange, update_id) = 1)
       UNION ALL SELECT b, symbol_id, 'last', update_id, best_bid, best_ask FROM (
         SELECT *, {bucket(D)} AS b FROM book_ticker QUALIFY row_number() OVER (
           PARTITION BY symbol_id, b ORDER BY ts_exchange DESC, update_id DESC) = 1)""", dbl="best_bid best_ask")
def _(m):
    ticks = m.bt.withColumn("ts_bucket", X.time_bucket("ts_exchange", "1 day"))

    def pick(which):
        return B.bucket_pick(ticks, ["ts_bucket", "symbol_id"], K.TICK_ORDER, which).select(
            "ts_bucket", "symbol_id", F.lit(which).alias("which"), "update_id", "best_bid", "best_ask")

    return P.union_all(pick("first"), pick("last"))


@query("w6_bucket_window_stats", f"""SELECT ts_exchange, symbol_id, update_id, mid, spread, {bucket(D)} AS ts_second,
       avg(spread) OVER w AS spread_mean, min(spread) OVER w AS spread_min, max(spread) OVER w AS spread_max,
       stddev_samp(spread) OVER w AS spread_std, max(mid) OVER w AS mid_high, min(mid) OVER w AS mid_low,
       count(*) OVER w AS update_count FROM quotes WINDOW w AS (PARTITION BY symbol_id, {bucket(D)})""",
       dbl="mid spread spread_mean spread_min spread_max spread_std mid_high mid_low")
def _(m):
    return B.bucket_window_stats(m.bt, "1 day")


@query("w7_tick_gaps", """SELECT symbol_id, count(*) FILTER (WHERE gap > 60) AS gaps_over_1min,
       max(gap) AS max_gap_seconds, avg(gap) FILTER (WHERE gap < 300) AS avg_gap_seconds FROM (
         SELECT symbol_id, (epoch_us(ts_exchange) - epoch_us(lag(ts_exchange) OVER (PARTITION BY symbol_id
           ORDER BY ts_exchange, update_id))) / 1000000.0E0 AS gap FROM book_ticker)
       WHERE gap IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (WHERE gap > 60) > 0""",
       dbl="max_gap_seconds avg_gap_seconds")
def _(m):
    return K.tick_gaps(m.bt)


INTERVALS = """SELECT symbol_id, count(*) AS updates, avg(us) / 1000 AS avg_interval_ms, max(us) / 1000
         AS max_interval_ms, quantile_disc(us, 0.95) / 1000 AS p95_interval_ms FROM (
         SELECT symbol_id, epoch_us(ts_exchange) - epoch_us(lag(ts_exchange) OVER (PARTITION BY symbol_id
           ORDER BY ts_exchange, update_id)) AS us FROM book_ticker)
       WHERE us IS NOT NULL GROUP BY 1"""


@query("w8_interval_stats", f"SELECT * FROM ({INTERVALS} HAVING count(*) > 10) ORDER BY updates DESC, symbol_id LIMIT 5",
       dbl="avg_interval_ms max_interval_ms p95_interval_ms")
def _(m):
    return K.interval_stats(m.bt)


@query("w8_interval_stats_all", INTERVALS, dbl="avg_interval_ms max_interval_ms p95_interval_ms")
def _(m):
    return K.interval_stats(m.bt, min_updates=0, top=None)


@query("w9_quote_change_bps", f"""SELECT ts_exchange, symbol_id, update_id, {MICRO} AS microprice,
       (bid_qty - ask_qty) / nullif(bid_qty + ask_qty, 0) AS ofi, (best_bid - pb) / nullif(pb, 0) * 10000
       AS bid_change_bps, (best_ask - pa) / nullif(pa, 0) * 10000 AS ask_change_bps, abs(({MICRO}) - mid)
       AS microprice_deviation FROM (
       SELECT *, lag(best_bid) OVER w AS pb, lag(best_ask) OVER w AS pa FROM quotes
       WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_exchange, update_id)) WHERE pb IS NOT NULL""",
       dbl="microprice ofi bid_change_bps ask_change_bps microprice_deviation")
def _(m):
    return K.quote_change_bps(m.bt)


@query("w10_latest_per_symbol", f"""SELECT symbol_id, row_number() OVER (PARTITION BY symbol_id ORDER BY ts_exchange DESC,
       update_id DESC) AS recency, best_bid, best_ask, spread, spread / nullif(best_bid, 0) * 100 AS spread_percent,
       ts_exchange, ts_ingest, {LAT} AS latency_ms FROM quotes QUALIFY recency <= 3""",
       dbl="best_bid best_ask spread spread_percent latency_ms")
def _(m):
    return K.latest_per_symbol(m.bt, 3)


@query("o1_recent_rows", "SELECT * FROM book_ticker ORDER BY ts_exchange DESC, update_id DESC LIMIT 10", dbl=QUOTE)
def _(m):
    return P.recent_rows(m.bt, 10)


@query("o2_top_active", """SELECT symbol_id, count(*) AS updates_count, min(ts_exchange) AS first_seen,
       max(ts_exchange) AS last_seen, count(*) / nullif((epoch_us(max(ts_exchange)) - epoch_us(min(ts_exchange)))
       / 1000000.0E0, 0) AS updates_per_second FROM book_ticker GROUP BY 1 HAVING count(*) > 310
       ORDER BY updates_count DESC, symbol_id LIMIT 20""", dbl="updates_per_second")
def _(m):
    return P.top_active(m.bt, 20, min_rows=310)


VOLATILITY = """SELECT symbol_id, stddev_samp(mid) AS price_volatility, avg(mid) AS avg_price,
       stddev_samp(mid) / nullif(avg(mid), 0) * 100 AS volatility_percent FROM quotes GROUP BY 1 HAVING count(*) > 310"""


@query("d19_volatility_stats", VOLATILITY, dbl="price_volatility avg_price volatility_percent")
def _(m):
    return P.volatility_stats(m.bt, min_rows=310)


@query("o3_top_volatile", VOLATILITY + " ORDER BY volatility_percent DESC, symbol_id LIMIT 10",
       dbl="price_volatility avg_price volatility_percent")
def _(m):
    return P.top_volatile(m.bt, 10, min_rows=310)


@query("o4_active_recently", """SELECT symbol_id, count(*) AS records, max(ts_exchange) AS last_update FROM recent_bt
       GROUP BY 1""")
def _(m):
    return P.active_recently(m.bt, ASOF, RECENT)


@query("o5_ordered_dataset", "SELECT ts_second, symbol_id, mid_close FROM bt_hour", dbl="mid_close")
def _(m):
    return P.ordered_dataset(B.quote_bars_mid(m.bt, "1 hour").select("ts_second", "symbol_id", "mid_close"))


@query("o6_book_snapshot_asof", """SELECT symbol_id, ts_exchange, final_update_id, b1_price, a1_price, i1, i5
       FROM topn WHERE ts_exchange <= TIMESTAMP '2024-01-20 12:00:00'
       QUALIFY row_number() OVER (PARTITION BY symbol_id ORDER BY ts_exchange DESC, final_update_id DESC) = 1""",
       dbl="b1_price a1_price i1 i5")
def _(m):
    return P.book_snapshot_asof(M.flatten_topn(m.de), "2024-01-20 12:00:00").select(
        "symbol_id", "ts_exchange", "final_update_id", "b1_price", "a1_price", "i1", "i5")


@query("o7_top_updated", """SELECT symbol, count(*) AS updates, max(ts_exchange) AS last_update_utc FROM recent_bt
       JOIN symbols ON id = symbol_id GROUP BY 1 ORDER BY updates DESC, symbol LIMIT 15""")
def _(m):
    return P.top_updated(m.bt, m.symbols, ASOF, RECENT)


@query("u1_union_all", """SELECT ts_exchange, symbol_id, update_id AS id FROM book_ticker
       UNION ALL SELECT ts_exchange, symbol_id, agg_trade_id FROM trades""")
def _(m):
    return P.union_all(m.bt.select("ts_exchange", "symbol_id", F.col("update_id").alias("id")),
                       m.tr.select("ts_exchange", "symbol_id", F.col("agg_trade_id").alias("id")))


@query("u2_depth_to_levels", """SELECT symbol_id, ts_exchange, ts_ingest, final_update_id AS update_id,
       CASE side WHEN 'b' THEN 'bid' ELSE 'ask' END AS side, i AS price_level, price, qty AS quantity FROM levels""",
       dbl="price quantity", big="price_level")
def _(m):
    return P.depth_to_levels(m.de)


@query("l12_symbol_metadata", "SELECT id AS symbol_id, exchange, symbol, is_active FROM symbols")
def _(m):
    return symbol_metadata(m.symbols)
