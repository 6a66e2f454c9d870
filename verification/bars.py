"""A, J and D queries."""

from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators import bars as B
from tickspark.operators import joins as J
from tickspark.operators import micro as M
from tickspark.operators import profile as P
from tickspark.operators import ticks as K
from tickspark.operators.ticks import recent
from verification import registry as R
from verification.registry import ASOF, D, H, LAT, RECENT, bucket, query

OHLC = "mid_open mid_high mid_low mid_close"
SPREADS = "spread_mean spread_min spread_max spread_std"
QB = f"{OHLC} {SPREADS} total_qty_mean avg_latency_ms"
TB = "vol_sum vwap buy_vol sell_vol price_open price_high price_low price_close"
SIDES = ("bid_open bid_close bid_high bid_low bid_avg ask_open ask_close ask_high ask_low ask_avg bid_qty_open "
         "bid_qty_close bid_qty_max bid_qty_min bid_qty_avg ask_qty_open ask_qty_close ask_qty_max ask_qty_min "
         "ask_qty_avg spread_avg spread_max spread_min mid_avg microprice_avg")
TX = ("price_open price_close price_high price_low volume quote_volume avg_trade_size max_trade_size min_trade_size "
      "buy_volume sell_volume vwap buy_ratio")


@query("a1_quote_bars_mid", "SELECT * FROM bt_day", dbl=QB)
def _(m):
    return B.quote_bars_mid(m.bt, "1 day")


@query("a1_quote_bars_mid_hour", "SELECT * FROM bt_hour", dbl=QB)
def _(m):
    return B.quote_bars_mid(m.bt, "1 hour")


@query("a2_quote_bars_bidask", R.quote_bidask_sql(D), dbl=SIDES)
def _(m):
    return B.quote_bars_bidask(m.bt, "1 day")


@query("a3_quote_bars_table", f"""SELECT {bucket(D)} AS ts_second, symbol_id, arg_min(mid, ts_exchange) AS mid_open,
       max(mid) AS mid_high, min(mid) AS mid_low, arg_max(mid, ts_exchange) AS mid_close, avg(spread) AS spread_mean,
       stddev_samp(spread) AS spread_std, min(spread) AS spread_min, max(spread) AS spread_max,
       avg(bid_qty) AS bid_qty_mean, avg(ask_qty) AS ask_qty_mean, count(*) AS updates_count,
       sum(mid * (bid_qty + ask_qty)) / nullif(sum(bid_qty + ask_qty), 0) AS volume_weighted_mid
       FROM quotes GROUP BY 1, 2""", dbl=f"{OHLC} {SPREADS} bid_qty_mean ask_qty_mean volume_weighted_mid")
def _(m):
    return B.quote_bars_table(m.bt, "1 day")


@query("a4_trade_bars", "SELECT * FROM tr_day", dbl=TB)
def _(m):
    return B.trade_bars(m.tr, "1 day")


@query("a5_trade_bars_ext", R.trade_ext_sql(D), dbl=TX)
def _(m):
    return B.trade_bars_ext(m.tr, "1 day")


@query("a6_trade_bars_table", f"SELECT * EXCLUDE (b0, s0) FROM ({R.trade_table_sql(D)})",
       dbl="volume_sum value_sum vwap buy_volume sell_volume imbalance_ratio price_min price_max")
def _(m):
    return B.trade_bars_table(m.tr, "1 day")


@query("a6_trade_bars_migrated", f"""SELECT ts_bucket AS ts_second, symbol_id, price_open, price_high, price_low,
       price_close, volume AS volume_base, quote_volume AS volume_quote, trade_count AS trades_count,
       buy_count AS buy_trades_count, sell_count AS sell_trades_count, buy_volume, sell_volume
       FROM ({R.trade_ext_sql(D)})""",
       dbl="price_open price_high price_low price_close volume_base volume_quote buy_volume sell_volume")
def _(m):
    return B.trade_bars_migrated(m.tr, "1 day")


LEVELS = " ".join(f"{w}_{s}_{v}" for w in ("last", "first") for s in ("bid", "ask") for v in ("price", "qty"))


@query("a7_depth_bars", "SELECT * FROM de_day", dbl=LEVELS)
def _(m):
    return B.depth_bars(m.de, "1 day")


@query("a8_quote_bars_migrated", """SELECT ts_second, symbol_id, mid_open, mid_high, mid_low, mid_close, spread_mean,
       spread_std, spread_min, spread_max, update_count AS total_updates FROM bt_day""", dbl=f"{OHLC} {SPREADS}")
def _(m):
    return B.quote_bars_migrated(m.bt, "1 day")


ROLLUP = """SELECT date_trunc('hour', b.ts_second) AS hour_bucket, b.symbol_id,
       first(mid_open ORDER BY b.ts_second) AS h_open, max(mid_high) AS h_high, min(mid_low) AS h_low,
       last(mid_close ORDER BY b.ts_second) AS h_close, sum(coalesce(t.vol_sum, 0)) AS h_volume,
       avg(spread_mean) AS h_avg_spread, stddev_samp(mid_close) AS h_volatility,
       CAST(sum(update_count) AS BIGINT) AS h_updates, sum(coalesce(t.buy_vol, 0)) AS h_buy_vol,
       sum(coalesce(t.sell_vol, 0)) AS h_sell_vol
       FROM ({b}) b LEFT JOIN ({t}) t ON t.ts_second = b.ts_second AND t.symbol_id = b.symbol_id GROUP BY 1, 2"""
MIN = 60_000_000


@query("a9_hourly_rollup", ROLLUP.format(b=R.quote_bars_sql(MIN), t=R.trade_bars_sql(MIN)),
       dbl="h_open h_high h_low h_close h_volume h_avg_spread h_volatility h_buy_vol h_sell_vol")
def _(m):
    return B.hourly_rollup(B.quote_bars_mid(m.bt, "1 minute"), B.trade_bars(m.tr, "1 minute"))


DEPTH_HOURLY = """SELECT date_trunc('hour', ts_exchange) AS hour_bucket, symbol_id, avg(i1) AS avg_i1, avg(i5) AS avg_i5,
       avg(microprice) AS avg_microprice, avg(wall_size_bps) AS avg_wall_size, avg(a1_price - b1_price) AS avg_spread,
       stddev_samp(a1_price - b1_price) AS spread_volatility FROM topn GROUP BY 1, 2"""
DH = "avg_i1 avg_i5 avg_microprice avg_wall_size avg_spread spread_volatility"


@query("a10_depth_hourly", DEPTH_HOURLY, dbl=DH)
def _(m):
    return B.depth_hourly(M.flatten_topn(m.de))


@query("a11_subsecond_bars", R.quote_bars_sql(250_000), dbl=QB)
def _(m):
    return B.subsecond_bars(m.bt, "250 milliseconds")


@query("a12_topn_resample", f"""SELECT {bucket(D)} AS ts_bucket, symbol_id, ts_exchange, final_update_id, b1_price,
       a1_price, i5 FROM topn QUALIFY row_number() OVER (PARTITION BY symbol_id, {bucket(D)}
       ORDER BY ts_exchange DESC, final_update_id DESC) = 1""", dbl="b1_price a1_price i5")
def _(m):
    return B.topn_resample(M.flatten_topn(m.de), "1 day").select(
        "ts_bucket", "symbol_id", "ts_exchange", "final_update_id", "b1_price", "a1_price", "i5")


JOINED = """SELECT b.*, coalesce(t.trade_count, 0) AS trade_count, coalesce(t.vol_sum, 0) AS volume,
       coalesce(t.vwap, b.mid_close) AS vwap, coalesce(t.buy_vol, 0) AS buy_volume,
       coalesce(t.sell_vol, 0) AS sell_volume, CASE WHEN t.buy_vol + t.sell_vol > 0
       THEN (t.buy_vol - t.sell_vol) / (t.buy_vol + t.sell_vol) ELSE 0 END AS buy_sell_imbalance
       FROM bt_hour b LEFT JOIN tr_hour t ON t.ts_second = b.ts_second AND t.symbol_id = b.symbol_id"""


@query("j1_join_bars", JOINED, dbl=QB + " volume vwap buy_volume sell_volume buy_sell_imbalance")
def _(m):
    return J.join_bars(B.quote_bars_mid(m.bt, "1 hour"), B.trade_bars(m.tr, "1 hour"))


@query("j2_enrich_symbols", "SELECT t.*, s.symbol FROM trades t JOIN symbols s ON s.id = t.symbol_id", dbl="price qty")
def _(m):
    return J.enrich_symbols(m.tr, m.symbols)


MK = ("bid_close ask_close bid_qty_close ask_qty_close spread_avg microprice_avg price_close volume vwap buy_ratio "
      "buy_volume sell_volume")


@query("j3_market_data_bars", "SELECT * FROM mk_hour", dbl=MK)
def _(m):
    return J.market_data_bars(B.quote_bars_bidask(m.bt, "1 hour"), B.trade_bars_ext(m.tr, "1 hour"),
                              B.depth_bars(m.de, "1 hour"))


@query("j4_range_join_topn", """SELECT b.ts_second, b.symbol_id, b.mid_close, b.spread_mean, o.ts_exchange AS book_ts,
       o.i1, o.i5, o.microprice FROM bt_hour b LEFT JOIN topn o ON o.symbol_id = b.symbol_id
       AND o.ts_exchange >= b.ts_second AND o.ts_exchange < b.ts_second + INTERVAL 1 HOUR""",
       dbl="mid_close spread_mean i1 i5 microprice")
def _(m):
    return J.range_join_topn(B.quote_bars_mid(m.bt, "1 hour"), M.flatten_topn(m.de), "1 hour")


@query("j5_latest_in_bucket_join", """SELECT b.ts_second, b.symbol_id, b.mid_close, b.spread_mean, b.update_count,
       o.ts_exchange AS book_ts, o.b1_price, o.b1_qty, o.a1_price, o.a1_qty, o.microprice, o.i1, o.i5, o.total_bid_qty,
       o.total_ask_qty FROM bt_hour b LEFT JOIN (SELECT * FROM topn QUALIFY row_number() OVER (
         PARTITION BY symbol_id, date_trunc('hour', ts_exchange) ORDER BY ts_exchange DESC, final_update_id DESC) = 1) o
       ON o.symbol_id = b.symbol_id AND date_trunc('hour', o.ts_exchange) = b.ts_second""",
       dbl="mid_close spread_mean b1_price b1_qty a1_price a1_qty microprice i1 i5 total_bid_qty total_ask_qty")
def _(m):
    return J.latest_in_bucket_join(B.quote_bars_mid(m.bt, "1 hour"), M.flatten_topn(m.de), "1 hour")


RECENT_JOIN = f"""SELECT s.id AS symbol_id, s.symbol, s.is_active, coalesce(q.n, 0) AS bt_count, q.last_bt, q.li
       AS last_bt_ingest, q.lat AS avg_latency_ms, coalesce(t.n, 0) AS tr_count, t.last_tr, t.li AS last_tr_ingest
       FROM {{symbols}} s
       LEFT JOIN (SELECT symbol_id, count(*) AS n, max(ts_exchange) AS last_bt, max(ts_ingest) AS li, avg({LAT}) AS lat
                  FROM recent_bt GROUP BY 1) q ON q.symbol_id = s.id
       LEFT JOIN (SELECT symbol_id, count(*) AS n, max(ts_exchange) AS last_tr, max(ts_ingest) AS li
                  FROM recent_tr GROUP BY 1) t ON t.symbol_id = s.id"""


@query("j6_left_recent_join", RECENT_JOIN.format(symbols="symbols"), dbl="avg_latency_ms")
def _(m):
    return J.left_recent_join(m.symbols, recent(m.bt, ASOF, RECENT), recent(m.tr, ASOF, RECENT))


@query("j7_semi_symbols", "SELECT * FROM trades WHERE symbol_id IN (SELECT id FROM active)", dbl="price qty")
def _(m):
    return J.semi_symbols(m.tr, K.active_symbols(m.symbols).select(F.col("id").alias("symbol_id")))


@query("j8_anti_existing", """SELECT q.* EXCLUDE (spread, mid) FROM quotes q WHERE NOT EXISTS (
       SELECT 1 FROM trades t WHERE t.symbol_id = q.symbol_id AND t.agg_trade_id = q.update_id)""",
       dbl="best_bid best_ask bid_qty ask_qty")
def _(m):
    stored = m.tr.select("symbol_id", F.col("agg_trade_id").alias("update_id"))
    return J.anti_existing(m.bt, stored, ["symbol_id", "update_id"])


@query("j9_merge_depth_hourly", f"""SELECT b.ts_second AS hour_bucket, b.symbol_id, b.mid_close, d.* EXCLUDE (hour_bucket,
       symbol_id) FROM bt_hour b LEFT JOIN ({DEPTH_HOURLY}) d ON d.hour_bucket = b.ts_second
       AND d.symbol_id = b.symbol_id""", dbl="mid_close " + DH)
def _(m):
    hourly = B.quote_bars_mid(m.bt, "1 hour").select(F.col("ts_second").alias("hour_bucket"), "symbol_id", "mid_close")
    return J.merge_depth_hourly(hourly, B.depth_hourly(M.flatten_topn(m.de)))


@query("j10_stream_counts", """SELECT symbol_id, count(*) AS bt_records, max(ts_exchange) AS last_bt_update,
       coalesce((SELECT count(*) FROM recent_tr t WHERE t.symbol_id = b.symbol_id), 0) AS trade_records
       FROM recent_bt b GROUP BY symbol_id""")
def _(m):
    return J.stream_counts(recent(m.bt, ASOF, RECENT), recent(m.tr, ASOF, RECENT))


OFFSETS = """SELECT symbol_id, stream_type, arg_max(event_id, ts_exchange) AS last_update_id,
       max(ts_exchange) AS last_event_time, max(ts_ingest) AS last_processed_at FROM log GROUP BY 1, 2"""
STATS = f"""SELECT date_trunc('hour', ts_exchange) AS date_hour, symbol_id, stream_type,
       count(*) FILTER (WHERE ok) AS events_processed, count(*) FILTER (WHERE NOT ok) AS events_failed,
       arg_max({LAT}, ts_exchange) AS last_latency_ms FROM log GROUP BY 1, 2, 3"""
HOUR_STATS = f"""SELECT o.*, s.events_processed, s.events_failed, s.last_latency_ms FROM ({OFFSETS}) o
       LEFT JOIN ({STATS}) s ON s.symbol_id = o.symbol_id AND s.stream_type = o.stream_type
       AND s.date_hour = date_trunc('hour', TIMESTAMP '{ASOF}')"""


@query("j11_current_hour_stats_join", HOUR_STATS, dbl="last_latency_ms")
def _(m):
    return J.current_hour_stats_join(P.ingestion_offsets(m.ingest_log), P.ingestion_stats_hourly(m.ingest_log), ASOF)


SPAN = "(epoch_us(max(ts_exchange)) - epoch_us(min(ts_exchange))) / 1000000.0E0"
RATE = f"""SELECT symbol_id, count(*) AS updates_count, min(ts_exchange) AS first_update, max(ts_exchange) AS last_update,
       {SPAN} / 60 AS duration_minutes, count(*) / nullif({SPAN} / 60, 0) AS updates_per_minute,
       count(*) / nullif({SPAN}, 0) AS updates_per_second FROM book_ticker GROUP BY 1"""


@query("d1_update_rate", RATE, dbl="duration_minutes updates_per_minute updates_per_second")
def _(m):
    return P.update_rate(m.bt)


@query("d2_rate_compliance", f"""SELECT symbol_id, updates_count AS total_updates, duration_minutes, updates_per_minute,
       CASE WHEN updates_per_minute >= 0.0075 THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END AS compliance
       FROM ({RATE}) WHERE duration_minutes > 1""", dbl="duration_minutes updates_per_minute")
def _(m):
    return P.rate_compliance(m.bt, per_minute=0.0075)


@query("d3_symbol_stats", """SELECT symbol_id, count(*) AS updates_count, min(best_bid) AS min_bid, max(best_ask) AS max_ask,
       avg(mid) AS avg_mid_price, avg(spread) AS avg_spread, min(ts_exchange) AS first_update,
       max(ts_exchange) AS last_update FROM quotes GROUP BY 1""", dbl="min_bid max_ask avg_mid_price avg_spread")
def _(m):
    return P.symbol_stats(m.bt)


@query("d4_spread_stats", """SELECT symbol_id, avg(spread) AS avg_spread, min(spread) AS min_spread, max(spread) AS max_spread,
       stddev_samp(spread) AS spread_volatility, avg(spread / nullif(best_bid, 0) * 100) AS avg_spread_percent
       FROM quotes GROUP BY 1""", dbl="avg_spread min_spread max_spread spread_volatility avg_spread_percent")
def _(m):
    return P.spread_stats(m.bt)


@query("d5_latency_stats", f"""SELECT symbol_id, avg(l) AS avg_latency_ms, min(l) AS min_latency_ms, max(l) AS max_latency_ms,
       stddev_samp(l) AS latency_stddev, quantile_cont(l, 0.95) AS p95_latency_ms
       FROM (SELECT symbol_id, {LAT} AS l FROM book_ticker) GROUP BY 1""",
       dbl="avg_latency_ms min_latency_ms max_latency_ms latency_stddev p95_latency_ms")
def _(m):
    return P.latency_stats(m.bt)


@query("d6_daily_volume", """SELECT CAST(ts_exchange AS DATE) AS date, count(*) AS total_records,
       count(DISTINCT symbol_id) AS unique_symbols, count(*) * 76 AS estimated_bytes FROM book_ticker GROUP BY 1""")
def _(m):
    return P.daily_volume(m.bt)


@query("d7_trade_bar_summary", f"""SELECT symbol_id, count(*) AS data_points, avg(volume) AS avg_volume,
       avg(trade_count) AS avg_trades_per_bar, avg(buy_ratio) AS avg_buy_ratio FROM ({R.trade_ext_sql(H)}) GROUP BY 1""",
       dbl="avg_volume avg_trades_per_bar avg_buy_ratio")
def _(m):
    return P.trade_bar_summary(B.trade_bars_ext(m.tr, "1 hour"))


@query("d9_ingestion_counts", f"""SELECT symbol, bt_count AS book_ticker_count_1h, tr_count AS trades_count_1h, last_bt_ingest
       AS last_book_ticker, last_tr_ingest AS last_trade, avg_latency_ms FROM ({RECENT_JOIN.format(symbols='active')})""",
       dbl="avg_latency_ms")
def _(m):
    return P.ingestion_counts(m.symbols, m.bt, m.tr, ASOF, RECENT)


def _beat(name, table):
    return (f"SELECT '{name}' AS table_name, max(ts_exchange) AS last_ts, "
            + ", ".join(f"count(*) FILTER (WHERE ts_exchange >= TIMESTAMP '{ASOF}' - INTERVAL {n} {u}) AS {c}"
                        for c, n, u in (("count_1d", 1, "DAY"), ("count_2d", 2, "DAY"), ("count_6h", 6, "HOUR")))
            + f" FROM {table}")


BEATS = {"count_1d": "1 DAY", "count_2d": "2 DAYS", "count_6h": "6 HOURS"}


@query("d10_table_heartbeat", " UNION ALL ".join(_beat(n, t) for n, t in (
    ("book_ticker", "book_ticker"), ("trades", "trades"), ("depth_events", "depth"), ("orderbook_top5", "topn"))))
def _(m):
    return P.table_heartbeat({"book_ticker": m.bt, "trades": m.tr, "depth_events": m.de,
                              "orderbook_top5": M.flatten_topn(m.de)}, ASOF, BEATS)


def _probe(table, tag):
    since = f"ts_exchange >= TIMESTAMP '{ASOF}' - INTERVAL"
    return (f"(SELECT symbol_id, max(ts_exchange) AS last_{tag}, count(*) FILTER (WHERE {since} 12 HOUR) AS {tag}_short, "
            f"count(*) FILTER (WHERE {since} 2 DAY) AS {tag}_long FROM {table} GROUP BY 1)")


@query("d11_symbol_probe", f"""SELECT symbol, last_bt, coalesce(bt_short, 0) AS bt_short, coalesce(bt_long, 0) AS bt_long,
       coalesce(tr_short, 0) AS tr_short, coalesce(tr_long, 0) AS tr_long FROM symbols s
       LEFT JOIN {_probe('book_ticker', 'bt')} b ON b.symbol_id = s.id
       LEFT JOIN {_probe('trades', 'tr')} t ON t.symbol_id = s.id""")
def _(m):
    return P.symbol_probe(m.symbols, m.bt, m.tr, ASOF, "12 HOURS", RECENT)


@query("d12_collection_stats", """SELECT symbol_id, count(*) AS records_count, max(ts_ingest) AS last_update FROM (
       SELECT symbol_id, ts_ingest FROM book_ticker UNION ALL SELECT symbol_id, ts_ingest FROM trades) GROUP BY 1""")
def _(m):
    return P.collection_stats(m.tr, prior=P.collection_stats(m.bt))


@query("d13_row_counts", """SELECT 'quotes' AS table_name, count(*) AS records FROM bt_hour
       UNION ALL SELECT 'trades', count(*) FROM tr_hour UNION ALL SELECT 'depth', count(*) FROM de_day""")
def _(m):
    return P.row_counts({"quotes": B.quote_bars_mid(m.bt, "1 hour"), "trades": B.trade_bars(m.tr, "1 hour"),
                         "depth": B.depth_bars(m.de, "1 day")})


@query("d14_system_rollup", f"""SELECT count(*) AS total_symbols, count(*) FILTER (WHERE bt_count > 0) AS active_symbols,
       coalesce(sum(bt_count + tr_count), 0) / 2880.0E0 AS total_updates_per_minute,
       coalesce(avg(avg_latency_ms), 0) AS average_latency_ms FROM ({RECENT_JOIN.format(symbols='active')})""",
       dbl="total_updates_per_minute average_latency_ms")
def _(m):
    return P.system_rollup(m.symbols, m.bt, m.tr, ASOF, RECENT, minutes=2880.0)


@query("d15_trade_side_balance", """SELECT count(*) AS total_trades, count(*) FILTER (WHERE is_buyer_maker) AS maker_trades,
       count(*) FILTER (WHERE NOT is_buyer_maker) AS taker_trades, avg(qty) AS avg_trade_size,
       count(*) FILTER (WHERE is_buyer_maker) / count(*) AS maker_ratio, count(*) FILTER (WHERE price <= 0)
       AS invalid_prices, count(*) FILTER (WHERE qty <= 0) AS invalid_quantities FROM trades""",
       dbl="avg_trade_size maker_ratio")
def _(m):
    return P.trade_side_balance(m.tr)


@query("d16_distinct_symbols", "SELECT DISTINCT symbol_id FROM book_ticker")
def _(m):
    return P.distinct_symbols(m.bt)


@query("d17_ingestion_stats_hourly", STATS, dbl="last_latency_ms")
def _(m):
    return P.ingestion_stats_hourly(m.ingest_log)


@query("d18_ingestion_offsets", OFFSETS)
def _(m):
    return P.ingestion_offsets(m.ingest_log)
