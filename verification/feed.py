"""S, T and R queries: feed messages, sinks, streaming jobs and maintenance, each read back."""

from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators import bars as B
from tickspark.operators import joins as J
from tickspark.operators import micro as M
from tickspark.operators.profile import both_sides
from tickspark.operators.ticks import time_slice
from tickspark.schemas import KEYS, L1_CSV
from tickspark.session import work_dir
from tickspark.sources import tables as S
from tickspark.sources import wire as W
from tickspark.streaming import jobs as T
from verification import registry as R
from verification.bars import MK, QB
from verification.bindings import Market
from verification.features import FEATS, FEATURES, market
from verification.registry import ASOF, H, bucket, query

MS = "make_timestamp(epoch_us(ts_exchange) // 1000 * 1000)"
SYM = "'NATION_' || symbol_id"
QUOTE = "best_bid best_ask bid_qty ask_qty"
NOT_ERROR = "update_id NOT IN (SELECT event_id FROM ev WHERE event_type = 'error')"


@query("s1_read_envelope", """SELECT kind, stream, count(*) AS messages FROM (
       SELECT 'bookTicker' AS kind, 'nation_' || symbol_id || '@bookTicker' AS stream FROM book_ticker
       UNION ALL SELECT 'aggTrade', 'nation_' || symbol_id || '@aggTrade' FROM trades
       UNION ALL SELECT 'depthUpdate', 'nation_' || symbol_id || '@depth' FROM depth) GROUP BY 1, 2""")
def _(m):
    return W.read_envelope(m.messages).groupBy("kind", "stream").agg(F.count(F.lit(1)).alias("messages"))


@query("s1_read_bare", """SELECT 'bookTicker' AS kind, count(*) AS messages FROM book_ticker
       UNION ALL SELECT 'aggTrade', count(*) FROM trades UNION ALL SELECT 'depthUpdate', count(*) FROM depth""")
def _(m):
    bare = m.messages.select("ts_ingest", F.get_json_object("value", "$.data").alias("value"))
    return W.read_bare(bare).groupBy("kind").agg(F.count(F.lit(1)).alias("messages"))


@query("s2_parse_book_ticker", f"""SELECT {SYM} AS symbol, ts_ingest, {MS} AS ts_exchange, update_id, best_bid, best_ask,
       bid_qty, ask_qty, spread, mid FROM quotes WHERE {NOT_ERROR}""", dbl=QUOTE + " spread mid")
def _(m):
    return W.accepted(W.parse_book_ticker(W.read_envelope(m.messages)))


@query("s3_parse_agg_trade", f"""SELECT {SYM} AS symbol, ts_ingest, {MS} AS ts_exchange, agg_trade_id, price, qty,
       is_buyer_maker FROM trades""", dbl="price qty")
def _(m):
    return W.accepted(W.parse_agg_trade(W.read_envelope(m.messages), "T"))


@query("s4_parse_depth", f"""SELECT {SYM} AS symbol, d.ts_ingest, make_timestamp(epoch_us(d.ts_exchange) // 1000 * 1000)
       AS ts_exchange, first_update_id, d.final_update_id, prev_final_update_id, l.side, i AS level, price, qty
       FROM depth d JOIN (SELECT final_update_id, side, i, price, qty FROM levels) l
       ON l.final_update_id = d.final_update_id""", dbl="price qty", big="level")
def _(m):
    rows = W.accepted(W.parse_depth(W.read_envelope(m.messages)))
    ids = ["symbol", "ts_ingest", "ts_exchange", "first_update_id", "final_update_id", "prev_final_update_id"]

    return both_sides(rows, ids, "b", "a", "level", "qty")


@query("s5_validate_depth_message", """SELECT kind, kind = 'depthUpdate' AS is_valid, n FROM (
       SELECT 'bookTicker' AS kind, count(*) AS n FROM book_ticker UNION ALL SELECT 'aggTrade', count(*) FROM trades
       UNION ALL SELECT 'depthUpdate', count(*) FROM depth)""")
def _(m):
    checked = W.validate_depth_message(W.read_envelope(m.messages))
    return checked.groupBy("kind", "is_valid").agg(F.count(F.lit(1)).alias("n"))


L1 = f"""SELECT 'spot' AS exchange, {SYM} AS symbol, epoch_us(ts_exchange) // 1000 * 1000 AS timestamp,
       epoch_us(ts_ingest) AS local_timestamp, CAST(event_id % 13 AS DOUBLE) AS ask_amount,
       (cents + 1) / 100.0E0 AS ask_price, cents / 100.0E0 AS bid_price, CAST(k % 17 AS DOUBLE) AS bid_amount FROM depth"""
L1D = "ask_amount ask_price bid_price bid_amount"


@query("s6_depth_to_l1", L1, dbl=L1D)
def _(m):
    return W.depth_to_l1(W.read_envelope(m.messages), "spot")


@query("s6_landing_rows", f"""SELECT {SYM} AS symbol, (epoch_us(ts_exchange) // 1000) / 1000.0E0 AS timestamp,
       epoch_us(ts_exchange) // 1000 AS event_time, first_update_id, final_update_id, 5 AS n_bids, 5 AS n_asks FROM depth""",
       dbl="timestamp", big="n_bids n_asks")
def _(m):
    rows = W.landing_rows(W.accepted(W.parse_depth(W.read_envelope(m.messages))))
    return rows.select("symbol", "timestamp", "event_time", "first_update_id", "final_update_id",
                       F.size("bids").alias("n_bids"), F.size("asks").alias("n_asks"))


@query("s7_new_symbols", """SELECT row_number() OVER (ORDER BY symbol) + (SELECT max(id) FROM active) AS id,
       'spot' AS exchange, symbol, 'perp' AS instrument_type, split_part(symbol, '_', 1) AS base_asset, '_' AS quote_asset,
       true AS is_active FROM symbols WHERE NOT is_active AND id IN (
       SELECT symbol_id FROM keyed WHERE event_type NOT IN ('purchase', 'error'))""")
def _(m):
    quotes = W.accepted(W.parse_book_ticker(W.read_envelope(m.messages)))
    return W.new_symbols(quotes, m.symbols.filter("is_active"), "spot", "_")


def _stored_quotes(m) -> str:
    path = work_dir(m.spark, "quotes")
    S.write_partitioned(S.with_event_date(m.bt), path, ["symbol_id", "ts_exchange"])
    return path


START, END = "2024-01-10 06:00:00", "2024-01-20 18:00:00"


@query("s7_scan_ticks", f"""SELECT * FROM book_ticker WHERE ts_exchange >= TIMESTAMP '{START}'
       AND ts_exchange < TIMESTAMP '{END}'""", dbl=QUOTE)
def _(m):
    return S.scan_ticks(m.spark, _stored_quotes(m), START, END).drop("event_date")


@query("s8_write_ticks_idempotent", "SELECT * FROM book_ticker", dbl=QUOTE)
def _(m):
    path = work_dir(m.spark, "idempotent")
    again = m.redelivered
    S.write_ticks_idempotent(time_slice(again, "2024-01-01", "2024-01-16"), path, KEYS["book_ticker"])
    S.write_ticks_idempotent(again, path, KEYS["book_ticker"])
    return m.spark.read.parquet(path).drop("event_date")


@query("s9_upsert_features", f"SELECT * REPLACE (CASE WHEN ts_exchange >= TIMESTAMP '2024-01-16' THEN ofi + 1 ELSE ofi END "
       f"AS ofi) FROM ({FEATURES})", dbl=FEATS)
def _(m):
    path, key = work_dir(m.spark, "features"), ["ts_exchange", "symbol_id"]
    first = M.market_features(market(m))
    S.upsert_latest(first, path, key)
    S.upsert_latest(time_slice(first, "2024-01-16", "2024-02-01").withColumn("ofi", F.col("ofi") + 1), path, key)
    return m.spark.read.parquet(path).drop("event_date")


@query("s10_export_csv", f"""SELECT symbol_id, epoch_us(ts_exchange) / 1000000.0E0 AS timestamp, best_bid, bid_qty, best_ask,
       ask_qty, spread, spread / nullif(best_bid, 0) * 100 AS spread_percent, {R.LAT} AS latency_ms FROM quotes""",
       dbl="timestamp spread spread_percent latency_ms " + QUOTE)
def _(m):
    path = work_dir(m.spark, "csv")
    extract = m.bt.select(
        "symbol_id", X.epoch_seconds("ts_exchange").alias("timestamp"), "best_bid", "bid_qty", "best_ask", "ask_qty",
        X.spread().alias("spread"), X.spread_pct("bid").alias("spread_percent"),
        X.elapsed_ms("ts_exchange", "ts_ingest").alias("latency_ms"))
    S.export_csv(extract, path, ["symbol_id", "timestamp"])
    return m.spark.read.csv(path, header=True, schema=extract.schema)


@query("s11_export_json", f"SELECT * FROM ({FEATURES})", dbl=FEATS)
def _(m):
    path, features = work_dir(m.spark, "json"), M.market_features(market(m))
    S.export_json(features, path)
    return m.spark.read.schema(features.schema).json(path)


@query("s12_export_parquet", "SELECT * FROM bt_hour", dbl=QB)
def _(m):
    path = work_dir(m.spark, "parquet")
    S.export_parquet(B.quote_bars_mid(m.bt, "1 hour"), path)
    return m.spark.read.parquet(path).drop("event_date")


def _l1(m):
    return W.depth_to_l1(W.read_envelope(m.messages), "spot")


@query("s13_rotate_files", f"""SELECT symbol, strftime(make_timestamp(timestamp // {R.D} * {R.D}), '%Y%m%d_%H%M%S') AS rotation,
       count(*) AS records FROM ({L1}) GROUP BY 1, 2""")
def _(m):
    path = work_dir(m.spark, "rotated")
    S.rotate_files(_l1(m), path)
    stored = m.spark.read.option("header", True).option("inferSchema", False).csv(path)
    return stored.groupBy("symbol", "rotation").agg(F.count(F.lit(1)).alias("records"))


@query("s14_load_fallback_csv", L1, dbl=L1D)
def _(m):
    path = work_dir(m.spark, "fallback")
    S.export_csv(_l1(m), path, ["symbol", "timestamp"])
    return S.load_fallback_csv(m.spark, path, L1_CSV).filter("_corrupt_record IS NULL").drop("_corrupt_record")


CUT = "2024-01-12 09:30:00"
PLACED = f"""SELECT CASE WHEN ts_exchange < TIMESTAMP '{CUT}' THEN 'archive' ELSE 'live' END AS place, * FROM book_ticker"""


@query("s15_archive", PLACED, dbl=QUOTE)
def _(m):
    path, old = _stored_quotes(m), work_dir(m.spark, "archive")
    S.archive(m.spark, path, old, CUT)
    both = [m.spark.read.parquet(p).drop("event_date").select(F.lit(n).alias("place"), "*")
            for n, p in (("live", path), ("archive", old))]
    return both[0].unionByName(both[1])


@query("r1_retention", f"SELECT * FROM book_ticker WHERE ts_exchange >= TIMESTAMP '{CUT}'", dbl=QUOTE)
def _(m):
    path = _stored_quotes(m)
    S.retention(m.spark, path, CUT)
    return m.spark.read.parquet(path).drop("event_date")


@query("r2_compact", "SELECT * FROM book_ticker", dbl=QUOTE)
def _(m):
    path = _stored_quotes(m)
    S.compact(m.spark, path, "2024-01-20")
    return m.spark.read.parquet(path).drop("event_date")


@query("r3_migrate_layout", "SELECT *, CAST(ts_exchange AS DATE) AS event_date FROM book_ticker", dbl=QUOTE)
def _(m):
    flat, path = work_dir(m.spark, "flat"), work_dir(m.spark, "migrated")
    m.bt.write.parquet(flat)
    S.migrate_layout(m.spark, flat, path)
    return m.spark.read.parquet(path)


def _live(m):
    return Market(m.spark, m.dir, streaming=True)


def _drain(*jobs):
    for job in jobs:
        job.awaitTermination()


@query("t1_stream_bars", "SELECT * FROM bt_hour", dbl=QB)
def _(m):
    root = work_dir(m.spark, "bars")
    _drain(T.store_bars(T.stream_bars(_live(m).bt, "1 hour"), f"{root}/bars", f"{root}/checkpoint", every=None))
    return T.read_bars(m.spark, f"{root}/bars")


@query("t1_stream_trade_bars", "SELECT * FROM tr_hour", dbl="vol_sum vwap buy_vol sell_vol price_open price_high price_low "
       "price_close")
def _(m):
    root = work_dir(m.spark, "trade_bars")
    bars = T.stream_bars(_live(m).tr, "1 hour", B.trade_bars)
    _drain(T.store_bars(bars, f"{root}/bars", f"{root}/checkpoint", every=None))
    return T.read_bars(m.spark, f"{root}/bars")


@query("t2_stream_dedup", "SELECT symbol_id, count(*) AS quotes, min(ts_exchange) AS first_ts FROM book_ticker GROUP BY 1")
def _(m):
    root = work_dir(m.spark, "dedup")
    once = T.stream_dedup(_live(m).redelivered, KEYS["book_ticker"])
    _drain(once.writeStream.format("parquet").option("path", f"{root}/rows").trigger(availableNow=True)
           .option("checkpointLocation", f"{root}/checkpoint").start())
    return m.spark.read.parquet(f"{root}/rows").groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("quotes"), F.min("ts_exchange").alias("first_ts"))


@query("t3_refresh_bars", "SELECT * FROM bt_hour", dbl=QB)
def _(m):
    ticks, bars = _stored_quotes(m), work_dir(m.spark, "refreshed")
    early = time_slice(m.bt, "2024-01-01", "2024-01-18 13:17:00")  # bars built before late ticks came
    S.export_parquet(B.quote_bars_mid(early, "1 hour"), bars)
    T.refresh_bars(m.spark, ticks, bars, "2024-01-18 12:00:00", "2024-02-01 00:00:00", "1 hour")
    return m.spark.read.parquet(bars).drop("event_date")


@query("t4_stream_market_data", "SELECT * FROM mk_hour", dbl=MK)
def _(m):
    root, live = work_dir(m.spark, "market"), _live(m)
    _drain(*T.stream_market_data(live.bt, live.tr, live.de, root, "1 hour", every=None))
    return T.read_market_data(m.spark, root)


@query("t5_stream_ingest", f"""SELECT 'book_ticker' AS table_name, symbol_id, count(*) AS n, sum(best_bid) AS total FROM book_ticker
       WHERE {NOT_ERROR} GROUP BY 2 UNION ALL SELECT 'trades', symbol_id, count(*), sum(price) FROM trades GROUP BY 2
       UNION ALL SELECT 'depth_events', symbol_id, count(*), sum(cents / 100.0E0) FROM depth GROUP BY 2
       UNION ALL SELECT 'rejects', NULL, count(*), 0 FROM ev WHERE event_type = 'error'""", dbl="total")
def _(m):
    root = work_dir(m.spark, "ingest")
    _drain(T.stream_ingest(_live(m).messages, m.symbols, root, f"{root}/checkpoint", every=None))

    def total(table, value):
        rows = m.spark.read.parquet(f"{root}/{table}")
        return rows.groupBy("symbol_id").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(
            F.lit(table).alias("table_name"), "symbol_id", "n", "total")

    rejects = m.spark.read.parquet(f"{root}/rejects").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("rejects").alias("table_name"), F.lit(None).cast("bigint").alias("symbol_id"), "n",
        F.lit(0.0).alias("total"))
    return (total("book_ticker", F.col("best_bid")).unionByName(total("trades", F.col("price")))
            .unionByName(total("depth_events", F.col("bids")[0]["price"])).unionByName(rejects))


BEAT = f"""SELECT symbol_id, count(*) AS messages, max(ts_exchange) AS last_message,
       (epoch_us(TIMESTAMP '{ASOF}') - epoch_us(max(ts_exchange))) / 1000000.0E0 AS lag_seconds FROM book_ticker GROUP BY 1"""


@query("t6_stream_heartbeat", f"SELECT *, CASE WHEN lag_seconds < 3600 THEN 'OK' ELSE 'STALE' END AS status FROM ({BEAT})",
       dbl="lag_seconds")
def _(m):
    root = work_dir(m.spark, "beats")
    beats = T.stream_heartbeat(_live(m).bt, "1 hour")
    _drain(T.store_bars(beats, f"{root}/beats", f"{root}/checkpoint", every=None))
    return T.heartbeat_status(T.read_bars(m.spark, f"{root}/beats", "window_start"), ASOF, stale_seconds=3600)


RATES = f"""SELECT w AS window_start, count(*) FILTER (WHERE ok) / 7200.0E0 AS rows_per_second,
       count(*) FILTER (WHERE NOT ok) / 7200.0E0 AS errors_per_second FROM (
       SELECT ok, {bucket(H)} AS w FROM log UNION ALL SELECT ok, {bucket(H)} - INTERVAL 1 HOUR FROM log) GROUP BY 1"""


@query("t7_low_ingest_alert", f"""SELECT * FROM (SELECT *, rows_per_second < 0.003 AS low_ingest, errors_per_second > 0.0008
       AS high_errors FROM ({RATES})) WHERE low_ingest OR high_errors""", dbl="rows_per_second errors_per_second")
def _(m):
    root = work_dir(m.spark, "rates")
    rates = T.ingest_rates(_live(m).ingest_log, "2 hours", "1 hour").withColumn("symbol_id", F.lit(0))
    _drain(T.store_bars(rates, f"{root}/rates", f"{root}/checkpoint", every=None))
    stored = T.read_bars(m.spark, f"{root}/rates", "window_start").drop("symbol_id")
    return T.low_ingest_alert(stored, 0.003, 0.0008)


@query("t4_stream_join_bars", "SELECT ts_second, symbol_id, mid_close, volume FROM (SELECT b.*, coalesce(t.vol_sum, 0) AS "
       "volume FROM bt_hour b LEFT JOIN tr_hour t ON t.ts_second = b.ts_second AND t.symbol_id = b.symbol_id)",
       dbl="mid_close volume")
def _(m):
    root, live = work_dir(m.spark, "live"), _live(m)
    _drain(*[T.store_bars(T.stream_bars(src, "1 hour", bars), f"{root}/{n}", f"{root}/c_{n}", every=None)
             for n, src, bars in (("q", live.bt, B.quote_bars_mid), ("t", live.tr, B.trade_bars))])
    return J.join_bars(T.read_bars(m.spark, f"{root}/q"), T.read_bars(m.spark, f"{root}/t")).select(
        "ts_second", "symbol_id", "mid_close", "volume")
