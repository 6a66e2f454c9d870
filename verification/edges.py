"""Queries of cases that the plain ones do not reach: large ids, NULL keys, long spans, broken messages, zones, silence."""

from pyspark.sql import functions as F

from tickspark.functions.time import time_bucket
from tickspark.operators import bars as B
from tickspark.operators import indicators as I
from tickspark.operators import joins as J
from tickspark.operators import micro as M
from tickspark.operators.ticks import optional_symbol_filter, time_slice
from tickspark.plans import datasets as L
from tickspark.operators.joins import BAR_KEY
from tickspark.schemas import KEYS
from tickspark.session import work_dir
from tickspark.sources import tables as S
from tickspark.sources import wire as W
from tickspark.streaming import jobs as T
from verification.bars import JOINED, MK, QB
from verification.features import CLOSES, FEATURES, closes, market
from verification.feed import L1, NOT_ERROR, QUOTE, _drain, _live, _stored_quotes
from verification.registry import D, H, bucket, query

# Ids on both sides of powers of two, many of them at one time.
LARGE = "CASE {c} % 4 WHEN 0 THEN 67108864 WHEN 1 THEN 2147483648 WHEN 2 THEN 8796093022208 ELSE 4611686018427387904 END + {c} - 500"


@query("a1_quote_bars_large_ids", f"""SELECT {bucket(D)} AS ts_second, symbol_id, first(mid ORDER BY t, id) AS mid_open,
       last(mid ORDER BY t, id) AS mid_close FROM (SELECT *, date_trunc('hour', ts_exchange) AS t, {LARGE.format(c='update_id')} AS id
       FROM quotes) GROUP BY 1, 2""", dbl="mid_open mid_close")
def _(m):
    quotes = m.bt.withColumns({"ts_exchange": F.date_trunc("hour", "ts_exchange"), "update_id": F.expr(LARGE.format(c="update_id"))})
    return B.quote_bars_mid(quotes, "1 day").select("ts_second", "symbol_id", "mid_open", "mid_close")


@query("a7_depth_bars_large_ids", f"""SELECT {bucket(D)} AS ts_bucket, symbol_id, first(bid_price ORDER BY t, id) AS first_bid_price,
       last(bid_price ORDER BY t, id) AS last_bid_price FROM (SELECT *, date_trunc('hour', ts_exchange) AS t,
       {LARGE.format(c='((final_update_id - 9) // 10)')} AS id FROM best_levels) GROUP BY 1, 2""", dbl="first_bid_price last_bid_price")
def _(m):
    number = "((final_update_id - 9) div 10)"
    books = m.de.withColumns({"ts_exchange": F.date_trunc("hour", "ts_exchange"), "final_update_id": F.expr(LARGE.format(c=number))})
    return B.depth_bars(books, "1 day").select("ts_bucket", "symbol_id", "first_bid_price", "last_bid_price")


def whole_ema(col: str, span: int, src: str, name: str, keep: str) -> str:
    q = 1 - 2 / (span + 1)
    return f"""SELECT {keep}, sum(p.{col} * pow({q!r}::DOUBLE, t.rn - p.rn)) / sum(pow({q!r}::DOUBLE, t.rn - p.rn)) AS {name}
       FROM {src} t JOIN {src} p ON p.symbol_id = t.symbol_id AND p.rn <= t.rn GROUP BY ALL"""


CLOSE = "t.hour_bucket, t.symbol_id, t.h_close, t.rn"
WITH_CLOSES = f"WITH c AS MATERIALIZED (SELECT * FROM {CLOSES})"


def _ema_query(name: str, span: int) -> None:
    @query(name, f"{WITH_CLOSES} SELECT hour_bucket, symbol_id, h_close, ema_{span} FROM ({whole_ema('h_close', span, 'c', f'ema_{span}', CLOSE)})",
           dbl=f"h_close ema_{span}")
    def _(m):
        return I.ema(closes(m), span)


_ema_query("i3_ema_long", 100)
_ema_query("i3_ema_short", 2)


@query("i4_macd_slow", f"""{WITH_CLOSES}, fast AS MATERIALIZED ({whole_ema('h_close', 24, 'c', 'e', CLOSE)}),
       slow AS MATERIALIZED ({whole_ema('h_close', 52, 'c', 'e', CLOSE)}),
       mc AS MATERIALIZED (SELECT fast.* EXCLUDE (e), fast.e - slow.e AS macd FROM fast JOIN slow USING (symbol_id, rn))
       SELECT hour_bucket, symbol_id, h_close, macd, macd_signal FROM ({whole_ema('macd', 18, 'mc', 'macd_signal', CLOSE + ', t.macd')})""",
       dbl="h_close macd macd_signal")
def _(m):
    return I.macd(closes(m), 24, 52, 18)


@query("s8_null_keys", """SELECT symbol_id, count(*) AS quotes, count(id) AS with_id FROM (
       SELECT DISTINCT symbol_id, ts_exchange, CASE WHEN update_id % 5 > 0 THEN update_id END AS id FROM book_ticker) GROUP BY 1""")
def _(m):
    path = work_dir(m.spark, "null-keys")
    quotes = m.redelivered.withColumn("update_id", F.when(F.col("update_id") % 5 > 0, F.col("update_id")))
    for _ in range(2):
        S.write_ticks_idempotent(quotes, path, KEYS["book_ticker"])
    return m.spark.read.parquet(path).groupBy("symbol_id").agg(F.count(F.lit(1)).alias("quotes"), F.count("update_id").alias("with_id"))


@query("q12_reject_reasons", f"""SELECT CASE update_id % 5 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'no stream' WHEN 2 THEN 'no data'
       WHEN 3 THEN 'unknown stream' ELSE 'missing or invalid: best_bid' END AS reject_reason, count(*) AS messages
       FROM book_ticker GROUP BY 1""")
def _(m):
    quote = F.to_json(F.struct(F.lit("x@bookTicker").alias("stream"), F.struct(
        F.lit("A").alias("s"), F.lit(1).alias("E"), F.lit("Infinity").alias("b"), F.lit("1").alias("B"), F.lit("2").alias("a"),
        F.lit("1").alias("A")).alias("data")))
    part = F.col("update_id") % 5
    text = (F.when(part == 0, F.concat(F.lit("broken "), F.col("update_id"))).when(part == 1, F.lit('{"data": {}}'))
            .when(part == 2, F.lit('{"stream": "x@bookTicker"}')).when(part == 3, F.lit('{"stream": "x@kline", "data": {}}')).otherwise(quote))
    env = W.read_envelope(m.bt.select("ts_ingest", text.alias("value")))
    bad = W.unrouted(env).unionByName(W.rejected(W.parse_book_ticker(env)))
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


@query("t5_new_symbols", f"""SELECT s.symbol, count(*) AS quotes FROM book_ticker b JOIN symbols s ON s.id = b.symbol_id
       WHERE {NOT_ERROR} GROUP BY 1""")
def _(m):
    root = work_dir(m.spark, "new-symbols")
    known = m.symbols.filter("is_active")
    _drain(T.stream_ingest(_live(m).messages, known, root, f"{root}/checkpoint", every=None))
    listed = T.registered_symbols(m.spark, known, root).select(F.col("id").alias("symbol_id"), "symbol")
    return m.spark.read.parquet(f"{root}/book_ticker").join(listed, "symbol_id").groupBy("symbol").agg(F.count(F.lit(1)).alias("quotes"))


SILENT = f"""(SELECT w AS window_start, coalesce(n, 0) / 3600.0E0 AS rows_per_second FROM (
       SELECT unnest(generate_series(min(a), TIMESTAMP '2024-02-02 05:00:00', INTERVAL 1 HOUR)) AS w FROM (SELECT min({bucket(H)}) AS a FROM ok))
       LEFT JOIN (SELECT {bucket(H)} AS w, count(*) AS n FROM ok GROUP BY 1) USING (w))"""


@query("t7_silent_windows", f"""WITH ok AS (SELECT * FROM log WHERE ok AND hour(ts_exchange) % 8 < 4)
       SELECT window_start, rows_per_second FROM (SELECT *, count(*) OVER w AS n, bool_and(rows_per_second < 0.0001) OVER w AS quiet
       FROM {SILENT} WINDOW w AS (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) WHERE quiet AND n = 3""",
       dbl="rows_per_second")
def _(m):
    heard = m.ingest_log.filter(F.col("ok") & (F.hour("ts_exchange") % 8 < 4))
    rates = T.with_silent_windows(T.ingest_rates(heard, "1 hour", "1 hour"), "2024-02-02 05:30:00", "1 hour")
    return T.low_ingest_alert(rates, 0.0001, hold=3, slide="1 hour").select("window_start", "rows_per_second")


ZONED, AT = "2024-01-12 01:30:00+02:00", "2024-01-11 23:30:00"


@query("r1_retention_zoned", f"SELECT * FROM book_ticker WHERE ts_exchange >= TIMESTAMP '{AT}'", dbl=QUOTE)
def _(m):
    path = _stored_quotes(m)
    S.retention(m.spark, path, ZONED)
    return m.spark.read.parquet(path).drop("event_date")


@query("s15_archive_zoned", f"SELECT CASE WHEN ts_exchange < TIMESTAMP '{AT}' THEN 'archive' ELSE 'live' END AS place, * FROM book_ticker", dbl=QUOTE)
def _(m):
    path, old = _stored_quotes(m), work_dir(m.spark, "archive")
    S.archive(m.spark, path, old, ZONED)
    both = [m.spark.read.parquet(p).drop("event_date").select(F.lit(n).alias("place"), "*") for n, p in (("live", path), ("archive", old))]
    return both[0].unionByName(both[1])


@query("t1_fold_bars", "SELECT 'before' AS read, * FROM bt_hour UNION ALL SELECT 'after', * FROM bt_hour", dbl=QB)
def _(m):
    root = work_dir(m.spark, "fold")
    _drain(T.store_bars(T.stream_bars(_live(m).bt, "1 hour"), f"{root}/bars", f"{root}/checkpoint", every=None))
    before = T.read_bars(m.spark, f"{root}/bars").select(F.lit("before").alias("read"), "*")
    kept = work_dir(m.spark, "fold-read")
    before.write.parquet(kept)
    for _ in range(2):
        T.fold_bars(m.spark, f"{root}/bars", "2024-01-20 00:00:00")
    after = T.read_bars(m.spark, f"{root}/bars").select(F.lit("after").alias("read"), "*")
    return m.spark.read.parquet(kept).unionByName(after)


@query("w3_rolling_by_time", """SELECT ts_second, symbol_id, mid_close, avg(mid_close) OVER w AS sma_5min,
       stddev_samp(mid_close) OVER w AS volatility_5min FROM bt_hour WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_second
       RANGE BETWEEN INTERVAL 30 HOUR PRECEDING AND CURRENT ROW)""", dbl="mid_close sma_5min volatility_5min")
def _(m):
    bars = B.quote_bars_mid(m.bt, "1 hour").select("ts_second", "symbol_id", "mid_close")
    return I.rolling_sma_vol_range(bars, "30 hours")  # longer than a block


@query("p10_many_symbols", "SELECT * FROM book_ticker WHERE symbol_id IN (SELECT id FROM symbols WHERE is_active)", dbl=QUOTE)
def _(m):
    return optional_symbol_filter(m.bt, m.symbols.filter("is_active").select(F.col("id").alias("symbol_id")))


@query("t3_refresh_topn", "SELECT ts_exchange, symbol_id, final_update_id, b1_price, a1_price, i5 FROM topn", dbl="b1_price a1_price i5")
def _(m):
    depth, book = work_dir(m.spark, "depth"), work_dir(m.spark, "book")
    S.write_partitioned(S.with_event_date(m.de), depth, ["symbol_id", "ts_exchange"])
    S.export_parquet(M.flatten_topn(time_slice(m.de, "2024-01-01", "2024-01-18 13:17:00")), book, "ts_exchange")
    T.refresh_topn(m.spark, depth, book, "2024-01-18 12:00:00", "2024-02-01 00:00:00")
    return m.spark.read.parquet(book).select("ts_exchange", "symbol_id", "final_update_id", "b1_price", "a1_price", "i5")


@query("t3_refresh_features", f"SELECT ts_exchange, symbol_id, microprice, ofi, vpin, price_volatility, return_1s FROM ({FEATURES})",
       dbl="microprice ofi vpin price_volatility return_1s")
def _(m):
    bars, path = work_dir(m.spark, "joined-bars"), work_dir(m.spark, "feature-days")
    S.write_partitioned(S.with_event_date(market(m), "ts_bucket"), bars, ["symbol_id", "ts_bucket"])
    stored = m.spark.read.parquet(bars).drop("event_date")
    S.export_parquet(M.market_features(time_slice(stored, "2024-01-01", "2024-01-18 13:17:00", "ts_bucket")), path, "ts_exchange")
    T.refresh_features(m.spark, bars, path, "2024-01-18 12:00:00", "2024-02-01 00:00:00")
    return m.spark.read.parquet(path).select("ts_exchange", "symbol_id", "microprice", "ofi", "vpin", "price_volatility", "return_1s")


NULL_KEYS = "CASE WHEN symbol_id % 5 > 0 THEN symbol_id END AS symbol_id"


@query("w3_null_keys", f"""SELECT ts_second, symbol_id, mid_close, avg(mid_close) OVER w AS sma_5min FROM (
       SELECT {NULL_KEYS}, ts_second, min(mid_close) AS mid_close FROM bt_hour GROUP BY ALL)
       WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_second ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)""", dbl="mid_close sma_5min")
def _(m):
    bars = B.quote_bars_mid(m.bt, "1 hour").withColumn("symbol_id", F.when(F.col("symbol_id") % 5 > 0, F.col("symbol_id")))
    bars = bars.groupBy("symbol_id", "ts_second").agg(F.min("mid_close").alias("mid_close"))
    return I.rolling_sma_vol(bars, 20).select("ts_second", "symbol_id", "mid_close", "sma_5min")


@query("l6_null_keys", f"""SELECT ts_second, symbol_id, mid_close, (mid_close - avg(mid_close) OVER w) / (stddev_samp(mid_close) OVER w + 1e-9) AS z_mid_close
       FROM (SELECT {NULL_KEYS}, ts_second, min(mid_close) AS mid_close FROM bt_hour GROUP BY ALL) WINDOW w AS (PARTITION BY symbol_id)""",
       dbl="mid_close z_mid_close")
def _(m):
    bars = B.quote_bars_mid(m.bt, "1 hour").withColumn("symbol_id", F.when(F.col("symbol_id") % 5 > 0, F.col("symbol_id")))
    bars = bars.groupBy("symbol_id", "ts_second").agg(F.min("mid_close").alias("mid_close"))
    return L.zscore(bars, ["mid_close"])


THIN = f"""WITH thin AS MATERIALIZED (SELECT * FROM mk_hour QUALIFY row_number() OVER (PARTITION BY symbol_id, CAST(ts_bucket AS DATE)
       ORDER BY ts_bucket) = 1) SELECT ts_exchange, symbol_id, microprice, ofi, vpin, price_volatility, return_1s
       FROM ({FEATURES.replace("mk_hour", "thin")})"""


@query("t3_refresh_thin", THIN, dbl="microprice ofi vpin price_volatility return_1s")
def _(m):
    """One bar a day: what the features look back at lies many days before the days refreshed."""
    bars, path = work_dir(m.spark, "thin-bars"), work_dir(m.spark, "thin-features")
    hourly = market(m)
    first = hourly.groupBy("symbol_id", F.to_date("ts_bucket").alias("day")).agg(F.min("ts_bucket").alias("ts_bucket")).drop("day")
    S.write_partitioned(S.with_event_date(hourly.join(first, ["symbol_id", "ts_bucket"], "left_semi"), "ts_bucket"), bars, ["symbol_id", "ts_bucket"])
    stored = m.spark.read.parquet(bars).drop("event_date")
    S.export_parquet(M.market_features(time_slice(stored, "2024-01-01", "2024-01-18 13:17:00", "ts_bucket")), path, "ts_exchange")
    for start, end in (("2024-01-18 12:00:00", "2024-01-19"), ("2024-01-19", "2024-01-25"), ("2024-01-25", "2024-02-01")):
        T.refresh_features(m.spark, bars, path, start, end)
    return m.spark.read.parquet(path).select("ts_exchange", "symbol_id", "microprice", "ofi", "vpin", "price_volatility", "return_1s")


@query("r2_compact_twice", f"SELECT *, 0 AS rewritten FROM book_ticker", dbl=QUOTE, big="rewritten")
def _(m):
    """The second run rewrites no day."""
    path = work_dir(m.spark, "fragments")
    quotes = S.with_event_date(m.bt)
    for part in range(3):
        S.write_partitioned(quotes.filter(F.col("update_id") % 3 == part), path, ["symbol_id", "ts_exchange"])
    S.compact(m.spark, path, "2024-01-20")
    again = len(S.compact(m.spark, path, "2024-01-20"))
    return m.spark.read.parquet(path).drop("event_date").withColumn("rewritten", F.lit(again))


@query("s13_rotate_twice", f"""SELECT symbol, strftime(make_timestamp(timestamp // {D} * {D}), '%Y%m%d_%H%M%S') AS rotation,
       count(*) AS records FROM ({L1}) GROUP BY 1, 2""")
def _(m):
    path = work_dir(m.spark, "rotated-twice")
    for _ in range(2):
        S.rotate_files(W.depth_to_l1(W.read_envelope(m.messages), "spot"), path)
    stored = m.spark.read.option("header", True).option("inferSchema", False).csv(path)
    return stored.groupBy("symbol", "rotation").agg(F.count(F.lit(1)).alias("records"))


def _bucketed(m, by, **tables):
    """Each of ``tables`` stored in buckets of its symbols and times, in two runs, and read from there."""
    out = {}
    for name, df in tables.items():
        path = work_dir(m.spark, f"bucketed-{name}")
        table = f"bars_{path.rsplit('-', 1)[1]}"
        for _ in range(2):
            out[name] = S.write_bucketed(df, table, path, by, buckets=8).drop("event_date")
    return out


@query("j1_join_bucketed", JOINED, dbl=QB + " volume vwap buy_volume sell_volume buy_sell_imbalance")
def _(m):
    stored = _bucketed(m, BAR_KEY, quotes=B.quote_bars_mid(m.bt, "1 hour"), trades=B.trade_bars(m.tr, "1 hour"))
    return J.join_bars(stored["quotes"], stored["trades"])


@query("j3_market_data_bucketed", "SELECT * FROM mk_hour", dbl=MK)
def _(m):
    return J.market_data_bars(*_bucketed(
        m, ["symbol_id", "ts_bucket"], quotes=B.quote_bars_bidask(m.bt, "1 hour"), trades=B.trade_bars_ext(m.tr, "1 hour"),
        depth=B.depth_bars(m.de, "1 hour")).values())


@query("j4_range_join_bucketed", """SELECT b.ts_second, b.symbol_id, b.mid_close, b.spread_mean, o.ts_exchange AS book_ts,
       o.i1, o.i5, o.microprice FROM bt_hour b LEFT JOIN topn o ON o.symbol_id = b.symbol_id
       AND o.ts_exchange >= b.ts_second AND o.ts_exchange < b.ts_second + INTERVAL 1 HOUR""",
       dbl="mid_close spread_mean i1 i5 microprice")
def _(m):
    books = M.flatten_topn(m.de).withColumn("ts_second", time_bucket("ts_exchange", "1 hour"))
    stored = _bucketed(m, BAR_KEY, bars=B.quote_bars_mid(m.bt, "1 hour"), books=books)
    return J.range_join_topn(stored["bars"], stored["books"])
