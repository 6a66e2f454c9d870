"""M, W, I and L queries."""

from pyspark.sql import functions as F

from tickspark.operators import bars as B
from tickspark.operators import indicators as I
from tickspark.operators import joins as J
from tickspark.operators import micro as M
from tickspark.operators import profile as P
from tickspark.operators import ticks as K
from tickspark.plans import datasets as L
from verification.bars import DEPTH_HOURLY, DH, JOINED, MK, OHLC, QB, ROLLUP
from verification.registry import ASOF, DAY, H, MICRO, canonical, query, rounded

QUOTE = "best_bid best_ask bid_qty ask_qty"
OFI = ("CASE WHEN p{b} IS NULL THEN 0 ELSE "
       "CASE WHEN abs({b} - p{b}) < 1e-8 THEN {bq} - p{bq} WHEN {b} > p{b} THEN {bq} ELSE -p{bq} END + "
       "CASE WHEN abs({a} - p{a}) < 1e-8 THEN {sign}({aq} - p{aq}) WHEN {a} < p{a} THEN -{aq} ELSE p{aq} END END")


def ofi_sql(b, a, bq, aq, sign=""):
    return OFI.format(b=b, a=a, bq=bq, aq=aq, sign=sign)


def lagged(cols, order, part="symbol_id"):
    return ", ".join(f"lag({c}) OVER (PARTITION BY {part} ORDER BY {order}) AS p{c}" for c in cols)


def market(m, w="1 hour"):
    return J.market_data_bars(B.quote_bars_bidask(m.bt, w), B.trade_bars_ext(m.tr, w), B.depth_bars(m.de, w))


def hour_bars(m):
    return B.quote_bars_mid(m.bt, "1 hour"), B.trade_bars(m.tr, "1 hour")


def hourly(m):
    return B.hourly_rollup(*hour_bars(m))


HOURLY = ROLLUP.format(b="SELECT * FROM bt_hour", t="SELECT * FROM tr_hour")
HB = "h_open h_high h_low h_close h_volume h_avg_spread h_volatility h_buy_vol h_sell_vol"


@query("m1_microprice", f"SELECT update_id, {MICRO} AS microprice FROM book_ticker", dbl="microprice")
def _(m):
    return M.with_microprice(m.bt).select("update_id", "microprice")


@query("m2_i1", """SELECT update_id, CASE WHEN bid_qty + ask_qty = 0 THEN 0 ELSE (bid_qty - ask_qty) /
       nullif(bid_qty + ask_qty, 0) END AS i1 FROM book_ticker""", dbl="i1")
def _(m):
    return M.with_imbalance(m.bt).select("update_id", "i1")


@query("m3_depth_imbalance", """SELECT final_update_id, CASE WHEN b5 + a5 = 0 THEN 0 ELSE (b5 - a5) / (b5 + a5) END AS i5,
       CASE WHEN b3 + a3 = 0 THEN 0 ELSE (b3 - a3) / (b3 + a3) END AS i3 FROM (
       SELECT final_update_id, sum(qty) FILTER (WHERE side = 'b') AS b5, sum(qty) FILTER (WHERE side = 'a') AS a5,
       sum(qty) FILTER (WHERE side = 'b' AND i < 3) AS b3, sum(qty) FILTER (WHERE side = 'a' AND i < 3) AS a3
       FROM levels GROUP BY 1)""", dbl="i5 i3")
def _(m):
    return M.with_depth_imbalance(M.with_depth_imbalance(m.de, 5), 3).select("final_update_id", "i5", "i3")


TICK_LAG = lagged(QUOTE.split(), "ts_exchange, update_id")


@query("m4_ofi_events", f"""SELECT symbol_id, ts_exchange, update_id, best_bid, best_ask, bid_qty, ask_qty,
       {ofi_sql(*QUOTE.split())} AS ofi FROM (SELECT *, {TICK_LAG} FROM book_ticker)""", dbl=QUOTE + " ofi")
def _(m):
    return M.ofi_events(m.bt)


@query("m4_ofi_events_standard", f"""SELECT symbol_id, ts_exchange, update_id, {ofi_sql(*QUOTE.split(), sign='-')} AS ofi
       FROM (SELECT *, {TICK_LAG} FROM book_ticker)""", dbl="ofi")
def _(m):
    return M.ofi_events(m.bt, ask_sign="standard").select("symbol_id", "ts_exchange", "update_id", "ofi")


@query("m5_ofi_within_bucket", """SELECT *, bid_flow + ask_flow AS ofi, bid_flow / nullif(bid_flow + abs(ask_flow)
       + 0.0001, 0) AS ofi_ratio FROM (SELECT ts_bucket, symbol_id, last_bid_price AS bid_price, last_ask_price
       AS ask_price, CASE WHEN last_bid_price = first_bid_price THEN last_bid_qty - first_bid_qty ELSE last_bid_qty END
       AS bid_flow, CASE WHEN last_ask_price = first_ask_price THEN last_ask_qty - first_ask_qty ELSE -last_ask_qty END
       AS ask_flow FROM de_day)""", dbl="bid_price ask_price bid_flow ask_flow ofi ofi_ratio")
def _(m):
    return M.ofi_within_bucket(B.depth_bars(m.de, "1 day"))


SPLIT = """SELECT * REPLACE (
       CASE WHEN volume IS NULL THEN NULL WHEN coalesce(buy_volume, 0) = 0 AND coalesce(sell_volume, 0) = 0
            THEN volume * coalesce(buy_ratio, 0.5) ELSE coalesce(buy_volume, 0) END AS buy_volume,
       CASE WHEN volume IS NULL THEN NULL WHEN coalesce(buy_volume, 0) = 0 AND coalesce(sell_volume, 0) = 0
            THEN volume * (1 - coalesce(buy_ratio, 0.5)) ELSE coalesce(sell_volume, 0) END AS sell_volume)
       FROM mk_hour"""
VPIN = f"""SELECT symbol_id, ts_bucket, CASE WHEN seen < 2 THEN 0 ELSE abs(buy_volume - sell_volume) / mean END AS vpin
       FROM (SELECT symbol_id, ts_bucket, buy_volume, sell_volume, count(*) OVER w AS seen,
             avg(buy_volume + sell_volume) OVER w AS mean FROM ({SPLIT}) WHERE buy_volume + sell_volume > 0
             WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_bucket ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""


@query("m6_vpin_like", f"""SELECT b.ts_bucket, b.symbol_id, v.vpin FROM mk_hour b LEFT JOIN ({VPIN}) v
       ON v.symbol_id = b.symbol_id AND v.ts_bucket = b.ts_bucket""", dbl="vpin")
def _(m):
    return M.vpin_like(M.split_volume(market(m))).select("ts_bucket", "symbol_id", "vpin")


RETURNS = """SELECT *, lag(mid_price) OVER w AS prev_mid FROM (SELECT *, (bid_close + ask_close) / 2 AS mid_price
       FROM mk_hour) WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_bucket)"""
VOL = f"""SELECT *, coalesce(stddev_pop(r) OVER (PARTITION BY symbol_id ORDER BY ts_bucket
       ROWS BETWEEN 8 PRECEDING AND CURRENT ROW), 0) AS price_volatility FROM (
       SELECT *, CASE WHEN prev_mid > 0 THEN CASE WHEN mid_price > 0 THEN ln(mid_price / prev_mid) END
                      WHEN prev_mid <= 0 THEN 0 END AS r FROM ({RETURNS}))"""


@query("m7_log_return", f"""SELECT ts_bucket, symbol_id, CASE WHEN prev_mid > 0 AND mid_price > 0 THEN
       ln(mid_price / prev_mid) END AS return_1s FROM ({RETURNS})""", dbl="return_1s")
def _(m):
    return M.log_return(market(m)).select("ts_bucket", "symbol_id", "return_1s")


@query("m8_rolling_volatility", f"SELECT ts_bucket, symbol_id, price_volatility FROM ({VOL})", dbl="price_volatility")
def _(m):
    return M.rolling_volatility(market(m)).select("ts_bucket", "symbol_id", "price_volatility")


RATIOS = """CASE WHEN buy_volume + sell_volume > 0 THEN (buy_volume - sell_volume) / (buy_volume + sell_volume) ELSE 0 END
       AS volume_imbalance, CASE WHEN buy_volume + sell_volume > 0 THEN buy_volume / (buy_volume + sell_volume)
       ELSE 0.5 END AS buy_volume_ratio"""


@query("m9_volume_ratios", f"SELECT ts_bucket, symbol_id, {RATIOS} FROM mk_hour", dbl="volume_imbalance buy_volume_ratio")
def _(m):
    return M.with_volume_ratios(market(m)).select("ts_bucket", "symbol_id", "volume_imbalance", "buy_volume_ratio")


@query("m10_split_volume", f"SELECT ts_bucket, symbol_id, volume, buy_volume, sell_volume FROM ({SPLIT})",
       dbl="volume buy_volume sell_volume")
def _(m):
    return M.split_volume(market(m)).select("ts_bucket", "symbol_id", "volume", "buy_volume", "sell_volume")


CLOSE = ["bid_close", "ask_close", "bid_qty_close", "ask_qty_close"]
FEATURES = f"""SELECT f.ts_bucket AS ts_exchange, f.symbol_id, CASE WHEN bid_qty_close + ask_qty_close = 0 THEN mid_price ELSE
       (bid_close * ask_qty_close + ask_close * bid_qty_close) / nullif(bid_qty_close + ask_qty_close, 0) END AS microprice,
       mid_price, ask_close - bid_close AS spread_abs, CASE WHEN mid_price > 0 THEN (ask_close - bid_close) / mid_price
       ELSE 0 END AS spread_rel, CASE WHEN bid_qty_close + ask_qty_close = 0 THEN 0 ELSE (bid_qty_close - ask_qty_close) /
       nullif(bid_qty_close + ask_qty_close, 0) END AS i1, i1 AS i10, {ofi_sql(*CLOSE)} AS ofi, {RATIOS}, v.vpin,
       price_volatility, CASE WHEN prev_mid > 0 AND mid_price > 0 THEN ln(mid_price / prev_mid) END AS return_1s
       FROM (SELECT *, {lagged(CLOSE, 'ts_bucket')} FROM ({VOL})) f
       LEFT JOIN ({VPIN}) v ON v.symbol_id = f.symbol_id AND v.ts_bucket = f.ts_bucket"""
FEATS = ("microprice mid_price spread_abs spread_rel i1 i10 ofi volume_imbalance buy_volume_ratio vpin price_volatility "
         "return_1s")


@query("m11_market_features", FEATURES, dbl=FEATS)
def _(m):
    return M.market_features(market(m))


FLAT = " ".join(f"{s}{i}_{v}" for s in "ba" for i in range(1, 6) for v in ("price", "qty"))


@query("m12_flatten_topn", "SELECT * FROM topn", dbl=FLAT + " total_bid_qty total_ask_qty microprice i1 i5 wall_size_bid "
       "wall_size_ask wall_dist_bid_bps wall_dist_ask_bps wall_size_bps")
def _(m):
    return M.flatten_topn(m.de)


@query("m13_book_walls", """SELECT ts_exchange, symbol_id, final_update_id, wall_size_bid, wall_size_ask, wall_dist_bid_bps,
       wall_dist_ask_bps FROM topn""", dbl="wall_size_bid wall_size_ask wall_dist_bid_bps wall_dist_ask_bps")
def _(m):
    return M.book_walls(M.flatten_topn(m.de))


BEST = ["b1_price", "a1_price", "b1_qty", "a1_qty"]


@query("m14_ofi_rolling", f"""SELECT symbol_id, ts_exchange, final_update_id, ofi, sum(ofi) OVER (PARTITION BY symbol_id
       ORDER BY epoch_us(ts_exchange) RANGE BETWEEN {H} PRECEDING AND CURRENT ROW) AS ofi_1s FROM (
       SELECT symbol_id, ts_exchange, final_update_id, {ofi_sql(*BEST)} AS ofi FROM (
         SELECT *, {lagged(BEST, 'ts_exchange, final_update_id')} FROM topn))""", dbl="ofi ofi_1s")
def _(m):
    return M.ofi_rolling(M.flatten_topn(m.de), "1 hour", "1 day")


@query("m15_microprice_deviation", f"SELECT update_id, abs(({MICRO}) - mid) AS microprice_deviation FROM quotes",
       dbl="microprice_deviation")
def _(m):
    return M.with_microprice_deviation(m.bt).select("update_id", "microprice_deviation")


@query("m16_tick_imbalance", "SELECT update_id, (bid_qty - ask_qty) / nullif(bid_qty + ask_qty, 0) AS ofi FROM book_ticker",
       dbl="ofi")
def _(m):
    return M.with_tick_imbalance(m.bt).select("update_id", "ofi")


DECIMALS = {"microprice": "20, 8", "spread_rel": "10, 6", "ofi": "20, 4", "buy_volume_ratio": "10, 6",
            "price_volatility": "10, 6"}


@query("p12_decimal_to_double", "SELECT ts_exchange, symbol_id, " + ", ".join(
    f"CAST({rounded(c)} AS DECIMAL({p})) AS {c}" for c, p in DECIMALS.items()) + f" FROM ({FEATURES})",
    dbl=" ".join(DECIMALS))
def _(m):
    features = K.to_feature_decimals(canonical(M.market_features(market(m))))
    return K.decimal_to_double(features).select("ts_exchange", "symbol_id", *DECIMALS)


@query("p13_to_feature_decimals", "SELECT ts_exchange, symbol_id, " + ", ".join(
    f"CAST(CAST({rounded(c)} AS DECIMAL({p})) AS VARCHAR) AS {c}" for c, p in DECIMALS.items()) + f" FROM ({FEATURES})")
def _(m):
    features = K.to_feature_decimals(canonical(M.market_features(market(m))))
    return features.select("ts_exchange", "symbol_id", *[F.col(c).cast("string").alias(c) for c in DECIMALS])


SUMMARY = ["microprice", "spread_rel", "i1", "ofi", "volume_imbalance", "buy_volume_ratio", "price_volatility"]


@query("d8_feature_summary", f"WITH f AS MATERIALIZED ({FEATURES}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, avg({c}) AS mean, stddev_pop({c}) AS std, min({c}) AS min, "
    f"max({c}) AS max, count(*) AS total_records, count(DISTINCT symbol_id) AS symbols, min(ts_exchange) AS range_start, "
    f"max(ts_exchange) AS range_end FROM f" for c in SUMMARY), dbl="mean std min max")
def _(m):
    return P.feature_summary(M.market_features(market(m)))


TABLE_PAIR = """SELECT b.*, t.trade_count, t.volume_sum, t.vwap, t.imbalance_ratio FROM bt_hour b
       LEFT JOIN trt_hour t ON t.ts_second = b.ts_second AND t.symbol_id = b.symbol_id"""


def table_bars(m):
    return B.quote_bars_mid(m.bt, "1 hour"), B.trade_bars_table(m.tr, "1 hour")


@query("w1_lag_features", f"""SELECT ts_second, symbol_id, mid_close, imbalance_ratio, lag(mid_close) OVER w AS prev_mid,
       lag(imbalance_ratio) OVER w AS prev_imbalance FROM ({TABLE_PAIR})
       WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_second)""", dbl="mid_close imbalance_ratio prev_mid prev_imbalance")
def _(m):
    bars = J.pair_bars(*table_bars(m), ["imbalance_ratio"])
    return I.lag_features(bars).select("ts_second", "symbol_id", "mid_close", "imbalance_ratio", "prev_mid", "prev_imbalance")


@query("w2_hour_lags", f"""SELECT *, lag(h_close) OVER w AS prev_h_close, lag(h_volume) OVER w AS prev_h_volume FROM ({HOURLY})
       WINDOW w AS (PARTITION BY symbol_id ORDER BY hour_bucket)""", dbl=HB + " prev_h_close prev_h_volume")
def _(m):
    return I.hour_lags(hourly(m))


ROLL = """avg(mid_close) OVER w AS sma_5min, stddev_samp(mid_close) OVER w AS volatility_5min"""
ROLL_W = "WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_second ROWS BETWEEN 300 PRECEDING AND CURRENT ROW)"


@query("w3_rolling_sma_vol", f"SELECT ts_second, symbol_id, mid_close, {ROLL} FROM bt_hour {ROLL_W}",
       dbl="mid_close sma_5min volatility_5min")
def _(m):
    return I.rolling_sma_vol(B.quote_bars_mid(m.bt, "1 hour").select("ts_second", "symbol_id", "mid_close"))


FORWARD = """SELECT *, (mid_t_plus_5 - mid_close) / nullif(mid_close, 0) AS ret_5s FROM (SELECT *, lead(mid_close, 5) OVER (
       PARTITION BY symbol_id ORDER BY ts_second) AS mid_t_plus_5 FROM {src}) WHERE mid_t_plus_5 IS NOT NULL"""


@query("w4_forward_return", "SELECT ts_second, symbol_id, mid_close, mid_t_plus_5, ret_5s FROM ("
       + FORWARD.format(src="bt_hour") + ")", dbl="mid_close mid_t_plus_5 ret_5s")
def _(m):
    return I.forward_return(B.quote_bars_mid(m.bt, "1 hour").select("ts_second", "symbol_id", "mid_close"))


def closes(m):
    return hourly(m).select("hour_bucket", "symbol_id", "h_close")


CLOSES = f"(SELECT hour_bucket, symbol_id, h_close, row_number() OVER (PARTITION BY symbol_id ORDER BY hour_bucket) AS rn FROM ({HOURLY}))"


def full(agg, col, n):
    return (f"CASE WHEN rn >= {n} THEN {agg}({col}) OVER (PARTITION BY symbol_id ORDER BY hour_bucket "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END")


@query("i1_sma", f"SELECT hour_bucket, symbol_id, h_close, {full('avg', 'h_close', 5)} AS sma_5, "
       f"{full('avg', 'h_close', 20)} AS sma_20 FROM {CLOSES}", dbl="h_close sma_5 sma_20")
def _(m):
    return I.sma(closes(m), [5, 20])


RSI = f"""SELECT *, CASE WHEN loss > 0 THEN 100 - 100 / (1 + gain / loss) WHEN gain > 0 THEN 100 END AS rsi FROM (
       SELECT *, {full('avg', 'greatest(delta, 0)', 14)} AS gain, {full('avg', 'greatest(-delta, 0)', 14)} AS loss FROM (
       SELECT *, coalesce(h_close - lag(h_close) OVER (PARTITION BY symbol_id ORDER BY hour_bucket), 0) AS delta
       FROM {CLOSES}))"""


@query("i2_rsi", f"SELECT hour_bucket, symbol_id, h_close, rsi FROM ({RSI})", dbl="h_close rsi")
def _(m):
    return I.rsi(closes(m))


def ema_sql(col, span, src, name, keep):
    q = 1 - 2 / (span + 1)
    return f"""SELECT {', '.join('t.' + c for c in keep)}, sum(p.{col} * pow({q!r}::DOUBLE, t.rn - p.rn)) /
       sum(pow({q!r}::DOUBLE, t.rn - p.rn)) AS {name}
       FROM ({src}) t JOIN ({src}) p ON p.symbol_id = t.symbol_id AND p.rn <= t.rn AND p.rn > t.rn - 560
       GROUP BY ALL"""


KEEP = ["hour_bucket", "symbol_id", "h_close", "rn"]


@query("i3_ema", f"WITH c AS MATERIALIZED (SELECT * FROM {CLOSES}) SELECT hour_bucket, symbol_id, h_close, ema_12 FROM ("
       + ema_sql("h_close", 12, "SELECT * FROM c", "ema_12", KEEP) + ")", dbl="h_close ema_12")
def _(m):
    return I.ema(closes(m), 12)


MACD_CTES = f"""WITH c AS MATERIALIZED (SELECT * FROM {CLOSES}),
       fast AS MATERIALIZED ({ema_sql('h_close', 12, 'SELECT * FROM c', 'e', KEEP)}),
       slow AS MATERIALIZED ({ema_sql('h_close', 26, 'SELECT * FROM c', 'e', KEEP)}),
       mc AS MATERIALIZED (SELECT fast.* EXCLUDE (e), fast.e - slow.e AS macd FROM fast JOIN slow USING (symbol_id, rn)),
       sig AS MATERIALIZED ({ema_sql('macd', 9, 'SELECT * FROM mc', 'macd_signal', [*KEEP, 'macd'])})"""


@query("i4_macd", f"{MACD_CTES} SELECT hour_bucket, symbol_id, h_close, macd, macd_signal FROM sig",
       dbl="h_close macd macd_signal")
def _(m):
    return I.macd(closes(m))


BANDS = f"""SELECT hour_bucket, symbol_id, h_close, s20 + 2 * d20 AS bb_upper, s20 - 2 * d20 AS bb_lower,
       (h_close - (s20 - 2 * d20)) / nullif((s20 + 2 * d20) - (s20 - 2 * d20), 0) AS bb_position FROM (
       SELECT *, {full('avg', 'h_close', 20)} AS s20, {full('stddev_samp', 'h_close', 20)} AS d20 FROM {CLOSES})"""


@query("i5_bollinger", BANDS, dbl="h_close bb_upper bb_lower bb_position")
def _(m):
    return I.bollinger(closes(m))


HRET = f"""SELECT *, (h_close - h_open) / nullif(h_open, 0) AS h_return, (h_high - h_low) / nullif(h_open, 0) AS h_range,
       CASE WHEN h_buy_vol + h_sell_vol > 0 THEN h_buy_vol / (h_buy_vol + h_sell_vol) ELSE 0.5 END AS h_buy_ratio
       FROM ({HOURLY})"""


@query("i6_hourly_returns", HRET, dbl=HB + " h_return h_range h_buy_ratio")
def _(m):
    return I.hourly_returns(hourly(m))


ON_DAY = f"ts_second >= TIMESTAMP '{DAY}' AND ts_second < TIMESTAMP '{DAY}' + INTERVAL 1 DAY"


@query("l1_yesterday_dataset", f"""SELECT ts_second, symbol, mid_open, mid_high, mid_low, mid_close, spread_mean, trade_count,
       volume_sum, vwap, imbalance_ratio, lag(mid_close) OVER w AS prev_mid, lag(imbalance_ratio) OVER w AS prev_imbalance
       FROM ({TABLE_PAIR}) b JOIN active ON id = symbol_id WHERE {ON_DAY}
       WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_second)""",
       dbl=OHLC + " spread_mean volume_sum vwap imbalance_ratio prev_mid prev_imbalance")
def _(m):
    return L.yesterday_dataset(*table_bars(m), m.symbols, DAY)


@query("l2_training_day", f"""SELECT j.* EXCLUDE (symbol_id), s.symbol, j.symbol_id,
       epoch_us(ts_second) / 1000000.0E0 AS timestamp, hour(ts_second) AS hour, dayofweek(ts_second) AS day_of_week
       FROM ({JOINED}) j JOIN active s ON s.id = j.symbol_id WHERE {ON_DAY}""",
       dbl=QB + " volume vwap buy_volume sell_volume buy_sell_imbalance timestamp", big="hour day_of_week")
def _(m):
    return L.training_day(*hour_bars(m), m.symbols, DAY)


@query("n1_training_rows", f"""SELECT b.ts_second, b.symbol_id, mid_close, spread_mean, coalesce(trade_count, 0) AS trade_count,
       vwap, CASE WHEN buy_vol + sell_vol > 0 THEN (buy_vol - sell_vol) / (buy_vol + sell_vol) ELSE 0 END
       AS buy_sell_imbalance FROM bt_hour b LEFT JOIN tr_hour t ON t.ts_second = b.ts_second
       AND t.symbol_id = b.symbol_id WHERE {ON_DAY.replace('ts_second', 'b.ts_second')}""",
       dbl="mid_close spread_mean vwap buy_sell_imbalance")
def _(m):
    return m.spark.table(L.training_view(*hour_bars(m), DAY))


@query("n2_ordered_aggregates", """SELECT symbol_id, first(best_bid ORDER BY ts_exchange, update_id) AS first_bid,
       last(best_bid ORDER BY ts_exchange, update_id) AS last_bid FROM book_ticker GROUP BY 1""", dbl="first_bid last_bid")
def _(m):
    at = F.struct(*K.TICK_ORDER)
    return m.bt.groupBy("symbol_id").agg(F.min_by("best_bid", at).alias("first_bid"), F.max_by("best_bid", at).alias("last_bid"))


def hourly_features_sql(start, end):
    """End is exclusive."""
    cut = HOURLY.replace("SELECT * FROM bt_hour", f"SELECT * FROM bt_hour WHERE ts_second >= TIMESTAMP '{start}' "
                         f"AND ts_second < TIMESTAMP '{end}'")
    ctes = MACD_CTES.replace(HOURLY, cut)
    depth = DEPTH_HOURLY.replace("FROM topn", f"FROM topn WHERE ts_exchange >= TIMESTAMP '{start}' "
                                 f"AND ts_exchange < TIMESTAMP '{end}'")
    return f"""{ctes}, r AS MATERIALIZED ({HRET.replace(HOURLY, cut)}), rs AS ({RSI.replace(HOURLY, cut)}),
       bb AS ({BANDS.replace(HOURLY, cut)})
       SELECT r.hour_bucket, r.symbol_id, s.symbol, r.h_open, r.h_high, r.h_low, r.h_close, r.h_volume, r.h_avg_spread,
       r.h_volatility, r.h_updates, r.h_return, r.h_range, r.h_buy_ratio,
       lag(r.h_close) OVER w AS prev_h_close, lag(r.h_volume) OVER w AS prev_h_volume,
       {full('avg', 'r.h_close', 5).replace('rn >=', 'sig.rn >=').replace('symbol_id', 'r.symbol_id').replace('hour_bucket', 'r.hour_bucket')} AS sma_5,
       {full('avg', 'r.h_close', 20).replace('rn >=', 'sig.rn >=').replace('symbol_id', 'r.symbol_id').replace('hour_bucket', 'r.hour_bucket')} AS sma_20,
       rs.rsi, sig.macd, sig.macd_signal, bb.bb_upper, bb.bb_lower, bb.bb_position,
       epoch_us(r.hour_bucket) / 1000000.0E0 AS timestamp, d.* EXCLUDE (hour_bucket, symbol_id)
       FROM r JOIN symbols s ON s.id = r.symbol_id
       JOIN sig ON sig.symbol_id = r.symbol_id AND sig.hour_bucket = r.hour_bucket
       JOIN rs ON rs.symbol_id = r.symbol_id AND rs.hour_bucket = r.hour_bucket
       JOIN bb ON bb.symbol_id = r.symbol_id AND bb.hour_bucket = r.hour_bucket
       LEFT JOIN ({depth}) d ON d.symbol_id = r.symbol_id AND d.hour_bucket = r.hour_bucket
       WINDOW w AS (PARTITION BY r.symbol_id ORDER BY r.hour_bucket)"""


HF = ("h_open h_high h_low h_close h_volume h_avg_spread h_volatility h_return h_range h_buy_ratio prev_h_close "
      "prev_h_volume sma_5 sma_20 rsi macd macd_signal bb_upper bb_lower bb_position timestamp " + DH)


@query("l3_hourly_ml_features", hourly_features_sql("2024-01-05", "2024-01-26"), dbl=HF)
def _(m):
    return L.hourly_ml_features(*hour_bars(m), m.symbols, "2024-01-05", "2024-01-25", topn=M.flatten_topn(m.de))


@query("l4_realtime_features", f"""SELECT ts_second, symbol, symbol_id, mid_close AS price, spread_mean AS spread,
       total_qty_mean AS liquidity, update_count, volume, vwap, {ROLL}, epoch_us(ts_second) / 1000000.0E0 AS timestamp
       FROM ({JOINED}) j JOIN active ON id = symbol_id WHERE ts_second >= TIMESTAMP '{ASOF}' - INTERVAL 10 DAY {ROLL_W}""",
       dbl="price spread liquidity volume vwap sma_5min volatility_5min timestamp")
def _(m):
    return L.realtime_features(*hour_bars(m), m.symbols, ASOF, "10 DAYS")


@query("l5_supervised_table", f"""SELECT *, CAST(sign(ret_5s) AS BIGINT) AS label, CASE WHEN ret_5s > 0.0005 THEN 1
       WHEN ret_5s < -0.0005 THEN -1 ELSE 0 END AS label3 FROM (
       {FORWARD.format(src=f"(SELECT p.*, s.symbol FROM ({TABLE_PAIR}) p JOIN symbols s ON s.id = p.symbol_id)")})""",
       dbl=QB + " volume_sum vwap imbalance_ratio mid_t_plus_5 ret_5s", big="label3")
def _(m):
    return L.supervised_table(*table_bars(m), m.symbols)


@query("l6_zscore", """SELECT ts_second, symbol_id, (mid_close - avg(mid_close) OVER w) / (stddev_samp(mid_close) OVER w + 1e-9)
       AS z_mid_close, (spread_mean - avg(spread_mean) OVER w) / (stddev_samp(spread_mean) OVER w + 1e-9) AS z_spread_mean
       FROM bt_hour WINDOW w AS (PARTITION BY symbol_id)""", dbl="z_mid_close z_spread_mean")
def _(m):
    bars = B.quote_bars_mid(m.bt, "1 hour")
    return L.zscore(bars, ["mid_close", "spread_mean"]).select("ts_second", "symbol_id", "z_mid_close", "z_spread_mean")


@query("l7_ffill_then_zero", """SELECT ts_second, symbol_id, coalesce(last_value(vwap IGNORE NULLS) OVER w, 0) AS vwap,
       coalesce(last_value(spread_std IGNORE NULLS) OVER w, 0) AS spread_std FROM (
         SELECT b.ts_second, b.symbol_id, b.spread_std, t.vwap FROM bt_hour b LEFT JOIN tr_hour t
         ON t.ts_second = b.ts_second AND t.symbol_id = b.symbol_id)
       WINDOW w AS (PARTITION BY symbol_id ORDER BY ts_second)""", dbl="vwap spread_std")
def _(m):
    bars = J.pair_bars(*hour_bars(m), ["vwap"]).select("ts_second", "symbol_id", "vwap", "spread_std")
    return L.ffill_then_zero(bars, ["vwap", "spread_std"])


@query("l8_sequences", f"""SELECT symbol_id, ts_second, length, x_sum, x_last, y FROM (
       SELECT *, count(*) OVER f AS length, sum(coalesce(mid_close, 0) + coalesce(spread_mean, 0)) OVER f AS x_sum,
         lead(spread_mean, 63) OVER o AS x_last, row_number() OVER o - 1 AS i, count(*) OVER (PARTITION BY symbol_id) AS n,
         (lead(mid_close, 68) OVER o - lead(mid_close, 63) OVER o) / nullif(lead(mid_close, 63) OVER o, 0) AS y
       FROM bt_hour WINDOW o AS (PARTITION BY symbol_id ORDER BY ts_second),
         f AS (PARTITION BY symbol_id ORDER BY ts_second ROWS BETWEEN CURRENT ROW AND 63 FOLLOWING))
       WHERE i % 5 = 0 AND i < n - 64 - 5 AND y IS NOT NULL""", dbl="x_sum x_last y")
def _(m):
    built = L.sequences(B.quote_bars_mid(m.bt, "1 hour"), ["mid_close", "spread_mean"])
    total = F.aggregate("X", F.lit(0.0), lambda acc, row: acc + row[0] + row[1])
    return built.select("symbol_id", "ts_second", F.size("X").alias("length"), total.alias("x_sum"),
                        F.element_at("X", -1)[1].alias("x_last"), "y")


@query("l9_trailing_features", hourly_features_sql("2024-01-15", "2024-01-26"), dbl=HF)
def _(m):
    return L.trailing_features(*hour_bars(m), m.symbols, "2024-01-26", days_back=10, topn=M.flatten_topn(m.de))


@query("l10_regular_grid", """SELECT g.symbol_id, g.ts_second, b.mid_close, b.update_count FROM (
       SELECT symbol_id, unnest(generate_series(min(ts_second), max(ts_second), INTERVAL 1 HOUR)) AS ts_second
       FROM bt_hour GROUP BY 1) g LEFT JOIN bt_hour b ON b.symbol_id = g.symbol_id AND b.ts_second = g.ts_second""",
       dbl="mid_close")
def _(m):
    bars = B.quote_bars_mid(m.bt, "1 hour").select("symbol_id", "ts_second", "mid_close", "update_count")
    return L.regular_grid(bars, "1 hour")


@query("l11_symbol_one_hot", "SELECT ts_second, symbol_id, " + ", ".join(
    f"CASE WHEN symbol_id = {i} THEN 1 ELSE 0 END AS is_symbol_{i}" for i in range(25)) + " FROM bt_hour",
    big=" ".join(f"is_symbol_{i}" for i in range(25)))
def _(m):
    bars = B.quote_bars_mid(m.bt, "1 hour").select("ts_second", "symbol_id")
    return L.symbol_one_hot(bars, list(range(25)))


TIERS, GROUPS = [("top", 5), ("middle", 15), ("tail", 24)], [("critical", 3), ("high", 12), ("low", 25)]
TIER_SQL = """SELECT symbol, id AS position, CASE WHEN id < 5 THEN 'top' WHEN id < 15 THEN 'middle' WHEN id < 24 THEN 'tail'
       END AS liquidity_tier, CASE WHEN id < 3 THEN 'critical' WHEN id < 12 THEN 'high' WHEN id < 25 THEN 'low' END
       AS priority, CASE WHEN id < 10 THEN 'high_frequency' WHEN id < 50 THEN 'medium_frequency' END AS frequency
       FROM symbols"""


def tiers(m):
    return L.tier_dimension(m.symbols.withColumn("position", F.col("id")), TIERS, GROUPS)


@query("l12_enrich_tier", f"""SELECT s.symbol, s.id, position, liquidity_tier, priority, frequency FROM symbols s
       LEFT JOIN ({TIER_SQL}) t ON t.symbol = s.symbol""")
def _(m):
    return L.enrich_tier(m.symbols.select("symbol", "id"), tiers(m))
