"""Registry of queries. Each entry pairs a Spark query with SQL that any engine can run.

Both sides round doubles to six decimals, since the order of a floating-point sum is not defined.
Means of prices in cents often end exactly on a half of the last digit, which a sum may reach from
either side; ``NUDGE`` moves the rounding border off such values. Timestamps have no zone and whole
numbers are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification.bindings import Market

ASOF = "2024-01-30 23:30:00"
RECENT = "2 DAYS"
DAY = "2024-01-15"
NUDGE = 3e-8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def canonical(df: DataFrame) -> DataFrame:
    def one(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double") + F.lit(NUDGE), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        return c.alias(f.name)

    return df.select(*[one(f) for f in df.schema])


def query(name: str, sql: str | None = None, dbl: str = "", big: str = ""):
    """Register ``fn(market)``; ``sql`` selects the same rows, ``dbl`` and ``big`` name the columns
    the SQL side rounds or casts to BIGINT."""
    def wrap(fn: Callable[[Market], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: canonical(fn(Market(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = _finish(sql, dbl, big)
        return fn

    return wrap


def rounded(column: str) -> str:
    return f"(round(CAST({column} AS DOUBLE) + {NUDGE!r}, 6) + 0.0)"


def _finish(sql: str, dbl: str, big: str) -> str:
    fixes = [f"{rounded(c)} AS {c}" for c in dbl.split()]
    fixes += [f"CAST({c} AS BIGINT) AS {c}" for c in big.split()]
    replace = f" REPLACE ({', '.join(fixes)})" if fixes else ""
    return f"{PRELUDE}\nSELECT *{replace} FROM (\n{sql.strip()}\n) AS result"


H = 3_600_000_000
D = 24 * H


def bucket(us: int, ts: str = "ts_exchange") -> str:
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"


LAT = "(epoch_us(ts_ingest) - epoch_us(ts_exchange)) / 1000.0E0"
MICRO = ("CASE WHEN bid_qty + ask_qty = 0 THEN (best_bid + best_ask) / 2 "
         "ELSE (best_bid * ask_qty + best_ask * bid_qty) / nullif(bid_qty + ask_qty, 0) END")


def quote_bars_sql(us: int, ts: str = "ts_second") -> str:
    return f"""SELECT {bucket(us)} AS {ts}, symbol_id,
      first(mid ORDER BY ts_exchange, update_id) AS mid_open, max(mid) AS mid_high, min(mid) AS mid_low,
      last(mid ORDER BY ts_exchange, update_id) AS mid_close, avg(spread) AS spread_mean, min(spread) AS spread_min,
      max(spread) AS spread_max, stddev_samp(spread) AS spread_std, avg(bid_qty + ask_qty) AS total_qty_mean,
      count(*) AS update_count, avg({LAT}) AS avg_latency_ms
    FROM quotes GROUP BY 1, 2"""


def trade_bars_sql(us: int) -> str:
    return f"""SELECT {bucket(us)} AS ts_second, symbol_id, count(*) AS trade_count, sum(qty) AS vol_sum,
      CASE WHEN sum(qty) > 0 THEN sum(price * qty) / sum(qty) END AS vwap,
      sum(CASE WHEN NOT is_buyer_maker THEN qty ELSE 0 END) AS buy_vol,
      sum(CASE WHEN is_buyer_maker THEN qty ELSE 0 END) AS sell_vol,
      first(price ORDER BY ts_exchange, agg_trade_id) AS price_open, max(price) AS price_high,
      min(price) AS price_low, last(price ORDER BY ts_exchange, agg_trade_id) AS price_close
    FROM trades GROUP BY 1, 2"""


def trade_table_sql(us: int) -> str:
    return f"""SELECT {bucket(us)} AS ts_second, symbol_id, count(*) AS trade_count, sum(qty) AS volume_sum,
      sum(price * qty) AS value_sum, sum(price * qty) / nullif(sum(qty), 0) AS vwap,
      sum(qty) FILTER (WHERE NOT is_buyer_maker) AS b0, sum(qty) FILTER (WHERE is_buyer_maker) AS s0,
      coalesce(b0, 0) AS buy_volume, coalesce(s0, 0) AS sell_volume,
      count(*) FILTER (WHERE NOT is_buyer_maker) AS buy_count, count(*) FILTER (WHERE is_buyer_maker) AS sell_count,
      CASE WHEN coalesce(b0, 0) + coalesce(s0, 0) > 0
           THEN (coalesce(b0, 0) - coalesce(s0, 0)) / (coalesce(b0, 0) + coalesce(s0, 0)) ELSE 0 END AS imbalance_ratio,
      min(price) AS price_min, max(price) AS price_max
    FROM trades GROUP BY 1, 2"""


def quote_bidask_sql(us: int) -> str:
    parts = []
    for side, p in (("bid", "best_bid"), ("ask", "best_ask")):
        parts.append(f"first({p} ORDER BY ts_exchange, update_id) AS {side}_open, "
                     f"last({p} ORDER BY ts_exchange, update_id) AS {side}_close, max({p}) AS {side}_high, "
                     f"min({p}) AS {side}_low, avg({p}) AS {side}_avg")
    for q in ("bid_qty", "ask_qty"):
        parts.append(f"first({q} ORDER BY ts_exchange, update_id) AS {q}_open, "
                     f"last({q} ORDER BY ts_exchange, update_id) AS {q}_close, max({q}) AS {q}_max, "
                     f"min({q}) AS {q}_min, avg({q}) AS {q}_avg")
    return f"""SELECT {bucket(us)} AS ts_bucket, symbol_id, {', '.join(parts)},
      avg(spread) AS spread_avg, max(spread) AS spread_max, min(spread) AS spread_min, count(*) AS tick_count,
      avg(mid) AS mid_avg, avg(mid) AS microprice_avg
    FROM quotes GROUP BY 1, 2"""


def trade_ext_sql(us: int) -> str:
    return f"""SELECT {bucket(us)} AS ts_bucket, symbol_id, first(price ORDER BY ts_exchange, agg_trade_id) AS price_open,
      last(price ORDER BY ts_exchange, agg_trade_id) AS price_close, max(price) AS price_high, min(price) AS price_low,
      sum(qty) AS volume, sum(price * qty) AS quote_volume, count(*) AS trade_count, avg(qty) AS avg_trade_size,
      max(qty) AS max_trade_size, min(qty) AS min_trade_size,
      sum(CASE WHEN NOT is_buyer_maker THEN qty ELSE 0 END) AS buy_volume,
      sum(CASE WHEN is_buyer_maker THEN qty ELSE 0 END) AS sell_volume,
      count(*) FILTER (WHERE NOT is_buyer_maker) AS buy_count, count(*) FILTER (WHERE is_buyer_maker) AS sell_count,
      sum(price * qty) / nullif(sum(qty), 0) AS vwap,
      count(*) FILTER (WHERE NOT is_buyer_maker) / count(*) AS buy_ratio
    FROM trades GROUP BY 1, 2"""


def depth_bars_sql(us: int) -> str:
    parts = []
    for which in ("last", "first"):
        for c in ("bid_price", "ask_price", "bid_qty", "ask_qty"):
            parts.append(f"{which}({c} ORDER BY ts_exchange, final_update_id) AS {which}_{c}")
    return f"""SELECT {bucket(us)} AS ts_bucket, symbol_id, count(*) AS update_count, {', '.join(parts)}
    FROM best_levels GROUP BY 1, 2"""


def market_bars_sql(us: int) -> str:
    return f"""SELECT q.ts_bucket, q.symbol_id, q.bid_close, q.ask_close, q.bid_qty_close, q.ask_qty_close, q.spread_avg,
      q.microprice_avg, q.tick_count AS bt_ticks, t.price_close, t.volume, t.trade_count, t.vwap, t.buy_ratio,
      t.buy_volume, t.sell_volume, d.update_count AS depth_updates
    FROM ({quote_bidask_sql(us)}) q
    LEFT JOIN ({trade_ext_sql(us)}) t ON t.ts_bucket = q.ts_bucket AND t.symbol_id = q.symbol_id
    LEFT JOIN ({depth_bars_sql(us)}) d ON d.ts_bucket = q.ts_bucket AND d.symbol_id = q.symbol_id"""


_FLAT = ", ".join(
    f"max(CASE WHEN side = '{s}' AND r = {i} THEN price END) AS {s}{i}_price, "
    f"max(CASE WHEN side = '{s}' AND r = {i} THEN qty END) AS {s}{i}_qty"
    for s in ("b", "a") for i in range(1, 6))

PRELUDE = f"""WITH ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
keyed AS (SELECT *, user_id % 25 AS symbol_id, ts AS ts_exchange, ts + (k - 5) * INTERVAL 1 MILLISECOND AS ts_ingest FROM ev),
symbols AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, r_name AS exchange, n_name AS symbol, n_nationkey % 5 <> 4 AS is_active
  FROM nation JOIN region ON n_regionkey = r_regionkey),
active AS (SELECT * FROM symbols WHERE is_active),
book_ticker AS (
  SELECT ts_exchange, ts_ingest, symbol_id, event_id AS update_id, value AS best_bid,
         value + (event_id % 11 - 1) * 0.01E0 AS best_ask, CAST(k AS DOUBLE) AS bid_qty,
         CAST((event_id * 7) % 53 AS DOUBLE) AS ask_qty
  FROM keyed WHERE event_type <> 'purchase'),
quotes AS (SELECT *, best_ask - best_bid AS spread, (best_ask + best_bid) / 2.0E0 AS mid FROM book_ticker),
trades AS (
  SELECT ts_exchange, ts_ingest, symbol_id, event_id AS agg_trade_id, value AS price, (k + 1) / 10.0E0 AS qty,
         event_id % 2 = 1 AS is_buyer_maker
  FROM keyed WHERE event_type IN ('purchase', 'click')),
depth AS (
  SELECT ts_exchange, ts_ingest, symbol_id, event_id * 10 AS first_update_id, event_id * 10 + 9 AS final_update_id,
         event_id * 10 - 1 AS prev_final_update_id, event_id, k, CAST(round(value * 100) AS BIGINT) AS cents
  FROM keyed WHERE event_type <> 'error'),
levels AS (
  SELECT ts_exchange, ts_ingest, symbol_id, final_update_id, 'b' AS side, i, (cents - i) / 100.0E0 AS price,
         CAST((k + 3 * i) % 17 AS DOUBLE) AS qty FROM depth, range(5) AS steps(i)
  UNION ALL
  SELECT ts_exchange, ts_ingest, symbol_id, final_update_id, 'a', i, (cents + 1 + i) / 100.0E0,
         CAST((event_id + 5 * i) % 13 AS DOUBLE) FROM depth, range(5) AS steps(i)),
best_levels AS (
  SELECT ts_exchange, symbol_id, final_update_id, cents / 100.0E0 AS bid_price, (cents + 1) / 100.0E0 AS ask_price,
         CAST(k % 17 AS DOUBLE) AS bid_qty, CAST(event_id % 13 AS DOUBLE) AS ask_qty FROM depth),
ranked_levels AS (
  SELECT *, row_number() OVER (PARTITION BY final_update_id, side
                               ORDER BY CASE WHEN side = 'b' THEN -price ELSE price END) AS r
  FROM levels WHERE qty > 0),
walls AS (
  SELECT final_update_id, side, price, qty,
         row_number() OVER (PARTITION BY final_update_id, side ORDER BY qty DESC, r) AS w
  FROM ranked_levels WHERE r <= 5),
flat AS (
  SELECT ts_exchange, symbol_id, final_update_id, {_FLAT},
         coalesce(sum(qty) FILTER (WHERE side = 'b' AND r <= 5), 0) AS total_bid_qty,
         coalesce(sum(qty) FILTER (WHERE side = 'a' AND r <= 5), 0) AS total_ask_qty
  FROM ranked_levels GROUP BY 1, 2, 3),
topn0 AS (
  SELECT f.*, b.qty AS wall_size_bid, a.qty AS wall_size_ask, (b1_price + a1_price) / 2 AS m,
         b.price AS wb, a.price AS wa
  FROM flat f LEFT JOIN walls b ON b.final_update_id = f.final_update_id AND b.side = 'b' AND b.w = 1
  LEFT JOIN walls a ON a.final_update_id = f.final_update_id AND a.side = 'a' AND a.w = 1),
topn AS (
  SELECT * EXCLUDE (m, wb, wa),
    CASE WHEN m IS NOT NULL THEN (b1_price * a1_qty + a1_price * b1_qty) / (b1_qty + a1_qty) END AS microprice,
    CASE WHEN m IS NOT NULL THEN (b1_qty - a1_qty) / (b1_qty + a1_qty) ELSE 0 END AS i1,
    CASE WHEN m IS NOT NULL THEN (total_bid_qty - total_ask_qty) / (total_bid_qty + total_ask_qty) ELSE 0 END AS i5,
    CASE WHEN m > 0 THEN abs(wb - m) / m * 10000 END AS wall_dist_bid_bps,
    CASE WHEN m > 0 THEN abs(wa - m) / m * 10000 END AS wall_dist_ask_bps,
    CASE WHEN wall_size_bid >= wall_size_ask THEN CASE WHEN m > 0 THEN abs(wb - m) / m * 10000 END
         ELSE CASE WHEN m > 0 THEN abs(wa - m) / m * 10000 END END AS wall_size_bps
  FROM topn0),
bt_day AS ({quote_bars_sql(D)}),
bt_hour AS ({quote_bars_sql(H)}),
tr_day AS ({trade_bars_sql(D)}),
tr_hour AS ({trade_bars_sql(H)}),
trt_hour AS ({trade_table_sql(H)}),
mk_hour AS ({market_bars_sql(H)}),
de_day AS ({depth_bars_sql(D)}),
log AS (
  SELECT ts_exchange, ts_ingest, symbol_id, CASE WHEN event_type = 'purchase' THEN 'aggTrade' ELSE 'bookTicker' END
         AS stream_type, event_id, event_type <> 'error' AS ok FROM keyed),
recent_bt AS (SELECT * FROM quotes WHERE ts_exchange >= TIMESTAMP '{ASOF}' - INTERVAL 2 DAY),
recent_tr AS (SELECT * FROM trades WHERE ts_exchange >= TIMESTAMP '{ASOF}' - INTERVAL 2 DAY)"""
