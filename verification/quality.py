"""Q queries."""

from pyspark.sql import functions as F

from tickspark.operators import bars as B
from tickspark.operators import joins as J
from tickspark.operators import profile as P
from tickspark.operators import quality as Q
from tickspark.sources import wire
from verification.bars import HOUR_STATS, RECENT_JOIN
from verification.features import tiers
from verification.registry import ASOF, LAT, RECENT, query

NOW = f"TIMESTAMP '{ASOF}'"
REQUIRED = {"symbol_id": None, "best_bid": "double", "best_ask": "double", "update_id": "double", "venue": None}


def result(name, passed, severity, actual):
    return (f"SELECT {name} AS test_name, {passed} AS passed, CASE WHEN {passed} THEN 'info' ELSE '{severity}' END "
            f"AS severity, CAST({actual} AS VARCHAR) AS actual")


def _schema_sql():
    rows = []
    for c in REQUIRED:
        present = c != "venue"
        rows.append(result(f"'present: quotes.{c}'", str(present).lower(), "error", f"'{str(present).lower()}'"))
    for c in ("symbol_id", "best_bid", "best_ask", "update_id"):
        n = f"(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM book_ticker)"
        rows.append(result(f"'no nulls: quotes.{c}'", f"{n} = 0", "warning", n))
    for c in ("best_bid", "best_ask", "update_id"):
        numeric = str(c != "update_id").lower()
        rows.append(result(f"'numeric: quotes.{c}'", numeric, "warning", f"'{numeric}'"))
        n = f"(SELECT count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) FROM book_ticker)"
        rows.append(result(f"'castable: quotes.{c}'", f"{n} = 0", "warning", n))
    return " UNION ALL ".join(rows)


@query("q1_schema_conformance", _schema_sql())
def _(m):
    return Q.schema_conformance(m.bt, "quotes", REQUIRED)


def _fresh(name, table):
    return f"""SELECT 'freshness: {name}' AS test_name, sev = 'info' AS passed, sev AS severity,
       CAST(round(age, 1) AS VARCHAR) AS actual FROM (SELECT age, CASE WHEN age IS NULL THEN 'error'
       WHEN age > 10 THEN 'warning' ELSE 'info' END AS sev FROM (
       SELECT (epoch_us({NOW}) - epoch_us(max(ts_exchange))) / 60000000.0E0 AS age FROM {table}))"""


@query("q2_freshness_check", f"{_fresh('quotes', 'recent_bt')} UNION ALL {_fresh('trades', 'recent_tr')}")
def _(m):
    return P.union_all(Q.freshness_check(m.bt, "quotes", ASOF, RECENT), Q.freshness_check(m.tr, "trades", ASOF, RECENT))


AGE = f"(epoch_us({NOW}) - epoch_us(max(ts_exchange))) / 60000000.0E0"


@query("q3_freshness_label", f"""SELECT symbol_id, max(ts_exchange) AS last_update, {AGE} AS minutes_since_last_update,
       CASE WHEN {AGE} <= 5 THEN 'FRESH' WHEN {AGE} <= 15 THEN 'STALE' ELSE 'OLD' END AS data_status
       FROM book_ticker GROUP BY 1""", dbl="minutes_since_last_update")
def _(m):
    return Q.freshness_label(m.bt, ASOF)


def _volume(name, table):
    n = f"(SELECT count(*) FROM {table})"
    return result(f"'volume: {name}'", f"{n} >= 1000", "warning", n)


@query("q4_volume_check", f"{_volume('quotes', 'recent_bt')} UNION ALL {_volume('trades', 'recent_tr')}")
def _(m):
    return P.union_all(Q.volume_check(m.bt, "quotes", ASOF, RECENT), Q.volume_check(m.tr, "trades", ASOF, RECENT))


@query("q5_quote_quality", """SELECT s.symbol, count(q.update_id) AS total_records,
       count(*) FILTER (WHERE best_bid <= 0) AS invalid_bid_price, count(*) FILTER (WHERE best_ask <= 0)
       AS invalid_ask_price, count(*) FILTER (WHERE bid_qty <= 0) AS invalid_bid_qty,
       count(*) FILTER (WHERE ask_qty <= 0) AS invalid_ask_qty, count(*) FILTER (WHERE spread <= 0) AS invalid_spread,
       count(*) FILTER (WHERE ts_ingest < ts_exchange) AS invalid_latency
       FROM active s LEFT JOIN quotes q ON q.symbol_id = s.id GROUP BY 1""")
def _(m):
    return Q.quote_quality(m.symbols, m.bt)


@query("q6_quote_quality_ext", """SELECT symbol_id, count(*) AS total_records,
       count(*) FILTER (WHERE best_bid IS NULL OR best_ask IS NULL) AS null_prices,
       count(*) FILTER (WHERE best_bid <= 0 OR best_ask <= 0) AS invalid_prices,
       count(*) FILTER (WHERE best_bid >= best_ask) AS inverted_spread,
       count(*) FILTER (WHERE spread > best_ask * 0.01E0) AS wide_spread, avg(spread) AS avg_spread,
       stddev_samp(spread) AS spread_volatility, avg(spread / nullif(best_ask, 0) * 100) AS avg_spread_percent
       FROM quotes GROUP BY 1""", dbl="avg_spread spread_volatility avg_spread_percent")
def _(m):
    return Q.quote_quality_ext(m.bt)


PCT = "spread / nullif(mid, 0) * 100"
SPREADS = f"""SELECT symbol_id, count(*) AS records, avg({PCT}) AS avg_spread_percent, max({PCT}) AS max_spread_percent,
       count(*) FILTER (WHERE best_bid <= 0 OR best_ask <= 0) AS invalid_prices,
       count(*) FILTER (WHERE bid_qty <= 0 OR ask_qty <= 0) AS invalid_quantities,
       count(*) FILTER (WHERE best_ask <= best_bid) AS inverted_spread FROM quotes GROUP BY 1"""


@query("q7_spread_quality", f"SELECT * FROM ({SPREADS}) ORDER BY records DESC, symbol_id LIMIT 10",
       dbl="avg_spread_percent max_spread_percent")
def _(m):
    return Q.spread_quality(m.bt)


SPREAD_RESULTS = f"""SELECT 'spread: ' || symbol_id AS test_name, coalesce(max_spread_percent, 0) <= 1 AS passed, CASE WHEN
       coalesce(max_spread_percent, 0) <= 1 THEN 'info' ELSE 'warning' END AS severity FROM ({SPREADS})
       UNION ALL SELECT 'prices: ' || symbol_id, invalid_prices = 0, CASE WHEN invalid_prices = 0 THEN 'info'
       ELSE 'error' END FROM ({SPREADS})
       UNION ALL SELECT 'direction: ' || symbol_id, inverted_spread = 0, CASE WHEN inverted_spread = 0 THEN 'info'
       ELSE 'error' END FROM ({SPREADS})"""


@query("q7_spread_quality_results", SPREAD_RESULTS)
def _(m):
    return Q.spread_quality_results(m.bt, top=None).drop("actual")


MAKER = "(SELECT count(*) FILTER (WHERE is_buyer_maker) / count(*) FROM trades)"
BAD = "(SELECT count(*) FILTER (WHERE price <= 0) + count(*) FILTER (WHERE qty <= 0) FROM trades)"
TRADE_RESULTS = (result("'maker balance'", f"{MAKER} BETWEEN 0.3 AND 0.7", "warning", f"round({MAKER}, 4)")
                 + " UNION ALL " + result("'trade values'", f"{BAD} = 0", "error", BAD))


@query("q8_trade_quality", TRADE_RESULTS)
def _(m):
    return Q.trade_quality_results(m.tr)


GAPS = """SELECT symbol_id, count(*) AS updates, avg(us) / 1000 AS a, quantile_disc(us, 0.95) / 1000 AS p FROM (
       SELECT symbol_id, epoch_us(ts_exchange) - epoch_us(lag(ts_exchange) OVER (PARTITION BY symbol_id
       ORDER BY ts_exchange, update_id)) AS us FROM book_ticker) WHERE us IS NOT NULL GROUP BY 1"""


@query("q9_cadence_check", f"""SELECT 'cadence: ' || symbol_id AS test_name, a <= 10000000 AS passed, CASE WHEN a <= 10000000
       THEN 'info' ELSE 'warning' END AS severity FROM ({GAPS}) UNION ALL
       SELECT 'cadence p95: ' || symbol_id, false, 'warning' FROM ({GAPS}) WHERE p > 30000000""")
def _(m):
    return Q.cadence_results(m.bt, limit_ms=10_000_000.0, min_updates=0, top=None).drop("actual")


def _cover(name, table):
    n = f"(SELECT count(*) FROM {table} WHERE ts_second >= {NOW} - INTERVAL 2 DAY)"
    return result(f"'bars: {name}'", f"{n} > 0", "warning", n)


COVER = f"{_cover('quotes', 'bt_hour')} UNION ALL {_cover('trades', 'tr_hour')}"


def _coverage(m):
    return Q.aggregate_coverage({"quotes": B.quote_bars_mid(m.bt, "1 hour"), "trades": B.trade_bars(m.tr, "1 hour")},
                                ASOF, RECENT, ts="ts_second")


@query("q10_aggregate_coverage", COVER)
def _(m):
    return _coverage(m)


@query("q11_quality_report", f"""SELECT count(*) AS total_tests, count(*) FILTER (WHERE passed) AS passed_tests,
       count(*) FILTER (WHERE NOT passed AND severity = 'error') AS failed_tests,
       count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings,
       CAST(greatest(0, 100 - 10 * count(*) FILTER (WHERE NOT passed AND severity = 'error')
         - 3 * count(*) FILTER (WHERE NOT passed AND severity = 'warning')) AS DOUBLE) AS overall_score FROM (
       SELECT passed, severity FROM ({_schema_sql()}) UNION ALL SELECT passed, severity FROM ({TRADE_RESULTS})
       UNION ALL SELECT passed, severity FROM ({COVER})
       UNION ALL SELECT passed, severity FROM ({_fresh('quotes', 'recent_bt')}))""", dbl="overall_score")
def _(m):
    return Q.quality_report(P.union_all(
        Q.schema_conformance(m.bt, "quotes", REQUIRED), Q.trade_quality_results(m.tr), _coverage(m),
        Q.freshness_check(m.bt, "quotes", ASOF, RECENT)))


HEALTH = f"""SELECT *, status_message = 'OK' AS is_healthy FROM (
       SELECT j.symbol, bt_count AS book_ticker_count, tr_count AS trades_count, last_bt AS last_book_ticker,
       last_tr AS last_trade, coalesce(avg_latency_ms, 0) AS avg_latency_ms, coalesce(q.ml, 0) AS max_latency_ms,
       coalesce(q.p95, 0) AS p95_latency_ms,
       coalesce(q.inv, 0) AS invalid_spreads, coalesce(q.bad, 0) AS invalid_prices,
       CASE WHEN coalesce(j.avg_latency_ms, 0) > 46 THEN 'High latency' WHEN coalesce(q.inv, 0) > 10
       THEN 'High invalid spreads' WHEN last_bt IS NULL THEN 'No data'
       WHEN (epoch_us({NOW}) - epoch_us(last_bt)) / 1000000.0E0 > 7200 THEN 'No updates' ELSE 'OK' END AS status_message
       FROM ({RECENT_JOIN.format(symbols='symbols')}) j LEFT JOIN (SELECT symbol_id, count(*) FILTER (WHERE spread <= 0)
       AS inv, count(*) FILTER (WHERE best_bid <= 0 OR best_ask <= 0) AS bad, max({LAT}) AS ml,
       quantile_cont({LAT}, 0.95) AS p95 FROM recent_bt GROUP BY 1) q
       ON q.symbol_id = j.symbol_id)"""


@query("q13_symbol_health", HEALTH, dbl="avg_latency_ms max_latency_ms p95_latency_ms")
def _(m):
    return Q.symbol_health(m.symbols, m.bt, m.tr, ASOF, RECENT, stale_seconds=7200, max_latency_ms=46)


@query("q14_ingestion_health", f"""SELECT s.symbol, stream_type, last_event_time, last_processed_at,
       (epoch_us({NOW}) - epoch_us(last_processed_at)) / 1000000.0E0 AS seconds_since_last, events_processed,
       events_failed, last_latency_ms FROM ({HOUR_STATS}) o JOIN active s ON s.id = o.symbol_id""",
       dbl="seconds_since_last last_latency_ms")
def _(m):
    joined = J.current_hour_stats_join(P.ingestion_offsets(m.ingest_log), P.ingestion_stats_hourly(m.ingest_log), ASOF)
    return Q.ingestion_health(m.symbols, joined, ASOF)


def _verify(name, table):
    return f"""SELECT '{name}' AS table_name, CAST(floor((epoch_us({NOW}) - epoch_us(max(ts_exchange))) / 1000000.0E0)
       AS BIGINT) AS fresh_seconds, count(*) FILTER (WHERE ts_exchange >= {NOW} - INTERVAL 1 HOUR) AS count_recent
       FROM {table}"""


@query("q15_verify_ingestion", f"""SELECT *, bool_and(table_name = 'depth_events' OR (fresh_ok AND rate_ok)) OVER ()
       AS overall_ok FROM (SELECT *, fresh_seconds <= 1200 AS fresh_ok, count_recent >= 10 AS rate_ok FROM (
       {_verify('book_ticker', 'book_ticker')} UNION ALL {_verify('trades', 'trades')}
       UNION ALL {_verify('depth_events', 'depth')}))""")
def _(m):
    return Q.verify_ingestion({"book_ticker": m.bt, "trades": m.tr, "depth_events": m.de}, ASOF,
                              ["book_ticker", "trades"], max_age_seconds=1200, min_rows=10, window="1 HOUR")


@query("q16_check_freshness", f"""SELECT symbol, last_bt AS last_book_ticker, last_tr AS last_trade, bt_count AS bt_count_1h,
       tr_count AS trade_count_1h, (epoch_us({NOW}) - epoch_us(last_bt)) / 1000000.0E0 AS seconds_since_last_bt
       FROM ({RECENT_JOIN.format(symbols='active')})""", dbl="seconds_since_last_bt")
def _(m):
    return Q.check_freshness(m.symbols, m.bt, m.tr, ASOF, RECENT)


@query("q17_key_uniqueness", """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2
       HAVING count(*) > 1""", big="l_linenumber")
def _(m):
    return Q.key_uniqueness(m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("q18_symbol_universe_check", """SELECT *, offending = 0 AS passed FROM (
       SELECT 'duplicate' AS rule, (SELECT count(*) FROM (SELECT symbol FROM symbols GROUP BY 1 HAVING count(*) > 1)) AS offending
       UNION ALL SELECT 'expected count', abs(count(*) - 24) FROM symbols
       UNION ALL SELECT 'not upper case', count(*) FROM symbols WHERE symbol <> upper(symbol)
       UNION ALL SELECT 'wrong quote suffix', count(*) FROM symbols WHERE NOT ends_with(symbol, '1')
       UNION ALL SELECT 'without tier', count(*) FROM symbols WHERE id >= 24
       UNION ALL SELECT 'traded but not listed', count(*) FROM (SELECT DISTINCT symbol_id FROM trades) WHERE symbol_id NOT IN (SELECT id FROM active)
       UNION ALL SELECT 'listed but never traded', count(*) FROM symbols WHERE id NOT IN (SELECT symbol_id FROM trades))""", big="offending")
def _(m):
    covered = tiers(m).filter("liquidity_tier IS NOT NULL")
    listed = m.symbols
    base = Q.symbol_universe_check(listed, m.tr, 24, "1", covered).filter("rule <> 'traded but not listed'")
    untraded = Q.symbol_universe_check(listed.filter("is_active"), m.tr, 24, "1", covered).filter(
        "rule = 'traded but not listed'")
    return base.unionByName(untraded)


@query("q12_quarantine_rate", """SELECT count(*) FILTER (WHERE event_type <> 'error') AS processed_count,
       count(*) FILTER (WHERE event_type = 'error') AS error_count,
       count(*) FILTER (WHERE event_type = 'error') / count(*) AS error_rate FROM keyed WHERE event_type <> 'purchase'""",
       dbl="error_rate")
def _(m):
    return Q.rejects_summary(wire.parse_book_ticker(wire.read_envelope(m.messages)))


@query("q12_quarantine_rows", """SELECT symbol_id, count(*) AS rejected FROM keyed WHERE event_type = 'error' GROUP BY 1""")
def _(m):
    bad = wire.rejected(wire.parse_book_ticker(wire.read_envelope(m.messages)))
    sid = F.regexp_extract(F.get_json_object("data", "$.s"), r"_(\d+)$", 1).cast("bigint")
    return bad.groupBy(sid.alias("symbol_id")).agg(F.count(F.lit(1)).alias("rejected"))
