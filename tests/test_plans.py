"""Plans keep the properties the operators promise."""

from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from tickspark.functions.time import time_bucket
from tickspark.operators import bars as B
from tickspark.operators import indicators as I
from tickspark.operators import joins as J
from tickspark.operators import micro as M
from tickspark.operators import profile as P
from tickspark.operators import quality as Q
from tickspark.operators import ticks as K
from tickspark.plans import datasets as L
from tickspark.sources import tables as S
from verification.bindings import Market


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("bars", [B.quote_bars_mid, B.quote_bars_bidask, B.quote_bars_table])
def test_quote_bars_hash_without_sorting(spark, sf_dir, bars):
    text = plan(bars(Market(spark, sf_dir).bt, "1 second"))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text and "\nSort" not in text
    assert text.count(") Exchange") == 1


def test_trade_and_depth_bars_hash(spark, sf_dir):
    m = Market(spark, sf_dir)
    for df in (B.trade_bars(m.tr), B.trade_bars_ext(m.tr), B.depth_bars(m.de)):
        assert "SortAggregate" not in plan(df)


def test_bars_read_only_their_columns(spark, tmp_path, sf_dir):
    path = str(tmp_path / "bt")
    Market(spark, sf_dir).bt.write.parquet(path)
    text = plan(B.quote_bars_mid(K.recent(spark.read.parquet(path), "2024-01-30 00:00:00", "1 DAY")).select(
        "symbol_id", "ts_second", "update_count"))
    assert "ReadSchema: struct<ts_exchange:timestamp,symbol_id:bigint>" in text
    assert "GreaterThanOrEqual(ts_exchange" in text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, sf_dir):
    """The facts as Parquet tables, so that a plan shows each reading of them."""
    m, root = Market(spark, sf_dir), tmp_path_factory.mktemp("facts")
    facts = {"symbols": m.symbols}
    for name in ("bt", "tr", "de"):
        getattr(m, name).write.parquet(str(root / name))
        facts[name] = spark.read.parquet(str(root / name))
    return SimpleNamespace(**facts)


@pytest.fixture
def whole_plans(spark):
    """Plans as first drawn up: nothing adaptive, nothing broadcast."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hour_bars(m):
    return B.quote_bars_mid(m.bt, "1 hour")


def joined(m):
    return J.market_data_bars(B.quote_bars_bidask(m.bt, "1 hour"), B.trade_bars_ext(m.tr, "1 hour"), B.depth_bars(m.de, "1 hour"))


def hourly(m):
    return hour_bars(m).withColumnsRenamed({"ts_second": "hour_bucket", "mid_close": "h_close", "mid_open": "h_volume"})


# What is asked of the facts, and how many of them it may read: each once.
READS = {
    "w1": (lambda m: I.lag_features(hour_bars(m).withColumn("imbalance_ratio", F.col("mid_open"))), 1),
    "w2": (lambda m: I.hour_lags(hourly(m)), 1),
    "w3": (lambda m: I.rolling_sma_vol(hour_bars(m)), 1),
    "w4": (lambda m: I.forward_return(hour_bars(m)), 1),
    "w7": (lambda m: K.tick_gaps(m.bt), 1),
    "w8": (lambda m: K.interval_stats(m.bt), 1),
    "w9": (lambda m: K.quote_change_bps(m.bt), 1),
    "m4": (lambda m: M.ofi_events(m.bt), 1),
    "m6": (lambda m: M.vpin_like(B.trade_bars_ext(m.tr, "1 hour")), 1),
    "m7": (lambda m: M.log_return(B.quote_bars_bidask(m.bt, "1 hour")), 1),
    "m8": (lambda m: M.rolling_volatility(B.quote_bars_bidask(m.bt, "1 hour")), 1),
    "m11": (lambda m: M.market_features(joined(m)), 2),  # depth bars bring nothing the features need
    "m14": (lambda m: M.ofi_rolling(M.flatten_topn(m.de)), 1),
    "i": (lambda m: I.technical_indicators(hourly(m)), 1),
    "d5": (lambda m: P.latency_stats(m.bt), 1),
    "l1": (lambda m: L.yesterday_dataset(hour_bars(m), B.trade_bars_table(m.tr, "1 hour"), m.symbols, "2024-01-15"), 2),
    "l3": (lambda m: L.hourly_ml_features(hour_bars(m), B.trade_bars(m.tr, "1 hour"), m.symbols, "2024-01-02", "2024-01-20"), 2),
    "l4": (lambda m: L.realtime_features(hour_bars(m), B.trade_bars(m.tr, "1 hour"), m.symbols, "2024-01-30 23:30:00", "2 DAYS"), 2),
    "l5": (lambda m: L.supervised_table(hour_bars(m), B.trade_bars_table(m.tr, "1 hour"), m.symbols), 2),
    "l7": (lambda m: L.ffill_then_zero(hour_bars(m).select("symbol_id", "ts_second", "mid_close"), ["mid_close"]), 1),
    "l8": (lambda m: L.sequences(hour_bars(m), ["mid_close", "spread_mean"]), 1),
}


@pytest.mark.parametrize("name", READS)
def test_facts_are_read_and_moved_once(stored, whole_plans, name):
    """Rows are read once, and what the pieces say about themselves comes off the same exchange, without sorting."""
    make, facts = READS[name]
    text = plan(make(stored))
    reads = [line for line in text.splitlines() if line.startswith("Location:") and any(f"/{t}]" in line for t in ("bt", "tr", "de"))]
    assert len(reads) == facts, text
    assert "ReusedExchange" in text and "SortAggregate" not in text


def test_dimension_join_is_not_forced_to_broadcast(spark, sf_dir):
    m = Market(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(J.enrich_symbols(m.tr, m.symbols))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_bars_join_without_moving(spark, stored, whole_plans, tmp_path):
    by = {"ts_second": ["symbol_id", "ts_second"], "ts_bucket": ["symbol_id", "ts_bucket"]}

    def kept(name, df):
        key = by["ts_second" if "ts_second" in df.columns else "ts_bucket"]
        return S.write_bucketed(df, f"plan_{name}", str(tmp_path / name), key, 4).drop("event_date")

    books = M.flatten_topn(stored.de).withColumn("ts_second", time_bucket("ts_exchange", "1 hour"))
    quotes, trades, books = kept("quotes", hour_bars(stored)), kept("trades", B.trade_bars(stored.tr, "1 hour")), kept("books", books)
    wide = [kept(n, df) for n, df in (("q", B.quote_bars_bidask(stored.bt, "1 hour")), ("t", B.trade_bars_ext(stored.tr, "1 hour")),
                                      ("d", B.depth_bars(stored.de, "1 hour")))]
    for df in (J.join_bars(quotes, trades), J.market_data_bars(*wide), J.range_join_topn(quotes, books)):
        text = plan(df)
        assert "SortMergeJoin" in text and "Exchange" not in text, text
    # A session that starts anew is told where the table lies.
    spark.sql("DROP TABLE plan_quotes")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in quotes.schema)
    again = S.open_bucketed(spark, "plan_quotes", str(tmp_path / "quotes"), columns, by["ts_second"], 4).drop("event_date")
    assert again.count() == hour_bars(stored).count() and "Exchange" not in plan(J.join_bars(again, trades))


def test_rows_are_picked_without_sorting(spark, stored, whole_plans):
    topn, features = M.flatten_topn(stored.de), M.market_features(joined(stored))
    versions = hour_bars(stored).withColumn("batch_id", F.lit(1))
    for df in (B.topn_resample(topn), S.latest_version(versions, ["ts_second", "symbol_id"], "batch_id"),
               S.dedup_first(stored.bt, ["symbol_id", "ts_exchange", "update_id"]), S.dedup_first(stored.tr, ["symbol_id", "agg_trade_id"]),
               B.bucket_pick(features, ["symbol_id"], ["ts_exchange"], "last")):
        assert "SortAggregate" not in plan(df)


def test_health_reads_quotes_and_trades_once(stored, whole_plans):
    text = plan(Q.symbol_health(stored.symbols, stored.bt, stored.tr, "2024-01-30 23:30:00", "2 DAYS"))
    assert sum(line.startswith("Location:") and any(f"/{t}]" in line for t in ("bt", "tr")) for line in text.splitlines()) == 2
