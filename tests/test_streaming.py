"""Streams fed by shuffled, duplicated chunks equal the batch result; replays change nothing."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickspark.operators import bars as B
from tickspark.operators import joins as J
from tickspark.operators import micro as M
from tickspark.schemas import BOOK_TICKER, KEYS, TRADES
from tickspark.sources import tables as S
from tickspark.streaming import jobs as T

ROW = "ts_exchange timestamp, ts_ingest timestamp, symbol_id long, update_id long, best_bid double, best_ask double, " \
      "bid_qty double, ask_qty double"
START = 1_700_000_000.0


def quotes(n=300, seed=2):
    rnd = random.Random(seed)
    return [(START + rnd.random() * 3000, rnd.randint(1, 3), i, float(rnd.randint(90, 110))) for i in range(n)]


def frame(spark, items):
    raw = spark.createDataFrame(items, "t double, symbol_id long, update_id long, best_bid double")
    ts = F.timestamp_micros((F.col("t") * 1e6).cast("long"))
    return raw.select(ts.alias("ts_exchange"), ts.alias("ts_ingest"), "symbol_id", "update_id", "best_bid",
                      (F.col("best_bid") + 1).alias("best_ask"), F.lit(1.0).alias("bid_qty"), F.lit(2.0).alias("ask_qty"))


def as_rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in df.select(*cols).collect())


def stream(spark, path, schema=BOOK_TICKER):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_shuffled_duplicated_chunks_equal_batch(spark, tmp_path):
    rows = quotes()
    sent = rows + rows[::3]
    random.Random(4).shuffle(sent)
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    for i in range(0, len(sent), 100):
        frame(spark, sent[i:i + 100]).coalesce(1).write.mode("append").parquet(src)

    def run():
        once = T.stream_dedup(stream(spark, src), KEYS["book_ticker"])
        T.store_bars(T.stream_bars(once, "1 minute", watermarked=True), out, cp, every=None).awaitTermination()

    run()
    want = B.quote_bars_mid(frame(spark, rows), "1 minute")
    assert as_rows(T.read_bars(spark, out)) == as_rows(want)
    more = [(START + 2990.0, 1, 1000 + i, 100.0) for i in range(5)]
    frame(spark, more).coalesce(1).write.mode("append").parquet(src)
    run()  # goes on from the checkpoint
    want = B.quote_bars_mid(frame(spark, rows + more), "1 minute")
    assert as_rows(T.read_bars(spark, out)) == as_rows(want)


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    bars = B.quote_bars_mid(frame(spark, quotes(50)), "1 minute").withColumns(
        {"event_date": F.to_date("ts_second"), "batch_id": F.lit(0)})
    for _ in range(2):
        bars.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(f"{out}/versions")
    assert T.read_bars(spark, out).count() == bars.count() == spark.read.parquet(f"{out}/versions").count()


def test_rows_beyond_the_watermark_wait_for_a_refresh(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    early, late = [(START, 1, 1, 100.0)], [(START + 5, 1, 3, 90.0)]
    far = [(START + 86400, 1, 2, 100.0)]
    for part in (early, far, late):
        frame(spark, part).coalesce(1).write.mode("append").parquet(src)
        bars = T.stream_bars(stream(spark, src), "1 minute", lateness="1 hour")
        T.store_bars(bars, out, cp, every=None).awaitTermination()
    assert sum(r.update_count for r in T.read_bars(spark, out).collect()) == 2

    ticks, table = str(tmp_path / "ticks"), str(tmp_path / "bars")
    from tickspark.sources.tables import with_event_date, write_partitioned
    write_partitioned(with_event_date(frame(spark, early + far + late)), ticks, ["symbol_id", "ts_exchange"])
    T.refresh_bars(spark, ticks, table, "2023-11-14 00:00:00", "2023-11-16 00:00:00", "1 minute")
    assert sum(r.update_count for r in spark.read.parquet(table).collect()) == 3


def trades(spark, items):
    q = frame(spark, items)
    return q.select("ts_exchange", "ts_ingest", "symbol_id", F.col("update_id").alias("agg_trade_id"),
                    F.col("best_bid").alias("price"), F.col("bid_qty").alias("qty"), F.lit(True).alias("is_buyer_maker"))


def test_joined_bars_in_one_stream(spark, tmp_path):
    """Append mode: closed once a far later row has moved the watermark."""
    q, t, out, cp = (str(tmp_path / n) for n in ("q", "t", "out", "cp"))
    rows = quotes(120)
    far = [(START + 10 * 86400, 9, 9999, 1.0)]
    frame(spark, rows).coalesce(1).write.parquet(q)
    trades(spark, rows[:40]).coalesce(1).write.parquet(t)

    def run():
        joined = T.stream_joined_bars(stream(spark, q), stream(spark, t, TRADES), "1 minute").drop("window")
        (joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp)
         .trigger(availableNow=True).start().awaitTermination())

    run()
    for _ in range(2):
        frame(spark, far).coalesce(1).write.mode("append").parquet(q)
        trades(spark, far).coalesce(1).write.mode("append").parquet(t)
        run()
    got = spark.read.parquet(out).filter("symbol_id <> 9").select("ts_bucket", "symbol_id", "bid_close", "trade_count", "vwap")
    bars = B.quote_bars_bidask(frame(spark, rows), "1 minute")
    want = bars.join(B.trade_bars_ext(trades(spark, rows[:40]), "1 minute").select(
        "ts_bucket", "symbol_id", "trade_count", "vwap"), ["ts_bucket", "symbol_id"], "left").select(*got.columns)
    assert as_rows(got) == as_rows(want)


def test_ingest_survives_replay(spark, tmp_path):
    root, src = str(tmp_path / "root"), str(tmp_path / "src")
    symbols = spark.createDataFrame([(1, "AUSDT"), (2, "BUSDT")], "id long, symbol string")
    msg = ('{{"stream":"x@bookTicker","data":{{"E":{e},"s":"{s}","u":{u},"b":"{b}","B":"1","a":"2","A":"1"}}}}')
    good = [msg.format(e=1_700_000_000_000 + u, s="AUSDT" if u % 2 else "BUSDT", u=u, b="1") for u in range(10)]
    bad = [msg.format(e=1, s="AUSDT", u=99, b="?")]
    frame_of = lambda ms: spark.createDataFrame([(m,) for m in ms], "value string").withColumn(
        "ts_ingest", F.timestamp_seconds(F.lit(int(START))))
    frame_of(good + bad).coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for attempt in ("a", "b"):  # a lost checkpoint makes the feed start over
        T.stream_ingest(stream(spark, src, schema), symbols, root, f"{root}/cp_{attempt}", every=None).awaitTermination()
    stored = spark.read.parquet(f"{root}/book_ticker")
    assert stored.count() == 10 and stored.filter("symbol_id IS NULL").count() == 0
    assert [r.reject_reason for r in spark.read.parquet(f"{root}/rejects").collect()] == ["missing or invalid: best_bid"]


@pytest.mark.parametrize("lag,status", [("2023-11-14 22:13:40", "OK"), ("2023-11-14 22:14:20", "STALE")])
def test_heartbeat_status(spark, lag, status):
    beats = T.stream_heartbeat(frame(spark, [(START + 10.0, 1, 1, 1.0), (START, 1, 2, 1.0)]))
    r = T.heartbeat_status(beats, lag).first()
    assert (r.messages, r.status) == (2, status)


BAR = ("symbol_id long, ts_bucket timestamp, bid_close double, ask_close double, bid_qty_close double, ask_qty_close double, "
       "volume double, buy_volume double, sell_volume double, buy_ratio double")


def joined_bars(spark, seed=5):
    """Symbol 1 has a bar a day, 2 many bars but early trades only, 3 starts late, 4 never trades; some bars have no symbol."""
    rnd, rows = random.Random(seed), []

    def bar(symbol, day, hour, traded):
        bid, volume = rnd.uniform(90, 110), rnd.uniform(1, 5)
        sides = (volume, 0.0, 0.0, rnd.random()) if rnd.random() < 0.3 else (volume, volume / 3, volume * 2 / 3, None)
        rows.append((symbol, datetime(2024, 1, day, hour), bid, bid + 1, rnd.uniform(1, 9), rnd.uniform(1, 9), *(sides if traded else (None,) * 4)))

    for day in range(1, 29):
        bar(1, day, 7, True)
        for hour in range(0, 24, 3):
            bar(2, day, hour, day < 4)
            bar(4, day, hour, False)
            if day > 20:
                bar(3, day, hour, rnd.random() < 0.4)
        bar(None, day, 3, True)
    return spark.createDataFrame(rows, BAR)


def test_refreshed_features_look_back_in_rows(spark, tmp_path):
    bars, out, tails = (str(tmp_path / n) for n in ("bars", "features", "bars_tails"))
    every = joined_bars(spark)
    want = {as_key(r): r for r in M.market_features(every).collect()}
    S.export_parquet(every, bars, "ts_bucket")
    for start, end in (("2024-01-21", "2024-01-22"), ("2024-01-22 05:00:00", "2024-01-24 07:00:00")):
        T.refresh_features(spark, bars, out, start, end)
    got = spark.read.parquet(out).drop("event_date").collect()
    assert {r.ts_exchange.day for r in got} == {21, 22, 23, 24}
    assert len(got) == sum(21 <= r.ts_exchange.day <= 24 for r in want.values())
    for r in got:
        assert [v for c, v in r.asDict().items() if c != "ts_exchange"] == pytest.approx([want[as_key(r)][c] for c in r.asDict() if c != "ts_exchange"])
    # Tails are read, not made again, until their bars change.
    days = S.stored_days(spark, tails)
    assert T.update_feature_tails(spark, bars, tails, days) == []
    assert spark.read.parquet(tails).count() < every.count()
    S.export_parquet(every.filter("to_date(ts_bucket) = '2024-01-20'").withColumn("bid_close", F.col("bid_close") + 1), bars, "ts_bucket")
    assert T.update_feature_tails(spark, bars, tails, days) == ["2024-01-20"]


def as_key(r):
    return r.symbol_id, r.ts_exchange


def test_refresh_without_history(spark, tmp_path):
    bars, out = str(tmp_path / "bars"), str(tmp_path / "features")
    first = joined_bars(spark).filter("ts_bucket < '2024-01-03'")
    S.export_parquet(first, bars, "ts_bucket")
    T.refresh_features(spark, bars, out, "2024-01-01", "2024-01-03")
    assert as_rows(spark.read.parquet(out).drop("event_date")) == as_rows(M.market_features(first))
