"""

200 symbols, one of which holds a third of all quotes. ``BENCH_ROWS`` sets the quotes (43.2 million by default), ``BENCH_CPUS`` the
local cores. The day is written below the session's work folder first, so reading it is part of every figure.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickspark.operators import bars as B  # noqa: E402
from tickspark.operators import joins as J  # noqa: E402
from tickspark.operators import micro as M  # noqa: E402
from tickspark.plans import datasets  # noqa: E402
from tickspark.session import build_session, work_dir  # noqa: E402

SYMBOLS = 200
DAY = "2024-01-15"


def made(spark, rows: int, path: str):
    """Quotes and trades of one day, spread evenly over it, at whole milliseconds."""
    ms = F.unix_millis(F.lit(DAY).cast("timestamp")) + F.floor(F.col("id") * F.lit(86_400_000 / rows))
    dice = F.xxhash64("id")
    base = spark.range(rows).select(
        "id", F.timestamp_millis(ms).alias("ts_exchange"),
        F.when(F.pmod(dice, F.lit(3)) == 0, 1).otherwise(1 + F.pmod(F.shiftright(dice, 8), F.lit(SYMBOLS))).cast("bigint").alias("symbol_id"),
        (100 + F.pmod(F.shiftright(dice, 20), F.lit(1000)) / 100.0).alias("price"), F.pmod(F.shiftright(dice, 40), F.lit(50)).cast("double").alias("size"))
    late = F.timestamp_micros(F.unix_micros("ts_exchange") + 3000)
    quotes = base.select("ts_exchange", late.alias("ts_ingest"), "symbol_id", F.col("id").alias("update_id"), F.col("price").alias("best_bid"),
                         (F.col("price") + 0.01).alias("best_ask"), (F.col("size") + 1).alias("bid_qty"), (51 - F.col("size")).alias("ask_qty"))
    trades = base.where("id % 5 = 0").select(
        "ts_exchange", late.alias("ts_ingest"), "symbol_id", F.col("id").alias("agg_trade_id"), "price", (F.col("size") + 1).alias("qty"),
        (F.col("id") % 2 == 0).alias("is_buyer_maker"))
    quotes.write.parquet(f"{path}/quotes")
    trades.write.parquet(f"{path}/trades")
    return spark.read.parquet(f"{path}/quotes"), spark.read.parquet(f"{path}/trades")


def main() -> None:
    rows = int(os.environ.get("BENCH_ROWS", "43200000"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench-day", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(4 * int(cpus)), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    out: dict[str, float] = {}

    def timed(name: str, df) -> None:
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - start, 1)

    for share in (4, 1):
        quotes, trades = made(spark, rows // share, work_dir(spark, "day"))
        label = f"{rows // share} quotes: "
        if share == 4:
            quotes.write.format("noop").mode("overwrite").save()  # warm-up
        timed(label + "raw to one-second mid bars", B.quote_bars_mid(quotes))
        timed(label + "m4 order flow of every quote", M.ofi_events(quotes))
        second = B.quote_bars_mid(quotes), B.trade_bars(trades)
        minute = B.quote_bars_bidask(quotes, "1 minute"), B.trade_bars_ext(trades, "1 minute")
        empty = B.depth_bars(spark.createDataFrame([], "ts_exchange timestamp, symbol_id bigint, final_update_id bigint, bids "
                                                   "array<struct<price:double,qty:double>>, asks array<struct<price:double,qty:double>>"), "1 minute")
        timed(label + "m11 market features of one-minute bars", M.market_features(J.market_data_bars(*minute, empty)))
        symbols = spark.range(1, SYMBOLS + 1).select("id", F.lit("x").alias("exchange"), F.concat(F.lit("S"), F.col("id")).alias("symbol"), F.lit(True).alias("is_active"))
        timed(label + "l3 hourly features", datasets.hourly_ml_features(*[f(t, "1 hour") for f, t in ((B.quote_bars_mid, quotes), (B.trade_bars, trades))], symbols, DAY, DAY))
        stored = [work_dir(spark, "bars") for _ in second]
        for df, path in zip(second, stored):
            df.write.parquet(path)
        timed(label + "training dataset of the day from stored bars", datasets.training_day(*[spark.read.parquet(p) for p in stored], symbols, DAY))
    print(json.dumps({"metric": "day_seconds", "unit": "sec", "rows": rows, "cpus": int(cpus), "seconds": out}))


if __name__ == "__main__":
    main()
