"""The given tables read as market data. The SQL side repeats these definitions in ``oracles``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.session import configure

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

#: Levels on each side of a book.
LEVELS = 5


def _typed(raw: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    ts = F.col("ts").cast("timestamp")
    return raw.select("event_id", ts.alias("ts"), "user_id", "event_type", "value", k.alias("k")).withColumn(
        "ts_ingest", F.timestamp_micros(F.unix_micros("ts") + (F.col("k") - 5) * 1000))


class Market:
    """Lazy views of one scale-factor folder; ``streaming=True`` reads the same files as a stream."""

    def __init__(self, spark: SparkSession, sf_dir: str, streaming: bool = False):
        self.spark, self.dir, self.streaming = configure(spark), sf_dir, streaming

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def events(self) -> DataFrame:
        if self.streaming:
            raw = self.spark.readStream.schema(EVENTS).option("pathGlobFilter", "events*.parquet").parquet(self.dir)
        else:
            raw = self.table("events")
        return _typed(raw)

    @property
    def symbols(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("id"), F.col("r_name").alias("exchange"),
            F.col("n_name").alias("symbol"), (F.col("n_nationkey") % 5 != 4).alias("is_active"))

    @property
    def _keyed(self) -> DataFrame:
        return self.events.withColumn("symbol_id", F.col("user_id") % 25)

    @property
    def bt(self) -> DataFrame:
        return self._keyed.filter("event_type <> 'purchase'").select(
            F.col("ts").alias("ts_exchange"), "ts_ingest", "symbol_id", F.col("event_id").alias("update_id"),
            F.col("value").alias("best_bid"),
            (F.col("value") + (F.col("event_id") % 11 - 1) * F.lit(0.01)).alias("best_ask"),
            F.col("k").cast("double").alias("bid_qty"), ((F.col("event_id") * 7) % 53).cast("double").alias("ask_qty"))

    @property
    def tr(self) -> DataFrame:
        return self._trades(self._keyed)

    def _trades(self, keyed: DataFrame) -> DataFrame:
        return keyed.filter("event_type IN ('purchase', 'click')").select(
            F.col("ts").alias("ts_exchange"), "ts_ingest", "symbol_id", F.col("event_id").alias("agg_trade_id"),
            F.col("value").alias("price"), ((F.col("k") + 1) / F.lit(10.0)).alias("qty"),
            (F.col("event_id") % 2 == 1).alias("is_buyer_maker"))

    @property
    def de(self) -> DataFrame:
        return self._depth(self._keyed)

    def _depth(self, keyed: DataFrame) -> DataFrame:
        cents = F.round(F.col("value") * 100).cast("bigint")
        rows = keyed.filter("event_type <> 'error'").withColumn("cents", cents)

        def side(price, qty):
            return F.array(*[F.struct(
                (price(i) / F.lit(100.0)).alias("price"), qty(i).cast("double").alias("qty")) for i in range(LEVELS)])

        return rows.select(
            F.col("ts").alias("ts_exchange"), "ts_ingest", "symbol_id",
            (F.col("event_id") * 10).alias("first_update_id"), (F.col("event_id") * 10 + 9).alias("final_update_id"),
            (F.col("event_id") * 10 - 1).alias("prev_final_update_id"),
            side(lambda i: F.col("cents") - i, lambda i: (F.col("k") + 3 * i) % 17).alias("bids"),
            side(lambda i: F.col("cents") + 1 + i, lambda i: (F.col("event_id") + 5 * i) % 13).alias("asks"))

    @property
    def redelivered(self) -> DataFrame:
        """Every quote delivered twice, the second time one second later."""
        again = self.bt.withColumn("ts_ingest", F.timestamp_micros(F.unix_micros("ts_ingest") + 1_000_000))
        return self.bt.unionByName(again)

    @property
    def ingest_log(self) -> DataFrame:
        """One row per ingested event with its stream; error events count as failed."""
        kind = F.when(F.col("event_type") == "purchase", "aggTrade").otherwise("bookTicker")
        return self._keyed.select(
            F.col("ts").alias("ts_exchange"), "ts_ingest", "symbol_id", kind.alias("stream_type"), "event_id",
            (F.col("event_type") != "error").alias("ok"))

    @property
    def _dealt(self) -> DataFrame:
        """The events dealt evenly over the cores. Making and parsing its messages costs far more than moving an event, and
        files may have few row groups."""
        if self.streaming:
            return self._keyed
        cores = self.spark.sparkContext.defaultParallelism
        return self._keyed.repartition(max(4 * cores, self.table("events").rdd.getNumPartitions()))

    def _symbol_text(self):
        return F.concat(F.lit("NATION_"), F.col("symbol_id").cast("string"))

    @property
    def messages(self) -> DataFrame:
        """The facts as feed messages ``{stream, data}``, prices and quantities as JSON strings.

        Error events become malformed quotes: their bid price is not a number.
        """
        s, ms = self._symbol_text(), F.unix_millis("ts_exchange")

        def text(c):
            return F.col(c).cast("string")

        def levels(side):
            return F.array(*[F.array(
                F.col(side)[i]["price"].cast("string"), F.col(side)[i]["qty"].cast("string")) for i in range(LEVELS)])

        def envelope(mark, payload, df):
            return df.select("ts_ingest", F.to_json(F.struct(
                F.concat(F.lower(s), F.lit(mark)).alias("stream"), payload.alias("data"))).alias("value"))

        bid = F.when(F.col("event_type") == "error", "n/a").otherwise(text("best_bid"))
        events = self._dealt
        quotes = events.filter("event_type <> 'purchase'").select(
            F.col("ts").alias("ts_exchange"), "ts_ingest", "symbol_id", "event_type",
            F.col("event_id").alias("update_id"), F.col("value").alias("best_bid"),
            (F.col("value") + (F.col("event_id") % 11 - 1) * F.lit(0.01)).alias("best_ask"),
            F.col("k").cast("double").alias("bid_qty"), ((F.col("event_id") * 7) % 53).cast("double").alias("ask_qty"))
        bt = envelope("@bookTicker", F.struct(
            F.lit("bookTicker").alias("e"), ms.alias("E"), s.alias("s"), F.col("update_id").alias("u"), bid.alias("b"),
            text("bid_qty").alias("B"), text("best_ask").alias("a"), text("ask_qty").alias("A")), quotes)
        tr = envelope("@aggTrade", F.struct(
            F.lit("aggTrade").alias("e"), ms.alias("E"), ms.alias("T"), s.alias("s"),
            F.col("agg_trade_id").alias("a"), text("price").alias("p"), text("qty").alias("q"),
            F.col("is_buyer_maker").alias("m")), self._trades(events))
        de = envelope("@depth", F.struct(
            F.lit("depthUpdate").alias("e"), ms.alias("E"), s.alias("s"), F.col("first_update_id").alias("U"),
            F.col("final_update_id").alias("u"), F.col("prev_final_update_id").alias("pu"),
            levels("bids").alias("b"), levels("asks").alias("a")), self._depth(events))
        return bt.unionByName(tr).unionByName(de)
