"""Microstructure measures over ticks, bars and depth updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators.ordered import (
    CHUNK, INDEX, TICK_BLOCK, TOTAL, chunk_window, chunks_by, own_rows, row_chunks, time_halo, with_previous, with_row_index)

BAR_ORDER = ["ts_bucket"]
RATIO_GUARD = 0.0001


def with_microprice(bt: DataFrame) -> DataFrame:
    return bt.withColumn("microprice", X.microprice())


def with_imbalance(bt: DataFrame) -> DataFrame:
    return bt.withColumn("i1", X.imbalance())


def with_depth_imbalance(de: DataFrame, n: int) -> DataFrame:
    return de.withColumn(f"i{n}", X.depth_imbalance(n))


def ofi_column(bid, ask, bid_qty, ask_qty, prev: str = "prev_", ask_sign: str = "reference") -> Column:
    """Order-flow imbalance of one row against the previous row's quote.

    ``ask_sign="reference"`` adds the ask quantity change at an unchanged price, ``"standard"``
    subtracts it. 0 where there is no previous row.
    """
    b, a, bq, aq = (F.col(c) for c in (bid, ask, bid_qty, ask_qty))
    pb, pa, pbq, paq = (F.col(prev + c) for c in (bid, ask, bid_qty, ask_qty))
    bids = X.flow(b, pb, bq, pbq, up=bq, down=-pbq)
    asks = X.flow(a, pa, aq, paq, up=paq, down=-aq)
    if ask_sign == "standard":
        asks = F.when(F.abs(a - pa) < 1e-8, paq - aq).otherwise(asks)
    return F.when(pb.isNull(), F.lit(0.0)).otherwise(bids + asks)


def ofi_events(bt: DataFrame, ask_sign: str = "reference", block: str = TICK_BLOCK) -> DataFrame:
    quote = ["best_bid", "best_ask", "bid_qty", "ask_qty"]
    ticks = bt.select("symbol_id", "ts_exchange", "update_id", *quote)
    return (
        with_previous(ticks, ["symbol_id"], ["ts_exchange", "update_id"], quote, block)
        .select(*ticks.columns, ofi_column(*quote, ask_sign=ask_sign).alias("ofi"))
    )


def ofi_within_bucket(depth: DataFrame) -> DataFrame:
    """Order flow between the first and last book state of each bucket, and its bid share."""
    bid = F.when(F.col("last_bid_price") == F.col("first_bid_price"),
                 F.col("last_bid_qty") - F.col("first_bid_qty")).otherwise(F.col("last_bid_qty"))
    ask = F.when(F.col("last_ask_price") == F.col("first_ask_price"),
                 F.col("last_ask_qty") - F.col("first_ask_qty")).otherwise(-F.col("last_ask_qty"))
    return (
        depth.select("ts_bucket", "symbol_id", F.col("last_bid_price").alias("bid_price"),
                     F.col("last_ask_price").alias("ask_price"), bid.alias("bid_flow"), ask.alias("ask_flow"))
        .withColumns({
            "ofi": F.col("bid_flow") + F.col("ask_flow"),
            "ofi_ratio": X.ratio(F.col("bid_flow"),
                                 F.col("bid_flow") + F.abs("ask_flow") + F.lit(RATIO_GUARD)),
        })
    )


def _side_volumes() -> tuple[Column, Column]:
    buy, sell = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("buy_volume", "sell_volume"))
    share = F.coalesce("buy_ratio", F.lit(0.5))
    empty = (buy == 0) & (sell == 0)
    return (F.when(F.col("volume").isNull(), None).otherwise(F.when(empty, F.col("volume") * share).otherwise(buy)),
            F.when(F.col("volume").isNull(), None).otherwise(F.when(empty, F.col("volume") * (1 - share)).otherwise(sell)))


def split_volume(bars: DataFrame) -> DataFrame:
    """Reconstruct side volumes from the buy ratio where both are 0 and there is volume."""
    buy, sell = _side_volumes()
    return bars.withColumns({"buy_volume": buy, "sell_volume": sell})


def with_volume_ratios(bars: DataFrame) -> DataFrame:
    return bars.withColumns({
        "volume_imbalance": X.volume_imbalance(),
        "buy_volume_ratio": F.coalesce(X.buy_volume_ratio(), F.lit(0.5)),
    })


def _is_traded() -> Column:
    return F.col("buy_volume") + F.col("sell_volume") > 0


def _with_vpin(indexed: DataFrame, n: int) -> DataFrame:
    """Adds ``vpin`` to rows that :func:`row_chunks` has numbered, their traded bars in ``_traded``."""
    last_n = chunk_window(["symbol_id"], -(n - 1), 0)
    total = F.col("buy_volume") + F.col("sell_volume")
    share = F.when(F.count(F.lit(1)).over(last_n) < 2, 0.0).otherwise(
        F.abs(F.col("buy_volume") - F.col("sell_volume")) / F.avg(total).over(last_n))
    chunks = chunks_by(indexed, "_traded", before=n - 1, where=_is_traded())
    return own_rows(chunks.withColumn("vpin", F.when(_is_traded(), share))).drop("_traded")


def vpin_like(bars: DataFrame, n: int = 10) -> DataFrame:
    """|buy - sell| over the mean volume of the last n traded bars, current one included.

    0 while fewer than two bars have traded, NULL on bars without trades.
    """
    return _with_vpin(with_row_index(bars, ["symbol_id"], BAR_ORDER, counted={"_traded": _is_traded()}), n)


def _mid_of_bar() -> Column:
    return X.mid("bid_close", "ask_close")


def _step_return(price: Column, prev: Column, floor: Column | None) -> Column:
    """ln(price / prev); ``floor`` where the previous price is not positive."""
    return F.when(prev > 0, F.ln(price / prev)).when(prev <= 0, floor)


def log_return(bars: DataFrame) -> DataFrame:
    priced = bars.withColumn("_mid", _mid_of_bar())
    return (
        with_previous(priced, ["symbol_id"], BAR_ORDER, ["_mid"], "1 day")
        .withColumn("return_1s", _step_return(F.col("_mid"), F.col("prev__mid"), None))
        .drop("_mid", "prev__mid")
    )


def rolling_volatility(bars: DataFrame, n: int = 10) -> DataFrame:
    """Population deviation of the log returns among the last n mid prices; 0 before two prices."""
    row = chunk_window(["symbol_id"])
    frame = chunk_window(["symbol_id"], -(n - 2), 0)
    chunks = row_chunks(bars.withColumn("_mid", _mid_of_bar()), ["symbol_id"], BAR_ORDER, before=n)
    return own_rows(
        chunks.withColumn("_ret", _step_return(F.col("_mid"), F.lag("_mid").over(row), F.lit(0.0)))
        .withColumn("price_volatility", F.coalesce(F.stddev_pop("_ret").over(frame), F.lit(0.0)))
        .drop("_mid", "_ret")
    )


def market_features(bars: DataFrame, n: int = 10, ask_sign: str = "reference") -> DataFrame:
    """The full feature row of every joined bar.

    All order-dependent features except vpin share one chunking and one window sort; the same numbering deals the
    traded bars for vpin. ``i10`` comes from the column of that name when the bars carry depth, else it repeats ``i1``.
    """
    quote = ["bid_close", "ask_close", "bid_qty_close", "ask_qty_close"]
    keys = ["symbol_id", "ts_bucket"]
    row = chunk_window(["symbol_id"])
    frame = chunk_window(["symbol_id"], -(n - 2), 0)
    mid = F.col("mid_price")
    volumes = with_volume_ratios(split_volume(bars))
    carried = [c for c in ("i10",) if c in bars.columns]
    chunks = (
        row_chunks(volumes.select(*keys, *quote, "volume_imbalance", "buy_volume_ratio", "buy_volume", "sell_volume", *carried,
                                  _mid_of_bar().alias("mid_price")),
                   ["symbol_id"], BAR_ORDER, before=n, counted={"_traded": _is_traded()})
        .withColumns({"prev_" + c: F.lag(c).over(row) for c in [*quote, "mid_price"]})
        .withColumn("_ret", _step_return(mid, F.col("prev_mid_price"), F.lit(0.0)))
        .withColumn("price_volatility", F.coalesce(F.stddev_pop("_ret").over(frame), F.lit(0.0)))
    )
    i1 = X.imbalance("bid_qty_close", "ask_qty_close")
    gap = F.col("ask_close") - F.col("bid_close")
    features = own_rows(chunks, keep_index=True).select(
        F.col("ts_bucket").alias("ts_exchange"), "symbol_id",
        X.microprice(*quote).alias("microprice"), "mid_price", gap.alias("spread_abs"),
        F.when(mid > 0, gap / mid).otherwise(0.0).alias("spread_rel"),
        i1.alias("i1"), (F.coalesce("i10", i1) if carried else i1).alias("i10"),
        ofi_column(*quote, ask_sign=ask_sign).alias("ofi"),
        "volume_imbalance", "buy_volume_ratio", "price_volatility",
        _step_return(mid, F.col("prev_mid_price"), None).alias("return_1s"),
        "buy_volume", "sell_volume", INDEX, TOTAL, "_traded",
    )
    return _with_vpin(features, n).drop("buy_volume", "sell_volume")


def feature_tails(bars: DataFrame, by: list[str], n: int = 10) -> DataFrame:
    """The bars of each group that :func:`market_features` of later bars looks back at: the last n, and the last n traded.

    ``by`` names the group, such as a symbol and day; one group's bars are sorted in one task.
    """
    newest = Window.partitionBy(*by).orderBy(F.desc("ts_bucket"))
    buy, sell = _side_volumes()
    return (
        bars.withColumn("_traded", F.coalesce(buy + sell > 0, F.lit(False)))
        .withColumns({"_at": F.row_number().over(newest), "_traded_at": F.sum(F.col("_traded").cast("long")).over(newest)})
        .filter((F.col("_at") <= n) | (F.col("_traded") & (F.col("_traded_at") <= n)))
        .drop("_at", "_traded_at", "_traded"))


def _sorted_side(levels: str, best_first_desc: bool) -> Column:
    """Non-empty levels, best first. Sorting by price does not rely on the feed's order."""
    kept = F.filter(F.col(levels), lambda level: level["qty"] > 0)
    return F.sort_array(kept, asc=not best_first_desc)


def _wall_price(side: str, qty: str, n: int) -> Column:
    """Price of the nearest level that holds the wall's quantity."""
    return F.coalesce(*[F.when(F.col(f"{side}{i}_qty") == F.col(qty), F.col(f"{side}{i}_price")) for i in range(1, n + 1)])


def flatten_topn(de: DataFrame, n: int = 5) -> DataFrame:
    """One wide row per depth update: n levels per side, totals and book features.

    Levels of quantity 0 are deletions and are dropped. A wall is the largest level of its side
    among the top n, ties going to the nearest one, with its distance from the mid in bps;
    ``wall_size_bps`` is the distance of the larger wall. Only cutting the two sides works on arrays;
    everything after it is arithmetic on columns, which is compiled.
    """
    cut = de.select(
        "ts_exchange", "symbol_id", "final_update_id",
        F.slice(_sorted_side("bids", True), 1, n).alias("_b"), F.slice(_sorted_side("asks", False), 1, n).alias("_a"))
    cols = []
    for side in ("b", "a"):
        for i in range(n):
            level = F.try_element_at(f"_{side}", F.lit(i + 1))
            cols += [level["price"].alias(f"{side}{i + 1}_price"), level["qty"].alias(f"{side}{i + 1}_qty")]
    flat = cut.select("ts_exchange", "symbol_id", "final_update_id", *cols)

    def qtys(side):
        return [F.col(f"{side}{i}_qty") for i in range(1, n + 1)]

    def largest(side):
        return F.greatest(*qtys(side)) if n > 1 else qtys(side)[0]

    sums = {f"total_{name}_qty": sum((F.coalesce(q, F.lit(0.0)) for q in qtys(side)[1:]),
                                     F.coalesce(qtys(side)[0], F.lit(0.0))) for side, name in (("b", "bid"), ("a", "ask"))}
    mid = X.mid("b1_price", "a1_price")
    two_sided = F.col("b1_price").isNotNull() & F.col("a1_price").isNotNull()

    def distance(side, qty):
        return F.when(mid > 0, F.abs(_wall_price(side, qty, n) - mid) / mid * 10000.0)

    return (
        flat.withColumns({**sums, "wall_size_bid": largest("b"), "wall_size_ask": largest("a")})
        .withColumns({
            "microprice": F.when(two_sided, X.microprice("b1_price", "a1_price", "b1_qty", "a1_qty")),
            "i1": F.when(two_sided, X.imbalance("b1_qty", "a1_qty")).otherwise(0.0),
            f"i{n}": F.when(two_sided, X.imbalance("total_bid_qty", "total_ask_qty")).otherwise(0.0),
            "wall_dist_bid_bps": distance("b", "wall_size_bid"), "wall_dist_ask_bps": distance("a", "wall_size_ask"),
        })
        .withColumn("wall_size_bps", F.when(F.col("wall_size_bid") >= F.col("wall_size_ask"), F.col("wall_dist_bid_bps"))
                    .otherwise(F.col("wall_dist_ask_bps")))
    )


def book_walls(topn: DataFrame) -> DataFrame:
    return topn.select("ts_exchange", "symbol_id", "final_update_id", "wall_size_bid", "wall_size_ask",
                       "wall_dist_bid_bps", "wall_dist_ask_bps")


def ofi_rolling(topn: DataFrame, reach: str = "1 second", block: str = TICK_BLOCK,
                ask_sign: str = "reference") -> DataFrame:
    """Order-flow imbalance of the best level summed over the trailing ``reach``."""
    quote = ["b1_price", "a1_price", "b1_qty", "a1_qty"]
    order = ["ts_exchange", "final_update_id"]
    books = topn.select("symbol_id", *order, *quote).filter("b1_price IS NOT NULL AND a1_price IS NOT NULL")
    steps = (
        with_previous(books, ["symbol_id"], order, quote, block)
        .select("symbol_id", *order, ofi_column(*quote, ask_sign=ask_sign).alias("ofi"))
    )
    trailing = (
        Window.partitionBy("symbol_id", CHUNK).orderBy(F.unix_micros("ts_exchange"))
        .rangeBetween(-X.width_us(reach), 0)
    )
    return (
        time_halo(steps, "ts_exchange", reach, block)
        .withColumn("ofi_1s", F.sum("ofi").over(trailing))
        .filter("NOT _halo").drop(CHUNK, "_halo")
    )


def with_tick_imbalance(bt: DataFrame) -> DataFrame:
    return bt.withColumn("ofi", X.tick_imbalance())


def with_microprice_deviation(bt: DataFrame) -> DataFrame:
    return bt.withColumn("microprice_deviation", X.microprice_deviation())
