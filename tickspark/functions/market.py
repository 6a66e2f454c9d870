"""Price, quantity and order-book expressions on single rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickspark.functions.time import _col


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where the denominator is 0 or NULL."""
    return F.try_divide(num, den)


def spread(bid="best_bid", ask="best_ask") -> Column:
    return _col(ask) - _col(bid)


def mid(bid="best_bid", ask="best_ask") -> Column:
    return (_col(ask) + _col(bid)) / 2.0


def spread_bps(bid="best_bid", ask="best_ask") -> Column:
    m = mid(bid, ask)
    return F.when(m > 0, spread(bid, ask) / m * 10000.0)


def spread_pct(denominator: str = "mid", bid="best_bid", ask="best_ask") -> Column:
    """Spread in percent of the mid, the ask or the bid."""
    base = {"mid": mid(bid, ask), "ask": _col(ask), "bid": _col(bid)}[denominator]
    return ratio(spread(bid, ask), base) * 100.0


def trade_value(price="price", qty="qty") -> Column:
    return _col(price) * _col(qty)


def balance(a: Column, b: Column, empty: float | None = None) -> Column:
    """(a - b) / (a + b); ``empty`` where a + b is not positive."""
    total = a + b
    return F.when(total > 0, (a - b) / total).otherwise(F.lit(empty).cast("double"))


def microprice(bid="best_bid", ask="best_ask", bid_qty="bid_qty", ask_qty="ask_qty") -> Column:
    """Quantity-weighted price; the mid when both quantities are 0."""
    b, a, bq, aq = _col(bid), _col(ask), _col(bid_qty), _col(ask_qty)
    return F.when(bq + aq == 0, (b + a) / 2.0).otherwise(ratio(b * aq + a * bq, bq + aq))


def microprice_deviation(bid="best_bid", ask="best_ask", bid_qty="bid_qty", ask_qty="ask_qty") -> Column:
    return F.abs(microprice(bid, ask, bid_qty, ask_qty) - mid(bid, ask))


def imbalance(bid_qty="bid_qty", ask_qty="ask_qty") -> Column:
    """Top-of-book imbalance, 0 when the book is empty."""
    bq, aq = _col(bid_qty), _col(ask_qty)
    return F.when(bq + aq == 0, F.lit(0.0)).otherwise(ratio(bq - aq, bq + aq))


def tick_imbalance(bid_qty="bid_qty", ask_qty="ask_qty") -> Column:
    """Like :func:`imbalance`, but NULL when the book is empty."""
    bq, aq = _col(bid_qty), _col(ask_qty)
    return ratio(bq - aq, bq + aq)


def side_qty(levels="bids", n: int | None = None) -> Column:
    """Summed quantity of the first ``n`` levels of one side."""
    side = _col(levels)
    if n is not None:
        side = F.slice(side, 1, n)
    return F.aggregate(side, F.lit(0.0), lambda acc, level: acc + level["qty"])


def depth_imbalance(n: int, bids="bids", asks="asks") -> Column:
    """Imbalance of the summed top-n quantities, 0 if a side is missing or both sums are 0."""
    b, a = side_qty(bids, n), side_qty(asks, n)
    one_sided = (
        F.coalesce(F.size(_col(bids)), F.lit(0)) < 1
    ) | (F.coalesce(F.size(_col(asks)), F.lit(0)) < 1)
    return F.when(one_sided | (a + b == 0), F.lit(0.0)).otherwise(ratio(b - a, b + a))


def buy_volume_ratio(buy="buy_volume", sell="sell_volume") -> Column:
    b, s = _col(buy), _col(sell)
    return F.when(b + s > 0, b / (b + s)).otherwise(F.lit(0.5))


def volume_imbalance(buy="buy_volume", sell="sell_volume") -> Column:
    b, s = F.coalesce(_col(buy), F.lit(0.0)), F.coalesce(_col(sell), F.lit(0.0))
    return balance(b, s, empty=0.0)


def flow(price: Column, prev_price: Column, qty: Column, prev_qty: Column, up: Column, down: Column,
         tolerance: float = 1e-8) -> Column:
    """Change of resting quantity: Δqty at an unchanged price, else ``up`` or ``down``."""
    return (
        F.when(F.abs(price - prev_price) < tolerance, qty - prev_qty)
        .when(price > prev_price, up)
        .otherwise(down)
    )


def base_asset(symbol="symbol", quote: str = "USDT") -> Column:
    return F.split_part(_col(symbol), F.lit(quote), F.lit(1))


def stream_symbol(stream="stream") -> Column:
    """Upper-case symbol of a stream name such as ``btcusdt@aggTrade``."""
    return F.upper(F.regexp_extract(_col(stream), r"^([^@]+)@", 1))


def level_count(levels: str) -> Column:
    return F.coalesce(F.size(F.col(levels)), F.lit(0)).cast("long")


def is_buy(flag="is_buyer_maker") -> Column:
    """The aggressor bought: the buyer was not the maker."""
    return _col(flag) == F.lit(False)
