"""Feed messages to typed facts. Works on batch and streaming DataFrames alike.

Input is a ``value`` column with one JSON message per row and, where known, a ``ts_ingest`` column.
A message that does not yield a complete row keeps a ``reject_reason``; nothing is dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.schemas import ENVELOPE, LEVELS_WIRE, MESSAGE

# Event names of the feed and the stream markers they travel under.
BOOK_TICKER, AGG_TRADE, DEPTH = "bookTicker", "aggTrade", "depthUpdate"
STREAM_MARKS = {"@bookTicker": BOOK_TICKER, "@aggTrade": AGG_TRADE, "@depth": DEPTH}


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose parsing runs once per message.

    A filter on columns derived from it would otherwise be pushed below the projection with the
    parser copied into every condition; nothing is pushed through a generator's output.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def read_envelope(df: DataFrame) -> DataFrame:
    """Split ``{stream, data}`` and name the event kind.

    A message without either, or of a stream nobody reads, has no kind, keeps its text as ``data`` and says why in
    ``unrouted_reason``; :func:`unrouted` lists such messages.
    """
    kind = F.lit(None).cast("string")
    for mark, name in reversed(STREAM_MARKS.items()):
        kind = F.when(F.col("stream").contains(mark), name).otherwise(kind)
    rest = [c for c in df.columns if c != "value"]
    stream, data = F.col("_e.stream"), F.col("_e.data")
    whole = stream.isNotNull() & data.isNotNull()
    reason = (
        F.when(whole & F.col("kind").isNotNull(), None).when(whole, "unknown stream")
        .when(F.get_json_object("value", "$").isNull(), "not JSON").when(stream.isNull(), "no stream").otherwise("no data")
    )
    return (
        _once(df, "_e", F.from_json("value", ENVELOPE))
        .select("value", *rest, "_e", stream.alias("stream"), F.when(whole, data).otherwise(F.col("value")).alias("data"))
        .withColumn("kind", F.when(whole, kind))
        .select(*rest, "stream", "data", "kind", reason.alias("unrouted_reason"))
    )


def unrouted(envelopes: DataFrame) -> DataFrame:
    """Messages that no parser takes, shaped like :func:`rejected`."""
    return envelopes.filter("unrouted_reason IS NOT NULL").select(
        "data", _ingest(envelopes).alias("ts_ingest"), F.col("unrouted_reason").alias("reject_reason"))


def read_bare(df: DataFrame) -> DataFrame:
    """Messages without an envelope: routed by the event field, else by the fields present."""
    parsed = _once(df, "_m", F.from_json("value", MESSAGE))

    def has(path):
        return _text(path).isNotNull()

    event = _text("e")
    kind = (
        F.when(event.isin(BOOK_TICKER, AGG_TRADE, DEPTH), event)
        .when(event.isNotNull(), None)
        .when(has("p") & has("q") & has("m"), AGG_TRADE)
        .when(has("B") & has("A"), BOOK_TICKER)
        .when(has("U"), DEPTH)
    )
    return parsed.select(*[c for c in df.columns if c != "value"], F.col("value").alias("data"), kind.alias("kind"))


def _ingest(df: DataFrame) -> Column:
    return F.col("ts_ingest") if "ts_ingest" in df.columns else F.current_timestamp()


def _text(field: str) -> Column:
    return F.try_element_at("_m", F.lit(field))


def _message(df: DataFrame) -> DataFrame:
    return _once(df, "_m", F.from_json("data", MESSAGE))


def _side(name: str) -> Column:
    return F.from_json(_text(name), LEVELS_WIRE).alias(name)


def _finite(value: Column) -> Column:
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def _number(field: str, kind: str = "double") -> Column:
    """The field as a number; NULL for text that is none, and for what is not finite."""
    value = _text(field).try_cast(kind)
    return _finite(value) if kind == "double" else value


def _parsed(df: DataFrame, kind: str, columns: dict[str, Column], required: list[str]) -> DataFrame:
    rows = df.filter(F.col("kind") == kind) if "kind" in df.columns else df
    parsed = _message(rows)
    if kind == DEPTH:
        parsed = _once(parsed, "_levels", F.struct(_levels("b"), _levels("a")))
    typed = parsed.select(
        "data", _text("s").alias("symbol"), _ingest(df).alias("ts_ingest"),
        *[c.alias(n) for n, c in columns.items()])
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ["symbol", *required]]))
    return typed.withColumn("reject_reason", F.when(F.size(missing) > 0, F.concat(
        F.lit("missing or invalid: "), F.array_join(missing, ","))))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reject_reason IS NULL").drop("data", "reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reject_reason IS NOT NULL").select("data", "ts_ingest", "reject_reason")


def parse_book_ticker(df: DataFrame) -> DataFrame:
    cols = {
        "ts_exchange": X.from_epoch_ms(_number("E", "bigint")), "update_id": _number("u", "bigint"),
        "best_bid": _number("b"), "best_ask": _number("a"), "bid_qty": _number("B"), "ask_qty": _number("A"),
    }
    parsed = _parsed(df, BOOK_TICKER, cols,
                     ["ts_exchange", "best_bid", "best_ask", "bid_qty", "ask_qty"])
    return parsed.withColumns({"spread": X.spread(), "mid": X.mid()})


def parse_agg_trade(df: DataFrame, time_field: str = "E") -> DataFrame:
    cols = {
        "ts_exchange": X.from_epoch_ms(_number(time_field, "bigint")), "agg_trade_id": _number("a", "bigint"),
        "price": _number("p"), "qty": _number("q"), "is_buyer_maker": _number("m", "boolean"),
    }
    return _parsed(df, AGG_TRADE, cols,
                   ["ts_exchange", "agg_trade_id", "price", "qty", "is_buyer_maker"])


def _levels(side: str) -> Column:
    """A side's levels as numbers, text that is none becoming NULL; no levels if a number is not finite.

    Each array is built once: a lambda's variable stands for it in the check and in the result.
    """
    end = F.lit(float("inf"))
    typed = F.transform(F.from_json(_text(side), LEVELS_WIRE), lambda level: F.struct(
        F.try_element_at(level, F.lit(1)).try_cast("double").alias("price"),
        F.try_element_at(level, F.lit(2)).try_cast("double").alias("qty")))
    endless = lambda v: (F.abs(v["price"]) >= end) | (F.abs(v["qty"]) >= end)  # noqa: E731  NaN is above all
    return F.transform(F.array(typed), lambda v: F.when(F.coalesce(F.exists(v, endless), F.lit(False)), None).otherwise(v))[0].alias(side)


def parse_depth(df: DataFrame, missing_prev: int | None = None) -> DataFrame:
    """Depth updates with typed level arrays; an absent previous id becomes ``missing_prev``."""
    cols = {
        "ts_exchange": X.from_epoch_ms(_number("E", "bigint")), "first_update_id": _number("U", "bigint"),
        "final_update_id": _number("u", "bigint"),
        "prev_final_update_id": F.coalesce(_number("pu", "bigint"), F.lit(missing_prev).cast("bigint")),
        "bids": F.col("_levels.b"), "asks": F.col("_levels.a"),
    }
    return _parsed(df, DEPTH, cols, ["ts_exchange", "first_update_id", "final_update_id", "bids", "asks"])


def _may_be(event: str) -> Column:
    """Whether a message's text can name the event: its name stands there, or an escape that may hide it.

    Costs a search of the text, so messages of other events need not be parsed to be left out.
    """
    return F.col("data").contains(event) | F.col("data").contains("\\")


def _checked(df: DataFrame) -> DataFrame:
    complete = _text("e") == DEPTH
    for field in ("E", "s", "b", "a"):
        complete = complete & _text(field).isNotNull()
    sides = (F.size("_sides.b") > 0) | (F.size("_sides.a") > 0)
    parsed = _once(_message(df), "_sides", F.struct(_side("b"), _side("a")))
    return parsed.withColumn("is_valid", F.coalesce(complete & sides, F.lit(False)))


def validate_depth_message(df: DataFrame) -> DataFrame:
    """Add ``is_valid``: all five fields, the right event name and at least one non-empty side."""
    return _checked(df).drop("_m", "_sides")


def depth_to_l1(df: DataFrame, exchange: str) -> DataFrame:
    """The 8-column best-level record of every valid depth message, in epoch microseconds.

    The first level of a side is its best; either side may be absent, not both. A number that is not finite is absent.
    """
    def best(side, i):
        return _finite(F.try_element_at(F.try_element_at(F.col("_sides")[side], F.lit(1)), F.lit(i)).try_cast("double"))

    return (
        _checked(df.filter(_may_be(DEPTH))).filter("is_valid")
        .select(
            F.lit(exchange).alias("exchange"), _text("s").alias("symbol"),
            (_number("E", "bigint") * 1000).alias("timestamp"), F.unix_micros(_ingest(df)).alias("local_timestamp"),
            best("a", 2).alias("ask_amount"), best("a", 1).alias("ask_price"),
            best("b", 1).alias("bid_price"), best("b", 2).alias("bid_amount"))
        .filter("ask_price IS NOT NULL OR bid_price IS NOT NULL")
    )


def landing_rows(parsed_depth: DataFrame) -> DataFrame:
    """Depth updates in the older landing shape: text symbol, epoch seconds, keyed by final id."""
    return parsed_depth.select(
        "symbol", X.epoch_seconds("ts_exchange").alias("timestamp"), F.unix_millis("ts_exchange").alias("event_time"),
        "first_update_id", "final_update_id", "bids", "asks")


def attach_symbol_id(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """Replace the symbol text by its id. Rows of unlisted symbols are not among them: see :func:`unlisted`."""
    dim = symbols.select(F.col("id").alias("symbol_id"), "symbol")
    return rows.join(dim, "symbol").drop("symbol")


def unlisted(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows, with their symbol text, whose symbol is not listed."""
    return rows.join(symbols.select("symbol"), "symbol", "left_anti")


def new_symbols(rows: DataFrame, symbols: DataFrame, exchange: str, quote: str = "USDT") -> DataFrame:
    """Dimension rows for symbols seen in a feed but not listed; ids continue after the largest."""
    seen = rows.select("symbol").distinct().join(symbols.select("symbol"), "symbol", "left_anti")
    top = symbols.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return seen.select(  # a dimension: one row per new symbol
        (top + F.row_number().over(Window.orderBy("symbol"))).alias("id"),
        F.lit(exchange).alias("exchange"), "symbol", F.lit("perp").alias("instrument_type"),
        X.base_asset("symbol", quote).alias("base_asset"), F.lit(quote).alias("quote_asset"),
        F.lit(True).alias("is_active"))
