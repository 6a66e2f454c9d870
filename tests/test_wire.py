"""Messages to rows: accepted, rejected and odd ones."""

import datetime
import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tickspark.operators import micro as M
from tickspark.operators import quality as Q
from tickspark.sources import wire as W
from verification.bindings import Market


def feed(spark, *messages):
    rows = [(m if isinstance(m, str) else json.dumps(m),) for m in messages]
    return spark.createDataFrame(rows, "value string").withColumn(
        "ts_ingest", F.timestamp_micros(F.lit(1_700_000_000_123_456)))


def depth(**changes):
    return {"e": "depthUpdate", "E": 1_700_000_000_000, "s": "AAAUSDT", "U": 1, "u": 4, "pu": 0,
            "b": [["10.5", "2"], ["10.4", "3"]], "a": [["10.6", "1.5"]], **changes}


def wrap(kind, data):
    return {"stream": f"aaausdt@{kind}", "data": data}


def bare(spark, *messages):
    return W.read_bare(feed(spark, *messages))


def test_envelope_routes_every_message(spark):
    got = W.read_envelope(feed(spark, wrap("bookTicker", {"s": "A"}), wrap("aggTrade", {}), wrap("depth5@100ms", depth()),
                               {"data": {}}, {"stream": "x@depth"}, "not json", wrap("kline", {}))).collect()
    assert sorted(str(r.kind) for r in got) == ["None"] * 4 + ["aggTrade", "bookTicker", "depthUpdate"]
    assert sorted(r.unrouted_reason for r in got if r.kind is None) == ["no data", "no stream", "not JSON", "unknown stream"]


def test_bare_messages_route_by_event_or_fields(spark):
    got = bare(spark, depth(), {"e": "aggTrade"}, {"p": "1", "q": "2", "m": True}, {"b": "1", "B": "1", "a": "2", "A": "3"},
               {"e": "other"}).collect()
    assert [r.kind for r in got] == ["depthUpdate", "aggTrade", "aggTrade", "bookTicker", None]


def test_book_ticker_fields_differ_only_by_case(spark):
    data = {"E": 1_700_000_000_001, "s": "AAAUSDT", "u": 7, "b": "10.0", "B": "3", "a": "10.5", "A": "4"}
    r = W.accepted(W.parse_book_ticker(W.read_envelope(feed(spark, wrap("bookTicker", data))))).first()
    assert (r.best_bid, r.bid_qty, r.best_ask, r.ask_qty, r.spread, r.mid) == (10.0, 3.0, 10.5, 4.0, 0.5, 10.25)
    assert r.ts_exchange.microsecond == 1000 and r.update_id == 7


def test_bad_messages_are_kept_with_a_reason(spark):
    good = {"E": 1, "s": "A", "u": 7, "b": "1", "B": "1", "a": "2", "A": "1"}
    parsed = W.parse_book_ticker(W.read_envelope(feed(
        spark, wrap("bookTicker", good), wrap("bookTicker", {**good, "b": "x"}), wrap("bookTicker", "broken"),
        wrap("bookTicker", {**good, "u": None}))))
    assert W.accepted(parsed).count() == 2  # the update id may be absent
    reasons = sorted(r.reject_reason for r in W.rejected(parsed).collect())
    assert reasons[0] == "missing or invalid: best_bid" and "symbol" in reasons[1]
    r = Q.rejects_summary(parsed).first()
    assert (r.processed_count, r.error_count, r.error_rate) == (2, 2, 0.5)


def test_trade_time_field(spark):
    data = {"E": 5, "T": 9, "s": "A", "a": 3, "p": "1.5", "q": "2", "m": True}
    env = W.read_envelope(feed(spark, wrap("aggTrade", data)))
    at = lambda f: W.parse_agg_trade(env, f).select(F.unix_millis("ts_exchange")).first()[0]
    assert (at("E"), at("T")) == (5, 9)


def test_depth_levels_and_missing_previous_id(spark):
    env = W.read_envelope(feed(spark, wrap("depth", {k: v for k, v in depth().items() if k != "pu"})))
    r = W.accepted(W.parse_depth(env)).first()
    assert [tuple(x) for x in r.bids] == [(10.5, 2.0), (10.4, 3.0)] and r.prev_final_update_id is None
    assert W.parse_depth(env, missing_prev=0).first().prev_final_update_id == 0


def test_depth_validation(spark):
    no_sides = {k: v for k, v in depth().items() if k not in ("b", "a")}
    got = W.validate_depth_message(bare(spark, depth(), depth(e="trade"), no_sides, depth(b=[], a=[]), depth(b=[])))
    assert [r.is_valid for r in got.collect()] == [True, False, False, False, True]


def test_l1_record(spark):
    rows = W.depth_to_l1(bare(spark, depth(), depth(a=[]), depth(b=[], a=[["bad", "1"]])), "venue").collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.exchange, r.symbol, r.timestamp, r.local_timestamp) == ("venue", "AAAUSDT", 1_700_000_000_000_000, 1_700_000_000_123_456)
    assert (r.bid_price, r.bid_amount, r.ask_price, r.ask_amount) == (10.5, 2.0, 10.6, 1.5)
    assert rows[1].ask_price is None and rows[1].bid_price == 10.5


def test_new_symbols_get_following_ids(spark):
    listed = spark.createDataFrame([(7, "AAAUSDT")], "id long, symbol string")
    seen = spark.createDataFrame([("CCCUSDT",), ("AAAUSDT",), ("BBBUSDT",), ("CCCUSDT",)], "symbol string")
    got = [(r.id, r.symbol, r.base_asset) for r in W.new_symbols(seen, listed, "venue").orderBy("id").collect()]
    assert got == [(8, "BBBUSDT", "BBB"), (9, "CCCUSDT", "CCC")]


def test_flat_book_sorts_drops_deletions_and_breaks_ties_to_the_near_level(spark):
    levels = "array<struct<price:double,qty:double>>"
    df = spark.createDataFrame([
        (1, 1, [(9.0, 4.0), (10.0, 1.0), (8.0, 4.0), (9.5, 0.0)], [(11.0, 2.0), (10.5, 2.0)]),
        (1, 2, [(9.0, 0.0)], [(11.0, 2.0)]), (1, 3, [], [])],
        f"symbol_id long, final_update_id long, bids {levels}, asks {levels}").withColumn(
        "ts_exchange", F.timestamp_seconds("final_update_id"))
    a, b, c = M.flatten_topn(df).orderBy("final_update_id").collect()
    assert (a.b1_price, a.b2_price, a.b3_price, a.b4_price) == (10.0, 9.0, 8.0, None)
    assert (a.a1_price, a.total_bid_qty, a.total_ask_qty) == (10.5, 9.0, 4.0)
    assert a.wall_size_bid == 4.0 and abs(a.wall_dist_bid_bps - abs(9.0 - 10.25) / 10.25 * 1e4) < 1e-9
    assert abs(a.wall_dist_ask_bps - 0.25 / 10.25 * 1e4) < 1e-9
    assert b.b1_price is None and b.microprice is None and b.i1 == 0.0 and b.i5 == 0.0 and b.a1_price == 11.0
    assert c.total_bid_qty == 0.0 and c.wall_size_bid is None


def test_l1_of_escaped_event_names_and_odd_messages(spark):
    escaped = json.dumps(depth()).replace("depthUpdate", "\\u0064epthUpdate")
    rows = W.depth_to_l1(bare(spark, escaped, depth(), depth(e="other", s="depthUpdate"), {"e": "bookTicker"}, "not json"), "venue")
    assert [r.symbol for r in rows.collect()] == ["AAAUSDT"] * 2
    parsers = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" in parsers and parsers.index("Contains") > parsers.index("explode(array(from_json(MapType")  # below the parser


def test_messages_are_dealt_evenly(spark, tmp_path):
    """Events of one row group: their messages are not made and parsed in one task."""
    start, kinds = datetime.datetime(2024, 1, 1), ["view", "error", "purchase", "click"]
    pq.write_table(pa.table({
        "event_id": list(range(4000)), "ts": pa.array([start + datetime.timedelta(seconds=i) for i in range(4000)], pa.timestamp("us")),
        "user_id": list(range(4000)), "event_type": [kinds[i % 4] for i in range(4000)], "value": [i / 8 for i in range(4000)],
        "props": ['{"k": %d}' % (i % 100) for i in range(4000)]}), tmp_path / "events.parquet")
    rows = W.depth_to_l1(W.read_envelope(Market(spark, str(tmp_path)).messages), "spot")
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 750
