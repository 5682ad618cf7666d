import json
from datetime import datetime

import pytest

from ticklake.operators.envelope import (
    envelope_from_frames,
    parse_symbols,
    quarantine_frames,
    split_frames,
    stream_names,
    subscription_filter,
)

TRADE = json.dumps({"stream": "aaausdt@aggTrade", "data": {"e": "aggTrade", "E": 1, "s": "AAAUSDT"}})
TICKER = json.dumps({"stream": "bbbusdt@bookTicker", "data": {"u": 1}})
DEPTH = json.dumps({"stream": "aaausdt@depth10", "data": {"lastUpdateId": 1, "bids": [], "asks": []}})
T0 = datetime(2026, 1, 1, 10, 0, 0)


def frames(spark, rows):
    return spark.createDataFrame([(f, T0) for f in rows], "frame string, received_at timestamp")


def test_parse_symbols_csv_list_and_spaces():
    assert parse_symbols("BTCUSDT,ETHUSDT") == ["BTCUSDT", "ETHUSDT"]
    assert parse_symbols("BTCUSDT, ETHUSDT ,SOLUSDT") == ["BTCUSDT", "ETHUSDT", "SOLUSDT"]
    assert parse_symbols(["BTCUSDT", "ethusdt"]) == ["BTCUSDT", "ethusdt"]


def test_stream_names_lower_symbol_at_type():
    assert stream_names("BTCUSDT,ETHUSDT", ["aggTrade"]) == ["btcusdt@aggTrade", "ethusdt@aggTrade"]
    assert len(stream_names(["A"])) == 3


def test_envelope_keeps_frame_verbatim_and_derives_symbol(spark):
    out = envelope_from_frames(frames(spark, [TRADE, TICKER, DEPTH])).orderBy("raw_payload").collect()
    by_type = {r.stream_type: r for r in out}
    assert set(by_type) == {"aggTrade", "bookTicker", "depth10"}
    assert by_type["aggTrade"].symbol == "AAAUSDT"
    assert by_type["bookTicker"].symbol == "BBBUSDT"
    assert by_type["aggTrade"].raw_payload == TRADE
    assert by_type["aggTrade"].ingestion_timestamp == T0


def test_envelope_without_received_column_uses_current_time(spark):
    df = spark.createDataFrame([(TRADE,)], "frame string")
    row = envelope_from_frames(df).collect()[0]
    assert row.ingestion_timestamp is not None


def test_quarantine_reasons(spark):
    bad = [
        None,
        "not-json",
        '{"stream":"aaausdt@aggTrade","data":{',
        '{"data":{}}',
        "[1,2]",
        '"scalar"',
        '{"stream":"aaausdt"}',
        '{"stream":"a@b@aggTrade"}',
        '{"stream":"aaausdt@trade"}',
    ]
    rows = quarantine_frames(frames(spark, bad + [TRADE])).collect()
    reasons = {r.frame: r.reason for r in rows}
    assert len(rows) == len(bad)
    assert reasons[None] == "null_frame"
    for f in ["not-json", '{"stream":"aaausdt@aggTrade","data":{', "[1,2]", '"scalar"']:
        assert reasons[f] == "invalid_json", f
    assert reasons['{"data":{}}'] == "missing_stream"
    assert reasons['{"stream":"aaausdt"}'] == "bad_stream_name"
    assert reasons['{"stream":"a@b@aggTrade"}'] == "bad_stream_name"
    assert reasons['{"stream":"aaausdt@trade"}'] == "unknown_stream_type"


def test_frames_that_are_not_exactly_one_json_object_are_rejected(spark):
    good = '{"stream":"a@aggTrade","data":{"p":"1"}}'
    bad = [good + " trailing", good + good, good + "," + good, good.replace('"', "'"), good[:-1], f"[{good}]", "5", "", " ", '{"stream":"a@aggTrade",}']
    rows = quarantine_frames(frames(spark, [*bad, good, f"  {good}\n"])).collect()
    assert {r.frame: r.reason for r in rows} == {f: "invalid_json" for f in bad}


def test_fixed_stream_type_takes_any_stream_name(spark):
    named = ['{"stream":"btcusdt@depth10@100ms","data":{}}', '{"stream":"btcusdt","data":{}}', '{"data":{}}']
    good, bad = split_frames(frames(spark, named), stream_type="depth10")
    assert [(r.symbol, r.stream_type) for r in good.collect()] == [("BTCUSDT", "depth10")] * 2
    assert [r.reason for r in bad.collect()] == ["missing_stream"]
    with pytest.raises(ValueError):
        envelope_from_frames(frames(spark, named), stream_type="kline")


def test_split_is_a_partition_of_the_input(spark):
    df = frames(spark, [TRADE, "junk", TICKER, '{"stream":"x@y"}'])
    good, bad = split_frames(df)
    assert good.count() + bad.count() == df.count()
    assert good.count() == 2


def test_subscription_filter_list_and_dataframe(spark):
    df = frames(spark, [TRADE, TICKER, DEPTH])
    got = {r.frame for r in subscription_filter(df, "AAAUSDT", ["aggTrade", "depth10"]).collect()}
    assert got == {TRADE, DEPTH}
    symbols = spark.createDataFrame([(" bbbusdt ",)], "symbol string")
    got = {r.frame for r in subscription_filter(df, symbols).collect()}
    assert got == {TICKER}
    assert subscription_filter(df, symbols).columns == df.columns
