import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest

from ticklake.contracts import assert_contract
from ticklake.operators.silver import silver_agg_trade, silver_book_ticker, silver_depth10
from ticklake.schemas import (
    SILVER_AGG_TRADE_SCHEMA,
    SILVER_BOOK_TICKER_SCHEMA,
    SILVER_DEPTH10_SCHEMA,
)

T0 = datetime(2026, 1, 1, 10, 0, 0)
TRADE = {
    "stream": "aaausdt@aggTrade",
    "data": {"e": "aggTrade", "E": 1767261600123, "s": "AAAUSDT", "a": 7, "p": "10.50000000",
             "q": "2.00000000", "f": 11, "l": 12, "T": 1767261600120, "m": True, "M": True},
}
TICKER = {
    "stream": "aaausdt@bookTicker",
    "data": {"u": 42, "s": "AAAUSDT", "b": "10.40000000", "B": "3.00000000", "a": "10.60000000", "A": "4.00000000"},
}
DEPTH = {
    "stream": "aaausdt@depth10",
    "data": {"lastUpdateId": 99, "bids": [["10.4", "3"], ["10.3", "5"]], "asks": [["10.6", "4"]]},
}


def bronze(spark, stream_type, payloads):
    rows = [(T0, "AAAUSDT", stream_type, p if p is None or isinstance(p, str) else json.dumps(p)) for p in payloads]
    return spark.createDataFrame(
        rows, "ingestion_timestamp timestamp, symbol string, stream_type string, raw_payload string"
    )


def test_agg_trade_typed_row(spark):
    row = silver_agg_trade(bronze(spark, "aggTrade", [TRADE])).collect()[0]
    assert row.event_type == "aggTrade"
    assert row.agg_trade_id == 7 and row.first_trade_id == 11 and row.last_trade_id == 12
    assert row.price == Decimal("10.50000000") and row.quantity == Decimal("2.00000000")
    assert row.is_buyer_maker is True and row.is_best_match is True
    ms = int(row.trade_timestamp.replace(tzinfo=timezone.utc).timestamp() * 1000)
    assert ms == 1767261600120
    assert row.event_timestamp.microsecond == 123000


def test_schemas_match_contract(spark):
    assert_contract(silver_agg_trade(bronze(spark, "aggTrade", [TRADE])), SILVER_AGG_TRADE_SCHEMA)
    assert_contract(silver_book_ticker(bronze(spark, "bookTicker", [TICKER])), SILVER_BOOK_TICKER_SCHEMA)
    assert_contract(silver_depth10(bronze(spark, "depth10", [DEPTH])), SILVER_DEPTH10_SCHEMA)


def test_only_own_stream_type(spark):
    df = bronze(spark, "bookTicker", [TRADE])
    assert silver_agg_trade(df).count() == 0


@pytest.mark.parametrize("raw", [None, "not-json", '{"stream":"x","data":{"e":"a"', '{"stream":"x"}',
                                 '{"data":null}', '{"data":""}', '{"data":"  "}'])
def test_unparseable_payload_dropped(spark, raw):
    assert silver_agg_trade(bronze(spark, "aggTrade", [raw])).count() == 0


@pytest.mark.parametrize("raw", ['{"data":"abc"}', '{"data":{}}', '{"data":[1,2]}'])
def test_non_object_data_kept_with_null_fields(spark, raw):
    rows = silver_agg_trade(bronze(spark, "aggTrade", [raw])).collect()
    assert len(rows) == 1
    assert rows[0].price is None and rows[0].agg_trade_id is None and rows[0].trade_timestamp is None


def test_wrong_typed_field_nulls_only_that_field(spark):
    bad = json.loads(json.dumps(TRADE))
    bad["data"]["E"] = "oops"
    row = silver_agg_trade(bronze(spark, "aggTrade", [bad])).collect()[0]
    assert row.event_timestamp is None
    assert row.price == Decimal("10.50000000")


@pytest.mark.parametrize("text", ["abc", "1234567890123.5"])
def test_bad_decimal_is_null_not_error(spark, text):
    bad = json.loads(json.dumps(TRADE))
    bad["data"]["p"] = text
    row = silver_agg_trade(bronze(spark, "aggTrade", [bad])).collect()[0]
    assert row.price is None


def test_decimal_rounds_half_up_at_ninth_digit(spark):
    t = json.loads(json.dumps(TRADE))
    t["data"]["p"] = "1.000000005"
    row = silver_agg_trade(bronze(spark, "aggTrade", [t])).collect()[0]
    assert row.price == Decimal("1.00000001")


@pytest.mark.parametrize("case_sensitive", ["true", "false"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_case_clashing_fields_under_any_session(spark, case_sensitive, ansi):
    old = (spark.conf.get("spark.sql.caseSensitive"), spark.conf.get("spark.sql.ansi.enabled"))
    spark.conf.set("spark.sql.caseSensitive", case_sensitive)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = silver_agg_trade(bronze(spark, "aggTrade", [TRADE])).collect()[0]
        assert row.event_type == "aggTrade" and row.event_timestamp is not None
        assert row.is_buyer_maker is True and row.is_best_match is True
        q = silver_book_ticker(bronze(spark, "bookTicker", [TICKER])).collect()[0]
        assert (q.best_bid_price, q.best_bid_quantity) == (Decimal("10.4"), Decimal("3"))
        assert (q.best_ask_price, q.best_ask_quantity) == (Decimal("10.6"), Decimal("4"))
        lv = silver_depth10(bronze(spark, "depth10", [{"data": {"lastUpdateId": 1, "bids": [["3"]], "asks": []}}])).collect()
        assert lv[0].price == Decimal("3") and lv[0].quantity is None
    finally:
        spark.conf.set("spark.sql.caseSensitive", old[0])
        spark.conf.set("spark.sql.ansi.enabled", old[1])


def test_depth_levels_single_scan(spark):
    rows = silver_depth10(bronze(spark, "depth10", [DEPTH])).orderBy("side", "level").collect()
    got = [(r.side, r.level, r.price, r.quantity, r.last_update_id) for r in rows]
    assert got == [
        ("ask", 0, Decimal("10.6"), Decimal("4"), 99),
        ("bid", 0, Decimal("10.4"), Decimal("3"), 99),
        ("bid", 1, Decimal("10.3"), Decimal("5"), 99),
    ]


@pytest.mark.parametrize("bids", [None, []])
def test_empty_or_null_side_gives_no_rows(spark, bids):
    d = {"data": {"lastUpdateId": 5, "bids": bids, "asks": [["1", "2"]]}}
    rows = silver_depth10(bronze(spark, "depth10", [d])).collect()
    assert [(r.side, r.level) for r in rows] == [("ask", 0)]


def test_level_short_array_gives_null_quantity(spark):
    d = {"data": {"lastUpdateId": 5, "bids": [["3"]], "asks": []}}
    row = silver_depth10(bronze(spark, "depth10", [d])).collect()[0]
    assert row.price == Decimal("3.00000000") and row.quantity is None


def test_parsing_whole_frame_without_data_gives_null_fields(spark):
    from pyspark.sql import functions as F

    from ticklake.schemas import AGG_TRADE_RAW

    df = spark.createDataFrame([(json.dumps(TRADE),)], "raw string")
    row = df.select(F.from_json("raw", AGG_TRADE_RAW).alias("p")).select("p.*").collect()[0]
    assert row[0] is None and row[4] is None


@pytest.mark.parametrize(
    "transform,stream_type,frame",
    [(silver_agg_trade, "aggTrade", TRADE), (silver_book_ticker, "bookTicker", TICKER), (silver_depth10, "depth10", DEPTH)],
)
def test_silver_plan_parses_each_frame_once(spark, transform, stream_type, frame):
    plan = transform(bronze(spark, stream_type, [frame]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.count("get_json_object") == 1


def test_quarantine_invalid_strict_split(spark):
    from ticklake.operators.silver import REQUIRED_FIELDS, quarantine_invalid, valid_rows

    df = silver_agg_trade(bronze(spark, "aggTrade", [TRADE, '{"data":{}}', '{"data":{"p":"x","T":5,"q":"1"}}']))
    req = REQUIRED_FIELDS["silver_agg_trade"]
    bad = sorted(tuple(r.missing_fields) for r in quarantine_invalid(df, req).collect())
    assert bad == [("price",), ("trade_timestamp", "price", "quantity")]
    assert valid_rows(df, req).count() == 1
    assert quarantine_invalid(df, req).count() + valid_rows(df, req).count() == df.count()


def test_of_repeated_data_members_the_first_counts(spark):
    frame = '{"stream":"a@aggTrade","data":{"p":"1","T":5},"data":{"p":"2","T":6}}'
    assert [str(r.price) for r in silver_agg_trade(bronze(spark, "aggTrade", [frame])).collect()] == ["1.00000000"]
