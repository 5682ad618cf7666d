from datetime import datetime
from decimal import Decimal

from pyspark.sql.types import StructType

from ticklake.contracts import assert_contract
from ticklake.operators.gold import gold_liquidity, gold_spread, gold_volatility
from ticklake.operators.serving import to_serving_contract
from ticklake.schemas import (
    GOLD_LIQUIDITY_SCHEMA,
    GOLD_SPREAD_SCHEMA,
    GOLD_VOLATILITY_SCHEMA,
    SILVER_AGG_TRADE_SCHEMA,
    SERVING_VOLATILITY_SCHEMA,
)

# The Silver contract without the columns that Gold never reads.
TRADES_SCHEMA = StructType([f for f in SILVER_AGG_TRADE_SCHEMA.fields if f.name not in ("ingestion_timestamp", "event_timestamp")])


def trades(spark, rows):
    def one(symbol, ts, price, quantity):
        given = {"symbol": symbol, "trade_timestamp": ts, "price": price and Decimal(price), "quantity": Decimal(quantity)}
        return tuple(given.get(f.name) for f in TRADES_SCHEMA.fields)

    return spark.createDataFrame([one(*r) for r in rows], TRADES_SCHEMA)


def test_gold_volatility_accepts_batch_subset_and_keeps_contract(spark):
    df = trades(spark, [("XYZ", datetime(2025, 3, 9, 23, 59), "7.25", "0.5")])
    out = gold_volatility(df)
    assert_contract(out, GOLD_VOLATILITY_SCHEMA)
    assert_contract(to_serving_contract(out, "gold_volatility"), SERVING_VOLATILITY_SCHEMA)


def test_volatility_values_and_window_bounds(spark):
    df = trades(
        spark,
        [
            ("A", datetime(2026, 1, 1, 10, 0, 0), "10", "1"),
            ("A", datetime(2026, 1, 1, 10, 4, 59, 999000), "12", "2"),
            ("A", datetime(2026, 1, 1, 10, 5, 0), "20", "5"),  # next window: [start, end)
            ("B", datetime(2026, 1, 1, 10, 1, 0), "7", "1"),
        ],
    )
    rows = {(r.symbol, r.window_start.minute): r for r in gold_volatility(df).collect()}
    a0 = rows[("A", 0)]
    assert a0.window_end == datetime(2026, 1, 1, 10, 5)
    assert a0.avg_price == Decimal("11") and a0.total_volume == Decimal("3") and a0.trade_count == 2
    assert abs(a0.stddev_price - 1.4142135623730951) < 1e-12
    assert rows[("A", 5)].trade_count == 1 and rows[("A", 5)].stddev_price is None
    assert rows[("B", 0)].stddev_price is None


def test_null_price_ignored_and_null_symbol_counts_zero(spark):
    df = trades(spark, [("A", datetime(2026, 1, 1, 10, 0), None, "1"), ("A", datetime(2026, 1, 1, 10, 1), "4", "1"),
                        (None, datetime(2026, 1, 1, 10, 1), "4", "1")])
    rows = {r.symbol: r for r in gold_volatility(df).collect()}
    assert rows["A"].avg_price == Decimal("4") and rows["A"].trade_count == 2
    assert rows[None].trade_count == 0


def test_null_event_time_dropped(spark):
    df = trades(spark, [("A", None, "1", "1")])
    assert gold_volatility(df).count() == 0


def test_spread_allows_crossed_book(spark):
    df = spark.createDataFrame(
        [
            (datetime(2026, 1, 1, 10, 0), "A", Decimal("10"), Decimal("1"), Decimal("11"), Decimal("1")),
            (datetime(2026, 1, 1, 10, 1), "A", Decimal("10"), Decimal("1"), Decimal("9"), Decimal("1")),
        ],
        "ingestion_timestamp timestamp, symbol string, best_bid_price decimal(20,8), best_bid_quantity decimal(20,8), "
        "best_ask_price decimal(20,8), best_ask_quantity decimal(20,8)",
    )
    out = gold_spread(df)
    assert_contract(out, GOLD_SPREAD_SCHEMA)
    r = out.collect()[0]
    assert (r.min_spread, r.max_spread, r.avg_spread) == (Decimal("-1"), Decimal("1"), Decimal("0"))
    assert r.avg_mid_price == Decimal("10")


def test_liquidity_averages_all_levels_per_side(spark):
    df = spark.createDataFrame(
        [
            ("A", datetime(2026, 1, 1, 10, 0), 1, "bid", 0, Decimal("1"), Decimal("2")),
            ("A", datetime(2026, 1, 1, 10, 0), 1, "bid", 1, Decimal("1"), Decimal("4")),
            ("A", datetime(2026, 1, 1, 10, 2), 2, "bid", 0, Decimal("1"), Decimal("6")),
            ("A", datetime(2026, 1, 1, 10, 2), 2, "ask", 0, Decimal("1"), Decimal("1")),
        ],
        "symbol string, ingestion_timestamp timestamp, last_update_id long, side string, level int, "
        "price decimal(20,8), quantity decimal(20,8)",
    )
    out = gold_liquidity(df)
    assert_contract(out, GOLD_LIQUIDITY_SCHEMA)
    got = {r.side: r.avg_depth_quantity for r in out.collect()}
    assert got == {"bid": Decimal("4"), "ask": Decimal("1")}


def test_ntz_event_time_is_read_as_utc(spark):
    df = trades(spark, [("A", datetime(2026, 1, 1, 10, 1), "10", "1"), ("A", datetime(2026, 1, 1, 10, 2), "12", "1")])
    ntz = df.withColumn("trade_timestamp", df["trade_timestamp"].cast("timestamp_ntz"))
    a = sorted(tuple(r) for r in gold_volatility(df).collect())
    b = sorted(tuple(r) for r in gold_volatility(ntz).collect())
    assert a == b and len(a) == 1


def test_ntz_event_time_in_a_stream(spark, scratch):
    from ticklake.sources.layers import read_snapshot

    root = scratch("ntz")
    df = trades(spark, [("A", datetime(2026, 1, 1, 10, 1), "10", "1"), ("A", datetime(2026, 1, 1, 10, 30), "12", "1")])
    df.withColumn("trade_timestamp", df["trade_timestamp"].cast("timestamp_ntz")).write.parquet(root + "/in")
    stream = spark.readStream.schema(spark.read.parquet(root + "/in").schema).parquet(root + "/in")
    q = gold_volatility(stream).writeStream.format("parquet").option("checkpointLocation", root + "/cp").trigger(
        availableNow=True
    ).start(root + "/out")
    q.awaitTermination()
    rows = read_snapshot(spark, root + "/out").collect()
    assert [(r.window_start, r.trade_count) for r in rows] == [(datetime(2026, 1, 1, 10, 0), 1)]


def test_serving_contract_order_and_types_for_every_table(spark):
    from ticklake.schemas import GOLD_LIQUIDITY_SCHEMA, GOLD_SPREAD_SCHEMA, SERVING_LIQUIDITY_SCHEMA, SERVING_SPREAD_SCHEMA

    t0, t1 = datetime(2026, 1, 1, 10, 0), datetime(2026, 1, 1, 10, 5)
    spread = spark.createDataFrame(
        [(t0, t1, "A", Decimal("0.5"), Decimal("0.1"), Decimal("1"), Decimal("10.123456789"))], GOLD_SPREAD_SCHEMA
    )
    liq = spark.createDataFrame([(t0, t1, "A", "bid", Decimal("2.5"))], GOLD_LIQUIDITY_SCHEMA)
    # shuffled column order on input: the contract fixes order and types
    s = assert_contract(to_serving_contract(spread.select(*reversed(spread.columns)), "gold_spread"), SERVING_SPREAD_SCHEMA)
    l_ = assert_contract(to_serving_contract(liq.select(*reversed(liq.columns)), "gold_liquidity"), SERVING_LIQUIDITY_SCHEMA)
    assert s.first().avg_mid_price == Decimal("10.12345679")  # HALF_UP at the 8th digit
    assert l_.first().avg_depth_quantity == Decimal("2.5")
