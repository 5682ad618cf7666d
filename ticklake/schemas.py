"""Fixed schemas of the data contract.

The raw payload schemas describe the exchange messages as they arrive; the
field names (including names that differ only by case, such as ``e``/``E``)
are the exchange's and must not change.  Each raw schema has a *typed
rename* with the same field order: casting a parsed struct to it renames
fields by position, so nothing downstream depends on
``spark.sql.caseSensitive``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values (must equal the exchange protocol / serving contract).
# Stream types, in protocol order: aggTrade, bookTicker, depth10.
# Numeric type of every price and quantity: decimal(20,8).
# Gold window: 5 minutes tumbling; watermark delay: 10 minutes.
# ---------------------------------------------------------------------------
AGG_TRADE = "aggTrade"
BOOK_TICKER = "bookTicker"
DEPTH10 = "depth10"
STREAM_TYPES: tuple[str, ...] = (AGG_TRADE, BOOK_TICKER, DEPTH10)

PRICE_TYPE = DecimalType(20, 8)
WINDOW_DURATION = "5 minutes"
WATERMARK_DELAY = "10 minutes"

BID = "bid"
ASK = "ask"


def _fields(*spec: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in spec])


# --- Envelope ---------------------------------------------------------------
ENVELOPE_SCHEMA = _fields(
    ("ingestion_timestamp", TimestampType()),
    ("symbol", StringType()),
    ("stream_type", StringType()),
    ("raw_payload", StringType()),
)

# Columns a Kafka source yields (and a Kafka-shaped landing table holds).
KAFKA_RECORD_SCHEMA = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
        StructField("timestampType", IntegerType(), True),
    ]
)

BRONZE_SCHEMA = StructType(
    ENVELOPE_SCHEMA.fields
    + [
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("kafka_timestamp", TimestampType(), True),
    ]
)

# --- Raw exchange payloads (field names fixed by the exchange) -------------
AGG_TRADE_RAW = _fields(
    ("e", StringType()),
    ("E", LongType()),
    ("s", StringType()),
    ("a", LongType()),
    ("p", StringType()),
    ("q", StringType()),
    ("f", LongType()),
    ("l", LongType()),
    ("T", LongType()),
    ("m", BooleanType()),
    ("M", BooleanType()),
)
AGG_TRADE_TYPED = _fields(
    ("event_type", StringType()),
    ("event_ms", LongType()),
    ("exchange_symbol", StringType()),
    ("agg_trade_id", LongType()),
    ("price_text", StringType()),
    ("quantity_text", StringType()),
    ("first_trade_id", LongType()),
    ("last_trade_id", LongType()),
    ("trade_ms", LongType()),
    ("is_buyer_maker", BooleanType()),
    ("is_best_match", BooleanType()),
)

BOOK_TICKER_RAW = _fields(
    ("u", LongType()),
    ("s", StringType()),
    ("b", StringType()),
    ("B", StringType()),
    ("a", StringType()),
    ("A", StringType()),
)
BOOK_TICKER_TYPED = _fields(
    ("update_id", LongType()),
    ("exchange_symbol", StringType()),
    ("bid_text", StringType()),
    ("bid_qty_text", StringType()),
    ("ask_text", StringType()),
    ("ask_qty_text", StringType()),
)

BOOK_LEVEL = ArrayType(StringType())
DEPTH10_RAW = _fields(
    ("lastUpdateId", LongType()),
    ("bids", ArrayType(BOOK_LEVEL)),
    ("asks", ArrayType(BOOK_LEVEL)),
)
DEPTH10_TYPED = _fields(
    ("last_update_id", LongType()),
    ("bids", ArrayType(BOOK_LEVEL)),
    ("asks", ArrayType(BOOK_LEVEL)),
)

RAW_PAYLOADS = {
    AGG_TRADE: (AGG_TRADE_RAW, AGG_TRADE_TYPED),
    BOOK_TICKER: (BOOK_TICKER_RAW, BOOK_TICKER_TYPED),
    DEPTH10: (DEPTH10_RAW, DEPTH10_TYPED),
}

# --- Silver -----------------------------------------------------------------
SILVER_AGG_TRADE_SCHEMA = _fields(
    ("symbol", StringType()),
    ("ingestion_timestamp", TimestampType()),
    ("event_type", StringType()),
    ("event_timestamp", TimestampType()),
    ("agg_trade_id", LongType()),
    ("price", PRICE_TYPE),
    ("quantity", PRICE_TYPE),
    ("first_trade_id", LongType()),
    ("last_trade_id", LongType()),
    ("trade_timestamp", TimestampType()),
    ("is_buyer_maker", BooleanType()),
    ("is_best_match", BooleanType()),
)
SILVER_BOOK_TICKER_SCHEMA = _fields(
    ("symbol", StringType()),
    ("ingestion_timestamp", TimestampType()),
    ("update_id", LongType()),
    ("best_bid_price", PRICE_TYPE),
    ("best_bid_quantity", PRICE_TYPE),
    ("best_ask_price", PRICE_TYPE),
    ("best_ask_quantity", PRICE_TYPE),
)
SILVER_DEPTH10_SCHEMA = _fields(
    ("symbol", StringType()),
    ("ingestion_timestamp", TimestampType()),
    ("last_update_id", LongType()),
    ("side", StringType()),
    ("level", IntegerType()),
    ("price", PRICE_TYPE),
    ("quantity", PRICE_TYPE),
)

# --- Gold (exact types, wider than the serving contract) -------------------
GOLD_VOLATILITY_SCHEMA = _fields(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("symbol", StringType()),
    ("avg_price", DecimalType(24, 12)),
    ("stddev_price", DoubleType()),
    ("total_volume", DecimalType(30, 8)),
    ("trade_count", LongType()),
)
GOLD_SPREAD_SCHEMA = _fields(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("symbol", StringType()),
    ("avg_spread", DecimalType(25, 12)),
    ("min_spread", DecimalType(21, 8)),
    ("max_spread", DecimalType(21, 8)),
    ("avg_mid_price", DecimalType(27, 14)),
)
GOLD_LIQUIDITY_SCHEMA = _fields(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("symbol", StringType()),
    ("side", StringType()),
    ("avg_depth_quantity", DecimalType(24, 12)),
)

# --- Serving contract (column order is part of it) --------------------------
SERVING_VOLATILITY_SCHEMA = _fields(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("symbol", StringType()),
    ("avg_price", PRICE_TYPE),
    ("stddev_price", PRICE_TYPE),
    ("total_volume", PRICE_TYPE),
    ("trade_count", LongType()),
)
SERVING_SPREAD_SCHEMA = _fields(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("symbol", StringType()),
    ("avg_spread", PRICE_TYPE),
    ("min_spread", PRICE_TYPE),
    ("max_spread", PRICE_TYPE),
    ("avg_mid_price", PRICE_TYPE),
)
SERVING_LIQUIDITY_SCHEMA = _fields(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("symbol", StringType()),
    ("side", StringType()),
    ("avg_depth_quantity", PRICE_TYPE),
)

# Serving table -> (contract schema, primary key).
SERVING_TABLES = {
    "gold_volatility": (SERVING_VOLATILITY_SCHEMA, ("symbol", "window_start")),
    "gold_spread": (SERVING_SPREAD_SCHEMA, ("symbol", "window_start")),
    "gold_liquidity": (SERVING_LIQUIDITY_SCHEMA, ("symbol", "side", "window_start")),
}
