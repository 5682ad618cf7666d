"""The medallion layers (Bronze, Silver, Gold) as a table, and the landing topic stand-in.

    landing (topic records) -> bronze (by stream_type)
        -> silver_agg_trade   -> gold_volatility
        -> silver_book_ticker -> gold_spread
        -> silver_depth10     -> gold_liquidity

``landing`` holds Kafka-shaped records (key, value, topic, partition,
offset, timestamp, timestampType).  With a broker, Bronze reads the topic
instead (``ticklake.sources.kafka.read_topic``); the decode step is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticklake.operators.envelope import envelope_from_frames
from ticklake.operators.gold import gold_liquidity, gold_spread, gold_volatility
from ticklake.operators.silver import (
    bronze,
    empty_payloads,
    silver_agg_trade,
    silver_book_ticker,
    silver_depth10,
)
from ticklake.schemas import (
    AGG_TRADE,
    BOOK_TICKER,
    BRONZE_SCHEMA,
    DEPTH10,
    GOLD_LIQUIDITY_SCHEMA,
    GOLD_SPREAD_SCHEMA,
    GOLD_VOLATILITY_SCHEMA,
    KAFKA_RECORD_SCHEMA,
    SILVER_AGG_TRADE_SCHEMA,
    SILVER_BOOK_TICKER_SCHEMA,
    SILVER_DEPTH10_SCHEMA,
)
from ticklake.sources.kafka import decode_envelopes, encode_envelopes
from ticklake.streaming.layers import LayerSpec

# Fixed values of the landing stand-in: topic name and partition count.
TOPIC = "market"
TOPIC_PARTITIONS = 3


def bronze_from_records(records: DataFrame) -> DataFrame:
    return bronze(decode_envelopes(records))


def _silver(stream_type: str, name: str, schema: StructType, transform) -> LayerSpec:
    """A Silver layer; its batches report how many Bronze rows of its type came
    in, how many rows it made and how many of these have an empty payload."""

    def counted(bronze_df: DataFrame) -> DataFrame:
        mine = bronze_df.filter(F.col("stream_type") == stream_type)  # below the count, so that it prunes partitions
        if bronze_df.isStreaming:
            mine = mine.observe(f"{name}_source", F.count(F.lit(1)).alias("frames"))
        return transform(mine)

    return LayerSpec(
        name, "bronze", BRONZE_SCHEMA, counted, source_partitioned_by="stream_type", output_schema=schema,
        counts=lambda: {"rows": F.count(F.lit(1)), "empty": empty_payloads(schema.names)},
    )


LAYERS: dict[str, LayerSpec] = {
    spec.name: spec
    for spec in [
        LayerSpec("bronze", "landing", KAFKA_RECORD_SCHEMA, bronze_from_records, "stream_type", output_schema=BRONZE_SCHEMA),
        _silver(AGG_TRADE, "silver_agg_trade", SILVER_AGG_TRADE_SCHEMA, silver_agg_trade),
        _silver(BOOK_TICKER, "silver_book_ticker", SILVER_BOOK_TICKER_SCHEMA, silver_book_ticker),
        _silver(DEPTH10, "silver_depth10", SILVER_DEPTH10_SCHEMA, silver_depth10),
        LayerSpec("gold_volatility", "silver_agg_trade", SILVER_AGG_TRADE_SCHEMA, gold_volatility, output_schema=GOLD_VOLATILITY_SCHEMA),
        LayerSpec("gold_spread", "silver_book_ticker", SILVER_BOOK_TICKER_SCHEMA, gold_spread, output_schema=GOLD_SPREAD_SCHEMA),
        LayerSpec("gold_liquidity", "silver_depth10", SILVER_DEPTH10_SCHEMA, gold_liquidity, output_schema=GOLD_LIQUIDITY_SCHEMA),
    ]
}


def chain(name: str) -> list[LayerSpec]:
    """The layers needed to build ``name``, upstream first."""
    out: list[LayerSpec] = []
    while name in LAYERS:
        out.append(LAYERS[name])
        name = LAYERS[name].source
    return out[::-1]


def landing_records(frames: DataFrame) -> DataFrame:
    """Frames -> topic records as the producer would publish them.

    Lineage is synthetic but deterministic: partition = first byte of the key
    mod 3; offset = the producer's send sequence (``seq`` column of the
    frames); timestamp = the receive time (CreateTime, type 0).
    """
    return records_of(envelope_from_frames(frames, keep=("seq",)))


def records_of(envelopes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelopes with ``seq`` -> topic records, with the ``keep`` columns."""
    enriched = envelopes.select(
        "*",
        (F.ascii("symbol") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
    )
    return encode_envelopes(enriched, keep=("partition", "offset", "ingestion_timestamp", *keep)).select(
        "key",
        "value",
        F.lit(TOPIC).alias("topic"),
        "partition",
        "offset",
        F.col("ingestion_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *keep,
    )
