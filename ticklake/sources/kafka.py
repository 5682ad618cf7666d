"""Topic source and sink (Kafka record schema), plus the pure encode/decode
steps between topic records and envelopes.

The connector itself is only needed by ``read_topic`` / ``write_topic``;
``decode_envelopes`` and ``encode_envelopes`` work on any DataFrame with the
Kafka record columns, batch or streaming, so they are testable without a
broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ticklake.schemas import ENVELOPE_SCHEMA

# Envelope JSON timestamps: ISO-8601 UTC with microseconds (fixed format).
ENVELOPE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_topic(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming scan of a topic from the earliest offset (needs the
    spark-sql-kafka connector on the classpath)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def decode_envelopes(records: DataFrame, keep: dict[str, str] | None = None) -> DataFrame:
    """Topic records -> Bronze rows, with the record columns that ``keep``
    names (column -> name in Bronze).

    ``value`` bytes are decoded as UTF-8 JSON into the envelope columns and
    the broker lineage is carried along (``partition``, ``offset``,
    ``timestamp`` as ``kafka_timestamp``); ``key``, ``topic`` and headers are
    dropped.  A value that is not JSON gives NULL envelope columns with its
    lineage kept (Silver's stream-type filter later drops it).
    """
    return records.select(
        F.from_json(F.col("value").cast("string"), ENVELOPE_SCHEMA).alias("envelope"),
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        *[F.col(c).alias(name) for c, name in (keep or {}).items()],
    ).select("envelope.*", "partition", "offset", "kafka_timestamp", *(keep or {}).values())


def encode_envelopes(envelopes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelopes -> ``(key, value, *keep)`` records: key = symbol as UTF-8
    bytes (one symbol stays in one topic partition, keeping its order), value
    = the envelope as JSON with every field present (NULLs written as null)
    and UTC microsecond timestamps."""
    value = F.to_json(
        F.struct(*[F.col(f.name) for f in ENVELOPE_SCHEMA.fields]),
        {
            "ignoreNullFields": "false",
            "timestampFormat": ENVELOPE_TIMESTAMP_FORMAT,
            "timeZone": "UTC",
        },
    )
    return envelopes.select(
        F.col("symbol").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        *keep,
    )


def write_topic(
    records: DataFrame,
    bootstrap_servers: str,
    topic: str,
    checkpoint_path: str,
) -> DataStreamWriter:
    """Streaming topic sink for ``encode_envelopes`` output (needs the
    connector).  Returns the configured writer; the caller starts it."""
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint_path)
    )
