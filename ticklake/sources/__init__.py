"""Sources and sinks: topic records (Kafka schema) and layer tables."""

from ticklake.sources.kafka import decode_envelopes, encode_envelopes, read_topic, write_topic
from ticklake.sources.layers import read_layer, read_snapshot, table_available, try_read_snapshot, write_layer

__all__ = [
    "decode_envelopes",
    "encode_envelopes",
    "read_layer",
    "read_snapshot",
    "read_topic",
    "table_available",
    "try_read_snapshot",
    "write_layer",
    "write_topic",
]
