"""Column-expression helpers (all built-in Spark expressions, codegen-friendly)."""

from ticklake.functions.parsing import (
    decimal_from_text,
    epoch_micros_of_wall_clock,
    instant_from_utc_wall_clock,
    level_price,
    level_quantity,
    parse_payload_text,
    payload_present,
    timestamp_from_epoch_ms,
    utc_wall_clock,
)

__all__ = [
    "decimal_from_text",
    "epoch_micros_of_wall_clock",
    "instant_from_utc_wall_clock",
    "level_price",
    "level_quantity",
    "parse_payload_text",
    "payload_present",
    "timestamp_from_epoch_ms",
    "utc_wall_clock",
]
