"""Scalar expressions shared by the layers.

Everything here returns a ``Column`` built from Spark's own functions, so it
stays inside whole-stage codegen and behaves the same under ANSI on/off and
``caseSensitive`` true/false:

* numeric text -> decimal uses ``try_cast`` (a bad price gives NULL instead
  of failing the stream under ANSI);
* array subscripts use ``get`` (out of range gives NULL);
* exchange field names that differ only by case are renamed *by position*
  with a struct cast right after ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticklake.schemas import PRICE_TYPE, RAW_PAYLOADS

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# JSON insignificant whitespace: a text made only of these parses to NULL.
_JSON_WHITESPACE = " \t\r\n"


def parse_payload_text(data_text: Column | str, stream_type: str) -> Column:
    """Parse an extracted ``data`` text with the stream's schema: NULL for
    NULL or blank text, else a struct (possibly with all fields NULL) under
    the typed names of ``ticklake.schemas`` (positional rename), so
    ``e``/``E`` never collide."""
    raw_schema, typed_schema = RAW_PAYLOADS[stream_type]
    return _typed(F.from_json(_col(data_text), raw_schema), typed_schema)


def payload_present(data_text: Column | str) -> Column:
    """True exactly when ``parse_payload_text(data_text)`` is not NULL:
    ``from_json`` gives NULL only for NULL, empty or all-whitespace text.
    Lets a filter decide without parsing the payload."""
    c = _col(data_text)
    return c.isNotNull() & (F.btrim(c, F.lit(_JSON_WHITESPACE)) != F.lit(""))


def _typed(parsed: Column, typed_schema: StructType) -> Column:
    return parsed.cast(typed_schema)


def decimal_from_text(text: Column | str) -> Column:
    """Exchange numeric string -> decimal(20,8); NULL when not a number or
    out of range (never raises)."""
    return _col(text).try_cast(PRICE_TYPE)


def timestamp_from_epoch_ms(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP, exact (no floating point)."""
    return F.timestamp_millis(_col(ms))


def level_price(level: Column | str) -> Column:
    """Price of a ``[price, qty]`` book level."""
    return decimal_from_text(F.get(_col(level), 0))


def level_quantity(level: Column | str) -> Column:
    """Quantity of a ``[price, qty]`` book level; NULL when absent."""
    return decimal_from_text(F.get(_col(level), 1))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_wall_clock(ts: Column | str) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding its UTC wall-clock
    time, independent of the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), _epoch_ntz())


def epoch_micros_of_wall_clock(ntz: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ read as UTC."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _col(ntz))


def instant_from_utc_wall_clock(ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ read as UTC wall-clock time -> TIMESTAMP (instant),
    independent of the session time zone."""
    return F.timestamp_micros(epoch_micros_of_wall_clock(ntz))
