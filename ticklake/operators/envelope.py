"""Envelope layer: raw exchange frames -> validated envelopes.

A frame is one JSON text ``{"stream": "<symbol lower>@<type>", "data": {...}}``.
The envelope keeps the frame verbatim as ``raw_payload`` and adds the
symbol, the stream type and the time it was received.  Malformed frames are
split off into a quarantine with a reason instead of failing the job.

All functions take and return DataFrames (batch or streaming) and run as
narrow, per-row expressions, without shuffle or action; only a subscription
given as a DataFrame is counted and joined (see ``subscription_filter``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.schemas import STREAM_TYPES

# Stream names (short texts) that a subscription may broadcast.
BROADCAST_STREAMS = 100_000

# Quarantine reasons, checked in this order.
NULL_FRAME = "null_frame"
INVALID_JSON = "invalid_json"
MISSING_STREAM = "missing_stream"
BAD_STREAM_NAME = "bad_stream_name"
UNKNOWN_STREAM_TYPE = "unknown_stream_type"


def parse_symbols(value: str | Iterable[str]) -> list[str]:
    """Symbol list given as ``"BTCUSDT, ETHUSDT"`` or as a list.

    Items are trimmed; case is kept.  A string is split on commas, a list is
    taken as is (the configuration contract)."""
    if isinstance(value, str):
        return [item.strip() for item in value.split(",")]
    return list(value)


def stream_names(symbols: str | Iterable[str], stream_types: Sequence[str] = STREAM_TYPES) -> list[str]:
    """Subscription set: ``<lower symbol>@<type>`` for each symbol x type."""
    return [f"{s.lower()}@{t}" for t in stream_types for s in parse_symbols(symbols)]


def _received(frames: DataFrame, received_col: str | None) -> Column:
    if received_col and received_col in frames.columns:
        return F.col(received_col).cast("timestamp")
    return F.current_timestamp()


def _reason(frame: Column, valid: Column, stream: Column, fixed_type: bool) -> Column:
    parts = F.split(stream, "@")
    reason = (
        F.when(frame.isNull(), F.lit(NULL_FRAME))
        .when(~valid, F.lit(INVALID_JSON))
        .when(stream.isNull(), F.lit(MISSING_STREAM))
    )
    if fixed_type:
        return reason
    return reason.when(F.size(parts) != 2, F.lit(BAD_STREAM_NAME)).when(
        ~F.get(parts, 1).isin(*STREAM_TYPES), F.lit(UNKNOWN_STREAM_TYPE)
    )


def _with_checks(frames: DataFrame, frame_col: str, stream_type: str | None) -> DataFrame:
    """Add ``_stream_parts`` and ``_reason``.

    A frame is valid when it is exactly one JSON object.  ``from_json`` with a
    corrupt-record column rejects single quotes, truncation and anything that
    is no object; counting the elements of ``[<frame>]`` rejects text after
    the object and two objects in one frame.  (Unlike some JSON parsers both
    reject a bare ``NaN``.)  One generator emits both results, so each parse
    runs once per frame whatever the checks below refer to."""
    if stream_type is not None and stream_type not in STREAM_TYPES:
        raise ValueError(f"unknown stream type: {stream_type}")
    frame = F.col(frame_col)
    parsed = F.from_json(
        frame, "stream string, _corrupt string", {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt"}
    )
    objects = F.json_array_length(F.concat(F.lit("["), frame, F.lit("]")))
    checked = frames.select("*", F.inline(F.array(F.struct(parsed.alias("_parsed"), objects.alias("_objects")))))
    valid = F.coalesce(
        F.col("_parsed").isNotNull() & F.col("_parsed._corrupt").isNull() & (F.col("_objects") == 1), F.lit(False)
    )
    stream = F.col("_parsed.stream")
    return checked.withColumn("_stream_parts", F.split(stream, "@")).withColumn(
        "_reason", _reason(frame, valid, stream, stream_type is not None)
    )


def envelope_from_frames(
    frames: DataFrame,
    frame_col: str = "frame",
    received_col: str | None = "received_at",
    keep: tuple[str, ...] = (),
    stream_type: str | None = None,
) -> DataFrame:
    """Valid frames -> ``(ingestion_timestamp, symbol, stream_type, raw_payload)``.

    * symbol: text before the ``@`` of ``$.stream``, upper-cased;
    * stream_type: text after it, one of ``aggTrade``, ``bookTicker``,
      ``depth10``;
    * ingestion_timestamp: the ``received_col`` column when present, else the
      micro-batch's ``current_timestamp()``;
    * raw_payload: the frame, verbatim.

    Frames that fail a check are dropped here; ``quarantine_frames`` returns
    exactly those.  ``keep`` names input columns to carry along (lineage).
    ``stream_type`` is that of a subscription to one type: every frame gets it
    whatever follows the ``@`` (for example ``btcusdt@depth10@100ms``).
    """
    checked = _with_checks(frames, frame_col, stream_type)
    parts = F.col("_stream_parts")
    return checked.filter(F.col("_reason").isNull()).select(
        _received(frames, received_col).alias("ingestion_timestamp"),
        F.upper(F.get(parts, 0)).alias("symbol"),
        (F.get(parts, 1) if stream_type is None else F.lit(stream_type)).alias("stream_type"),
        F.col(frame_col).alias("raw_payload"),
        *keep,
    )


def quarantine_frames(
    frames: DataFrame,
    frame_col: str = "frame",
    received_col: str | None = "received_at",
    stream_type: str | None = None,
) -> DataFrame:
    """Frames rejected by ``envelope_from_frames``, with the reason:
    ``null_frame``, ``invalid_json`` (not exactly one JSON object),
    ``missing_stream``, ``bad_stream_name`` (not ``<symbol>@<type>``) or
    ``unknown_stream_type`` (the last two not with a fixed ``stream_type``)."""
    checked = _with_checks(frames, frame_col, stream_type)
    return checked.filter(F.col("_reason").isNotNull()).select(
        _received(frames, received_col).alias("received_at"),
        F.col(frame_col).alias("frame"),
        F.col("_reason").alias("reason"),
    )


def checked_frames(
    frames: DataFrame,
    frame_col: str = "frame",
    received_col: str | None = "received_at",
    keep: tuple[str, ...] = (),
    stream_type: str | None = None,
) -> DataFrame:
    """Every frame once, as its envelope and the ``reason`` for rejecting it
    (NULL when it is valid; the other columns of a rejected frame may be NULL
    but for ``ingestion_timestamp`` and ``raw_payload``)."""
    checked = _with_checks(frames, frame_col, stream_type)
    parts = F.col("_stream_parts")
    return checked.select(
        _received(frames, received_col).alias("ingestion_timestamp"),
        F.upper(F.get(parts, 0)).alias("symbol"),
        (F.get(parts, 1) if stream_type is None else F.lit(stream_type)).alias("stream_type"),
        F.col(frame_col).alias("raw_payload"),
        F.col("_reason").alias("reason"),
        *keep,
    )


def split_frames(
    frames: DataFrame,
    frame_col: str = "frame",
    received_col: str | None = "received_at",
    stream_type: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(envelopes, quarantine)`` over one input; every frame lands in
    exactly one of them."""
    return (
        envelope_from_frames(frames, frame_col, received_col, stream_type=stream_type),
        quarantine_frames(frames, frame_col, received_col, stream_type=stream_type),
    )


def subscription_filter(
    frames: DataFrame,
    symbols: str | Iterable[str] | DataFrame,
    stream_types: Sequence[str] = STREAM_TYPES,
    frame_col: str = "frame",
    symbol_col: str = "symbol",
) -> DataFrame:
    """Keep frames whose ``$.stream`` belongs to the subscription set.

    ``symbols`` as a string or list is a configuration value: it becomes an
    ``IN`` set evaluated inside the scan stage (no join, no shuffle).  As a
    DataFrame (a static symbol table of any size) the set is built on the
    cluster and applied with a left-semi join: it is counted first, and
    broadcast up to ``BROADCAST_STREAMS`` names, so that frames (which have
    few, hot names) aren't shuffled by name; beyond that they are.
    """
    with_stream = frames.select("*", F.json_tuple(F.col(frame_col), "stream").alias("_stream"))
    if not isinstance(symbols, DataFrame):
        wanted = stream_names(symbols, stream_types)
        return with_stream.filter(F.col("_stream").isin(*wanted)).drop("_stream")
    subscribed = symbols.select(
        F.explode(
            F.transform(
                F.array(*[F.lit(t) for t in stream_types]),
                lambda t: F.concat(F.lower(F.trim(F.col(symbol_col))), F.lit("@"), t),
            )
        ).alias("_stream")
    ).distinct()
    if subscribed.count() <= BROADCAST_STREAMS:
        subscribed = F.broadcast(subscribed)
    return with_stream.join(subscribed, "_stream", "left_semi").drop("_stream")
