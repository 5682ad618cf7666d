"""Market frames derived from the driver's ``events`` table.

There is no market data in the test set, so each event becomes genuine
exchange JSON frames, which then go through the real parse path:

* ``aggTrade``:  one per event.  ``E = T`` = the event time in epoch ms,
  ``s`` = upper(event_type), ``a = f = l`` = event_id, ``p`` = value as a
  decimal(20,8) text, ``q`` = ``props.k``, ``m`` = event_id is even,
  ``M`` = true.
* ``bookTicker``: one per event.  ``u`` = event_id, ``b`` = value,
  ``B`` = k, ``a`` = value + k/100, ``A`` = user_id.
* ``depth10``: one order-book snapshot per (event_type, event_id div 20):
  at most ten even event_ids as bids and ten odd ones as asks, each level
  ``[value, k]`` in event_id order; ``lastUpdateId`` = the group's max
  event_id; received at the group's latest event time.  Groups hold at
  most 20 events whatever the data size, so collecting a snapshot's levels
  is bounded work.

``received_at`` is the event time as an instant (``events.ts`` is read as
UTC wall-clock time, independent of the session time zone).  ``seq`` is the
producer's send sequence: ``event_id * 3 + stream index`` (``lastUpdateId``
for a book), used as the topic offset of the landing stand-in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.parsing import epoch_micros_of_wall_clock
from ticklake.schemas import AGG_TRADE, BOOK_TICKER, DEPTH10, PRICE_TYPE

# Events per depth snapshot (half bids, half asks): a depth10 book.
SNAPSHOT_EVENTS = 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, in the splits that the scan gives it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, event_ms, received_at, symbol, price, qty,
    user_id) with exact decimal price / quantity."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    micros = epoch_micros_of_wall_clock("ts")
    return ev.select(
        "event_id",
        F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).alias("event_ms"),
        F.timestamp_micros(micros).alias("received_at"),
        F.upper("event_type").alias("symbol"),
        F.col("value").cast(PRICE_TYPE).alias("price"),
        F.get_json_object("props", "$.k").cast(PRICE_TYPE).alias("qty"),
        "user_id",
    )


def _seq(id_col: str, stream_index: int) -> Column:
    return (F.col(id_col) * 3 + stream_index).alias("seq")


def _text(c: Column) -> Column:
    """Text of an integer column."""
    return c.cast("string")


def _decimal_text(c: Column) -> Column:
    """Plain text of a non-negative decimal(20,8) the way the exchange writes
    it (``0.00000000``, never ``0E-8``), built from integer parts so it does
    not depend on how the session's ANSI setting casts decimals to text."""
    units = F.floor(c).cast("long")
    eighths = ((c - units) * F.lit(100000000)).cast("long")
    return F.when(c.isNotNull(), F.concat(units.cast("string"), F.lit("."), F.lpad(eighths.cast("string"), 8, "0")))


def _frame(stream_type: str, data: Column) -> Column:
    stream = F.concat(F.lower(F.col("symbol")), F.lit("@" + stream_type))
    return F.to_json(F.struct(stream.alias("stream"), data.alias("data")))


def _row(stream_type: str, data: Column, seq: Column) -> Column:
    return F.struct(_frame(stream_type, data).alias("frame"), F.col("received_at").alias("received_at"), seq)


def _agg_trade_row() -> Column:
    data = F.struct(
        F.lit(AGG_TRADE).alias("e"),
        F.col("event_ms").alias("E"),
        F.col("symbol").alias("s"),
        F.col("event_id").alias("a"),
        _decimal_text(F.col("price")).alias("p"),
        _decimal_text(F.col("qty")).alias("q"),
        F.col("event_id").alias("f"),
        F.col("event_id").alias("l"),
        F.col("event_ms").alias("T"),
        (F.col("event_id") % 2 == 0).alias("m"),
        F.lit(True).alias("M"),
    )
    return _row(AGG_TRADE, data, _seq("event_id", 0))


def _book_ticker_row() -> Column:
    ask = (F.col("price") + F.col("qty") * F.lit(0.01).cast("decimal(3,2)")).cast(PRICE_TYPE)
    data = F.struct(
        F.col("event_id").alias("u"),
        F.col("symbol").alias("s"),
        _decimal_text(F.col("price")).alias("b"),
        _decimal_text(F.col("qty")).alias("B"),
        _decimal_text(ask).alias("a"),
        _text(F.col("user_id")).alias("A"),
    )
    return _row(BOOK_TICKER, data, _seq("event_id", 1))


_PER_EVENT_ROWS = {AGG_TRADE: _agg_trade_row, BOOK_TICKER: _book_ticker_row}


def per_event_frames(market: DataFrame, stream_types=(AGG_TRADE, BOOK_TICKER)) -> DataFrame:
    """aggTrade and/or bookTicker frames from one pass over the events: one
    generator emits each event's frames."""
    return market.select(F.inline(F.array(*[_PER_EVENT_ROWS[t]() for t in stream_types])))


def agg_trade_frames(market: DataFrame) -> DataFrame:
    return per_event_frames(market, (AGG_TRADE,))


def book_ticker_frames(market: DataFrame) -> DataFrame:
    return per_event_frames(market, (BOOK_TICKER,))


def depth10_frames(market: DataFrame) -> DataFrame:
    entries = F.sort_array(
        F.collect_list(F.struct("event_id", _decimal_text(F.col("price")).alias("p"), _decimal_text(F.col("qty")).alias("q")))
    )

    def side(parity: int) -> Column:
        return F.transform(
            F.filter("entries", lambda e: e["event_id"] % 2 == parity),
            lambda e: F.array(e["p"], e["q"]),
        )

    books = market.groupBy(
        "symbol", F.expr(f"event_id div {SNAPSHOT_EVENTS}").alias("snapshot")
    ).agg(
        F.max("event_id").alias("last_update_id"),
        F.max("received_at").alias("received_at"),
        entries.alias("entries"),
    )
    data = F.struct(
        F.col("last_update_id").alias("lastUpdateId"),
        side(0).alias("bids"),
        side(1).alias("asks"),
    )
    return books.select(F.inline(F.array(_row(DEPTH10, data, _seq("last_update_id", 2)))))


def market_frames(spark: SparkSession, sf_dir: str, stream_types=(AGG_TRADE, BOOK_TICKER, DEPTH10)) -> DataFrame:
    """All frames of the requested stream types: ``(frame, received_at, seq)``."""
    market = market_events(spark, sf_dir)
    per_event = tuple(t for t in stream_types if t in _PER_EVENT_ROWS)
    parts = []
    if per_event:
        parts.append(per_event_frames(market, per_event))
    if DEPTH10 in stream_types:
        parts.append(depth10_frames(market))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
