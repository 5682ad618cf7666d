"""Silver layer: Bronze envelopes -> typed tables, one per stream type.

Each transform filters one stream type (a partition filter when Bronze is
partitioned by ``stream_type``), parses ``$.data`` with the stream's schema,
drops rows whose payload is NULL (frame not JSON or without ``data``) and
projects typed columns.  Stateless and narrow: no shuffle.

Parse outcomes kept on purpose: a ``data`` that is ``{}``, a string or an
array gives a row with all payload fields NULL; a wrong-typed field gives
NULL for that field only; an unparseable number gives a NULL decimal.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.parsing import (
    decimal_from_text,
    level_price,
    level_quantity,
    parse_payload_text,
    payload_present,
    timestamp_from_epoch_ms,
)
from ticklake.schemas import AGG_TRADE, ASK, BID, BOOK_TICKER, DEPTH10


def bronze(envelopes: DataFrame) -> DataFrame:
    """Bronze keeps the envelope verbatim; the layer exists so the raw
    record survives every later schema change."""
    return envelopes


def _parsed(bronze_df: DataFrame, stream_type: str) -> DataFrame:
    """Rows of one stream type with the payload parsed once into ``p``.

    ``$.data`` is the path extraction of the layer contract (of repeated
    ``data`` members the first).  Both it and the parse come out of a
    generator, so no filter above can be pushed under them with a copy: each
    frame is scanned once and each surviving payload parsed once.
    """
    data = F.get_json_object("raw_payload", "$.data").alias("data")
    parsed = parse_payload_text("data", stream_type).alias("p")
    return (
        bronze_df.filter(F.col("stream_type") == F.lit(stream_type))
        .select("symbol", "ingestion_timestamp", F.inline(F.array(F.struct(data))))
        .filter(payload_present("data"))
        .select("symbol", "ingestion_timestamp", F.inline(F.array(F.struct(parsed))))
    )


def silver_agg_trade(bronze_df: DataFrame) -> DataFrame:
    """aggTrade envelopes -> one typed row per aggregate trade."""
    return _parsed(bronze_df, AGG_TRADE).select(
        "symbol",
        "ingestion_timestamp",
        F.col("p.event_type").alias("event_type"),
        timestamp_from_epoch_ms("p.event_ms").alias("event_timestamp"),
        F.col("p.agg_trade_id").alias("agg_trade_id"),
        decimal_from_text("p.price_text").alias("price"),
        decimal_from_text("p.quantity_text").alias("quantity"),
        F.col("p.first_trade_id").alias("first_trade_id"),
        F.col("p.last_trade_id").alias("last_trade_id"),
        timestamp_from_epoch_ms("p.trade_ms").alias("trade_timestamp"),
        F.col("p.is_buyer_maker").alias("is_buyer_maker"),
        F.col("p.is_best_match").alias("is_best_match"),
    )


def silver_book_ticker(bronze_df: DataFrame) -> DataFrame:
    """bookTicker envelopes -> one typed best bid/ask row per update."""
    return _parsed(bronze_df, BOOK_TICKER).select(
        "symbol",
        "ingestion_timestamp",
        F.col("p.update_id").alias("update_id"),
        decimal_from_text("p.bid_text").alias("best_bid_price"),
        decimal_from_text("p.bid_qty_text").alias("best_bid_quantity"),
        decimal_from_text("p.ask_text").alias("best_ask_price"),
        decimal_from_text("p.ask_qty_text").alias("best_ask_quantity"),
    )


def silver_depth10(bronze_df: DataFrame) -> DataFrame:
    """depth10 envelopes -> one row per (snapshot, side, level).

    Both sides come from a single scan: the two level arrays are tagged
    ``bid``/``ask`` and exploded in one generator, then each side's levels
    are exploded with their position (``level`` 0 = best).  A NULL or empty
    side yields no rows and leaves the other side untouched.
    """
    sides = _parsed(bronze_df, DEPTH10).select(
        "symbol",
        "ingestion_timestamp",
        F.col("p.last_update_id").alias("last_update_id"),
        F.inline(
            F.array(
                F.struct(F.lit(BID).alias("side"), F.col("p.bids").alias("levels")),
                F.struct(F.lit(ASK).alias("side"), F.col("p.asks").alias("levels")),
            )
        ),
    )
    levels = sides.select(
        "symbol",
        "ingestion_timestamp",
        "last_update_id",
        "side",
        F.posexplode("levels").alias("level", "raw_level"),
    )
    return levels.select(
        "symbol",
        "ingestion_timestamp",
        "last_update_id",
        "side",
        F.col("level").cast("int").alias("level"),
        level_price("raw_level").alias("price"),
        level_quantity("raw_level").alias("quantity"),
    )


# Columns a downstream consumer needs non-NULL, per Silver table.
REQUIRED_FIELDS = {
    "silver_agg_trade": ("symbol", "trade_timestamp", "price", "quantity"),
    "silver_book_ticker": ("symbol", "ingestion_timestamp", "best_bid_price", "best_ask_price"),
    "silver_depth10": ("symbol", "ingestion_timestamp", "side", "level", "price", "quantity"),
}


def _missing(required) -> Column:
    flags = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return F.filter(flags, lambda name: name.isNotNull())


def quarantine_invalid(silver_df: DataFrame, required) -> DataFrame:
    """Silver rows with a NULL in any ``required`` column, plus
    ``missing_fields`` naming them (the strict view; the Silver transforms
    themselves keep such rows, as the layer contract says)."""
    return silver_df.withColumn("missing_fields", _missing(required)).filter(F.size("missing_fields") > 0)


def valid_rows(silver_df: DataFrame, required) -> DataFrame:
    """Silver rows with every ``required`` column present."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return silver_df.filter(cond)


def payload_columns(silver_df_columns: list[str]) -> list[str]:
    """The columns that come from the payload."""
    return [c for c in silver_df_columns if c not in ("symbol", "ingestion_timestamp")]


def empty_payloads(silver_df_columns: list[str]) -> Column:
    """How many rows have a payload without any usable field."""
    return F.count_if(reduce(and_, [F.col(c).isNull() for c in payload_columns(silver_df_columns)]))
