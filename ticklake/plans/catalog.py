"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query reads ``events`` and ``conversations`` (for the quarantine feed
also ``pages`` and ``documents``) in full and runs the library's real operators
on data Spark derives from them.  The feed, Bronze and the dashboard's serving
tables are made once per application; every run builds its own layers.  ``oracle_sql`` recomputes the same result independently
in DuckDB from the raw tables.  Timestamps are returned as TIMESTAMP_NTZ in
UTC wall-clock time so both engines compare equal regardless of time zone;
Gold metrics are returned under the serving contract (decimal(20,8)).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ticklake.functions.parsing import instant_from_utc_wall_clock, utc_wall_clock
from ticklake.operators.envelope import (
    envelope_from_frames,
    quarantine_frames,
    split_frames,
    subscription_filter,
)
from ticklake.operators.gold import gold_liquidity, gold_spread, gold_volatility
from ticklake.operators.serving import (
    dashboard_symbols,
    insert_absent,
    liquidity_series,
    read_serving,
    spread_series,
    to_serving_contract,
    volatility_series,
)
from ticklake.operators.silver import (
    REQUIRED_FIELDS,
    quarantine_invalid,
    silver_agg_trade,
    silver_book_ticker,
    silver_depth10,
)
from ticklake.plans.ingest import BRONZE_LINEAGE_SCHEMA, BRONZE_WITH_LINEAGE, read_frame_files, start_ingestion
from ticklake.plans.medallion import LAYERS, bronze_from_records, chain, landing_records
from ticklake.plans.testdata import market_frames, read_table
from ticklake.schemas import BRONZE_SCHEMA, KAFKA_RECORD_SCHEMA, SILVER_AGG_TRADE_SCHEMA, STREAM_TYPES
from ticklake.session import scratch_dir
from ticklake.sources.layers import read_snapshot
from ticklake.streaming.layers import TableLayout, run_layers_once
from ticklake.streaming.progress import ProgressLog, observed_counts, totals
from ticklake.streaming.replay import read_version, replay_layer
from ticklake.streaming.state import open_windows
from ticklake.streaming.sync import GOLD_SCHEMAS, SyncSpec, start_sync, sync_all

# Fixed parameters of the registered queries.
SUBSCRIBED_SYMBOLS = "CLICK, view"
SUBSCRIBED_TYPES = ("aggTrade", "depth10")
DASHBOARD_SYMBOLS = ("CLICK", "VIEW")
DASHBOARD_FROM, DASHBOARD_TO = datetime(2024, 1, 5), datetime(2024, 1, 25, 12, 2)  # UTC
SHORT_SYMBOL = 6  # the symbol table of the semi join: event types up to so many letters
DELAYED_SYMBOL = "SIGNUP"
FRAME_FILES = 32  # files of the feed
_FEED_SCHEMA = "frame string, received_at timestamp, seq long"
# Late trades are replayed so many times as fast, from this instant on, so that
# ten minutes of watermark hold hundreds of trades.
REPLAY_SPEED, REPLAY_FROM = 500, datetime(2024, 1, 1)
RESET_AT = datetime(2024, 1, 10, 7, 33)  # Silver is replayed when the feed has come so far (UTC)
REPLAY_CUT = datetime(2024, 1, 1, 1, 10)  # the last arrival begins here

# What follows the stream name in an odd frame.
ODD_DATA = ("", ',"data":null', ',"data":{}', ',"data":"text"')
# Not exactly one JSON object: text behind it, single quotes, cut off, an array, a scalar, two objects.
_FRAME = '{"stream":"user@aggTrade","data":{"p":"1.5","T":1}}'
BROKEN_FRAMES = (_FRAME + " trailing", _FRAME.replace('"', "'"), _FRAME[:30], f"[{_FRAME}]", '"user@aggTrade"', _FRAME + _FRAME)

Query = Callable[[SparkSession, str], DataFrame]


def for_compare(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns -> TIMESTAMP_NTZ (UTC wall clock), order kept."""
    return df.select(
        *[
            utc_wall_clock(f.name).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- building blocks ------------------------------------------------------


def _no_time(*columns) -> list:
    """A frame without receive time and send sequence."""
    return [*columns, F.lit(None).cast("timestamp").alias("received_at"), F.lit(None).cast("long").alias("seq")]


def odd_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid frames without usable payload, one per conversation turn: of any
    stream type, with no ``data``, or ``data`` that is null, {} or a text."""
    types = F.element_at(F.array(*map(F.lit, STREAM_TYPES)), (F.col("conv_id") % 3 + 1).cast("int"))
    data = F.element_at(F.array(*map(F.lit, ODD_DATA)), (F.col("turn") % len(ODD_DATA) + 1).cast("int"))
    frame = F.concat(F.lit('{"stream":"'), F.lower("role"), F.lit("@"), types, F.lit('"'), data, F.lit("}"))
    return read_table(spark, sf_dir, "conversations").select(*_no_time(frame.alias("frame")))


def frame_files(spark: SparkSession, sf_dir: str) -> str:
    """The feed as a collector would have dropped it: Parquet files that hold
    a frame per row, of all stream types, with odd frames among them."""

    def build() -> str:
        path = scratch_dir(spark, "frames")
        feed = market_frames(spark, sf_dir).unionByName(odd_frames(spark, sf_dir))
        feed.repartition(FRAME_FILES).write.parquet(path)
        return path

    return _once(spark, sf_dir, "frames", build)


def mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stream types in one feed, with odd frames among them."""
    return spark.read.schema(_FEED_SCHEMA).parquet(frame_files(spark, sf_dir))


def market_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed without its odd frames, which have no send sequence."""
    return mixed_feed(spark, sf_dir).where("seq is not null")


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of the whole mixed feed; a Silver transform picks its type."""
    return envelope_from_frames(mixed_feed(spark, sf_dir))


def _gold(table: str, silver: DataFrame) -> DataFrame:
    build = {"gold_volatility": gold_volatility, "gold_spread": gold_spread, "gold_liquidity": gold_liquidity}
    return to_serving_contract(build[table](silver), table)


_SILVER_OF = {
    "gold_volatility": silver_agg_trade,
    "gold_spread": silver_book_ticker,
    "gold_liquidity": silver_depth10,
}


def _silver_for(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _SILVER_OF[table](_envelopes(spark, sf_dir))


def _layout(spark: SparkSession, name: str) -> TableLayout:
    return TableLayout(scratch_dir(spark, name))


def _land(spark: SparkSession, sf_dir: str, layout: TableLayout, frames: DataFrame | None = None) -> None:
    records = landing_records(market_frames(spark, sf_dir) if frames is None else frames)
    records.write.format(layout.fmt).save(layout.table("landing"))


_built: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable):
    """What ``build`` makes, made once per application and input folder: input
    that queries share, as jobs would (``prepare`` makes all of it)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Paths of a landing and a Bronze table that hold the whole feed."""

    def build() -> dict[str, str]:
        layout = _layout(spark, "bronze")
        _land(spark, sf_dir, layout, mixed_feed(spark, sf_dir))
        run_layers_once(spark, layout, chain("bronze"))
        return {name: layout.table(name) for name in ("landing", "bronze")}

    return _once(spark, sf_dir, "bronze", build)


def _serving_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The serving table, written by the keyed insert."""

    def build() -> str:
        target = f"{scratch_dir(spark, 'dashboard')}/{table}"
        insert_absent(spark, _gold(table, _silver_for(table, spark, sf_dir)), target, table)
        return target

    return read_serving(spark, _once(spark, sf_dir, f"serving {table}", build), table)


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Make the tables that queries share: frame files, landing, Bronze and
    what the dashboard reads.  A query makes those it needs itself if this
    hasn't been called; its own layers it builds anew in each run."""
    _bronze_tables(spark, sf_dir)
    for table in _SILVER_OF:
        _serving_table(spark, sf_dir, table)


# --- queries ----------------------------------------------------------------


def q_envelope_from_frames(spark, sf_dir):
    return for_compare(_envelopes(spark, sf_dir))


def noisy_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market frames mixed with other messages from the same feed: chat
    turns on an unknown stream type, page URLs as stream names, raw document
    texts (not JSON), and almost-frames that a lax parser would take."""
    conv = read_table(spark, sf_dir, "conversations")
    stream = F.concat(F.col("role"), F.lit("@chat")).alias("stream")
    said = F.struct(F.col("conv_id").alias("conv"), F.col("turn").alias("turn")).alias("data")
    chat = conv.select(*_no_time(F.to_json(F.struct(stream, said)).alias("frame")))
    broken = F.element_at(F.array(*map(F.lit, BROKEN_FRAMES)), (F.col("turn") % len(BROKEN_FRAMES) + 1).cast("int"))
    almost = conv.select(*_no_time(broken.alias("frame")))
    pages = read_table(spark, sf_dir, "pages").select(*_no_time(F.to_json(F.struct(F.col("url").alias("stream"))).alias("frame")))
    docs = read_table(spark, sf_dir, "documents").select(*_no_time(F.col("text").alias("frame")))
    out = mixed_feed(spark, sf_dir)
    for part in (chat, almost, pages, docs):
        out = out.unionByName(part)
    return out


def q_split_frames(spark, sf_dir):
    """Every frame of the noisy feed, and the one side it lands on."""
    good, bad = split_frames(noisy_feed(spark, sf_dir))
    good = good.select(F.col("raw_payload").alias("frame"), F.lit("envelope").alias("side"))
    return good.unionByName(bad.select("frame", F.lit("quarantine").alias("side")))


def q_quarantine_frames(spark, sf_dir):
    return for_compare(quarantine_frames(noisy_feed(spark, sf_dir)))


def q_strict_silver_quotes(spark, sf_dir):
    """Garbage inside valid envelopes: chat turns published as bookTicker
    messages whose price fields carry text.  They pass the envelope and the
    Silver parse (NULL prices); the strict split reports them with the
    required fields they miss."""
    conv = read_table(spark, sf_dir, "conversations").select(
        F.to_json(
            F.struct(
                F.concat(F.col("role"), F.lit("@bookTicker")).alias("stream"),
                F.struct(
                    F.col("turn").alias("u"),
                    F.upper("role").alias("s"),
                    F.col("text").alias("b"),
                    F.col("turn").cast("string").alias("B"),
                    F.col("text").alias("a"),
                    F.col("conv_id").cast("string").alias("A"),
                ).alias("data"),
            )
        ).alias("frame"),
        F.lit(None).cast("timestamp").alias("received_at"),
        F.lit(None).cast("long").alias("seq"),
    )
    feed = market_feed(spark, sf_dir).drop("seq").unionByName(conv.drop("seq"))
    quotes = silver_book_ticker(envelope_from_frames(feed))
    bad = quarantine_invalid(quotes, REQUIRED_FIELDS["silver_book_ticker"])
    return for_compare(bad.withColumn("missing_fields", F.array_join("missing_fields", ",")))


def q_subscription_filter(spark, sf_dir):
    return for_compare(subscription_filter(mixed_feed(spark, sf_dir), SUBSCRIBED_SYMBOLS, SUBSCRIBED_TYPES))


def q_kafka_round_trip(spark, sf_dir):
    return for_compare(bronze_from_records(landing_records(mixed_feed(spark, sf_dir))))


def q_subscription_semi(spark, sf_dir):
    """Frames whose symbol is in a symbol table (a left-semi join)."""
    symbols = read_table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"))
    symbols = symbols.where(F.length("symbol") <= SHORT_SYMBOL).distinct()
    return for_compare(subscription_filter(mixed_feed(spark, sf_dir), symbols, SUBSCRIBED_TYPES))


def q_bronze_all(spark, sf_dir):
    """The Bronze layer's streaming query over the landed feed."""
    layout = TableLayout(scratch_dir(spark, "bronze_all"), at={"landing": _bronze_tables(spark, sf_dir)["landing"]})
    run_layers_once(spark, layout, chain("bronze"))
    bronze = read_snapshot(spark, layout.table("bronze"), BRONZE_SCHEMA)
    return for_compare(bronze.select(*BRONZE_SCHEMA.fieldNames()))


def q_bronze_partitioned(spark, sf_dir):
    """One partition of Bronze (the feature is the pruning)."""
    bronze = read_snapshot(spark, _bronze_tables(spark, sf_dir)["bronze"], BRONZE_SCHEMA)
    return for_compare(bronze.filter(F.col("stream_type") == "depth10").select(*BRONZE_SCHEMA.fieldNames()))


def q_bronze_lineage(spark, sf_dir):
    """Frame files -> ingestion -> Bronze with the lineage that Spark's file
    metadata gives; each Bronze row, and whether the frame that lies at its
    place (file and row) is its own and the file was written when it says.
    Looked up in scans that know nothing of the ingestion."""
    files, layout = frame_files(spark, sf_dir), _layout(spark, "lineage")
    start_ingestion(read_frame_files(spark, files), layout, available_now=True).awaitTermination()
    run_layers_once(spark, layout, [BRONZE_WITH_LINEAGE])
    bronze = read_snapshot(spark, layout.table("bronze"), BRONZE_LINEAGE_SCHEMA)
    place = ["source_file", "offset"]
    frames = spark.read.schema(_FEED_SCHEMA).parquet(files)
    frames = frames.select("frame", F.col("_metadata.file_path").alias(place[0]), F.col("_metadata.row_index").alias(place[1]))
    listed = spark.read.format("binaryFile").load(files).select(F.col("path").alias(place[0]), F.col("modificationTime").alias("modified"))
    found = bronze.join(frames, place, "left").join(F.broadcast(listed), place[0], "left")  # FRAME_FILES rows
    number = F.regexp_extract(F.col("source_file"), r"part-([0-9]+)", 1).cast("int")
    return found.select(
        "symbol",
        "stream_type",
        "raw_payload",
        F.coalesce(F.col("frame") == F.col("raw_payload"), F.lit(False)).alias("frame_found"),
        F.coalesce((F.col("modified") == F.col("kafka_timestamp")) & (F.col("partition") == number), F.lit(False)).alias("file_found"),
    )


def q_silver_agg_trade(spark, sf_dir):
    return for_compare(_silver_for("gold_volatility", spark, sf_dir))


def q_silver_book_ticker(spark, sf_dir):
    return for_compare(_silver_for("gold_spread", spark, sf_dir))


def q_silver_depth10(spark, sf_dir):
    return for_compare(_silver_for("gold_liquidity", spark, sf_dir))


def _q_gold(table: str) -> Query:
    def run(spark, sf_dir):
        return for_compare(_gold(table, _silver_for(table, spark, sf_dir)))

    run.__name__ = f"q_{table}"
    return run


def _q_gold_stream(table: str) -> Query:
    def run(spark, sf_dir):
        layout = TableLayout(scratch_dir(spark, table), at={"bronze": _bronze_tables(spark, sf_dir)["bronze"]})
        run_layers_once(spark, layout, chain(table)[1:])
        gold = read_snapshot(spark, layout.table(table), GOLD_SCHEMAS[table])
        return for_compare(to_serving_contract(gold, table))

    run.__name__ = f"q_{table}_stream"
    return run


def q_silver_quality(spark, sf_dir):
    """What the Silver layers' batches counted: frames of each type that came
    in, rows made of them (levels of a book), and rows with an empty payload."""
    layout = TableLayout(scratch_dir(spark, "quality"), at={"bronze": _bronze_tables(spark, sf_dir)["bronze"]})
    log = ProgressLog(scratch_dir(spark, "quality_progress"))
    spark.streams.addListener(log)
    try:
        run_layers_once(spark, layout, [s for s in LAYERS.values() if s.source == "bronze"], log=log)
    finally:
        spark.streams.removeListener(log)
    return observed_counts(spark, log.path).select("layer", "name", "total")


def _replayed(trades: DataFrame) -> DataFrame:
    """Trades with their event time compressed by REPLAY_SPEED."""
    start = int(REPLAY_FROM.replace(tzinfo=timezone.utc).timestamp() * 1000)
    ms = F.unix_millis("trade_timestamp")
    return trades.withColumn("trade_timestamp", F.timestamp_millis(F.lit(start) + F.floor((ms - start) / REPLAY_SPEED)))


def _late_trades(spark, sf_dir, late: Callable | None = None, log: ProgressLog | None = None) -> TableLayout:
    """Trades arrive in three batches: up to a cut every symbol but one, then
    the delayed symbol up to the cut, then all that follows.  The delayed
    rows in windows already closed by the watermark are dropped, those in the
    open ones are counted.  ``late`` (tests) changes the second batch.  Returns
    the layout with the Gold table and its checkpoint."""
    layout = _layout(spark, "late_trades")
    trades = _replayed(_silver_for("gold_volatility", spark, sf_dir)).where("trade_timestamp is not null").persist()
    cut = instant_from_utc_wall_clock(F.lit(REPLAY_CUT.isoformat(sep=" ")).cast("timestamp_ntz"))
    early = trades.filter(F.col("trade_timestamp") < cut)
    delayed = early.filter(F.col("symbol") == DELAYED_SYMBOL)
    arrivals = [
        early.filter(F.col("symbol") != DELAYED_SYMBOL),
        late(delayed) if late else delayed,
        trades.filter(F.col("trade_timestamp") >= cut),
    ]
    gold = LAYERS["gold_volatility"]
    try:
        for batch in arrivals:
            batch.write.format(layout.fmt).mode("append").save(layout.table(gold.source))
            run_layers_once(spark, layout, [gold], log=log)
    finally:
        trades.unpersist()
    return layout


def _replayed_silver(spark, sf_dir) -> TableLayout:
    """The chain to the volatility table over a feed that arrives in two
    parts; between them Silver is reset and replayed into a new version, while
    Gold keeps its table, state and checkpoint."""
    bronze, silver, gold = chain("gold_volatility")
    whole = read_snapshot(spark, _bronze_tables(spark, sf_dir)["landing"], KAFKA_RECORD_SCHEMA)
    # odd frames have no sequence and no time of their own
    early = F.col("offset").isNull() | (F.col("timestamp") < instant_from_utc_wall_clock(F.lit(RESET_AT.isoformat(sep=" ")).cast("timestamp_ntz")))
    layout = _layout(spark, "replay")
    whole.where(early).write.format(layout.fmt).save(layout.table("landing"))
    run_layers_once(spark, layout, [bronze, silver, gold])
    layout = replay_layer(spark, layout, silver, [gold])
    whole.where(~early).write.format(layout.fmt).mode("append").save(layout.table("landing"))
    run_layers_once(spark, layout, [bronze, silver, gold])
    return layout


def q_gold_after_replay(spark, sf_dir):
    """What the Gold table holds after ``_replayed_silver``: rows that Silver
    made again must not count twice, in windows that were open at the reset."""
    gold = read_snapshot(spark, _replayed_silver(spark, sf_dir).table("gold_volatility"), GOLD_SCHEMAS["gold_volatility"])
    return for_compare(to_serving_contract(gold, "gold_volatility"))


def q_silver_after_replay(spark, sf_dir):
    """What the new version of the Silver table holds: all trades, once."""
    layout = _replayed_silver(spark, sf_dir)
    silver = read_version(spark, layout, "silver_agg_trade", SILVER_AGG_TRADE_SCHEMA)
    # an odd frame's receive time is that of its landing
    return for_compare(silver.where("trade_timestamp is not null"))


def q_late_trades_stream(spark, sf_dir, late: Callable | None = None):
    """What the Gold table holds after the three arrivals of ``_late_trades``."""
    layout = _late_trades(spark, sf_dir, late)
    out = read_snapshot(spark, layout.table("gold_volatility"), GOLD_SCHEMAS["gold_volatility"])
    return for_compare(to_serving_contract(out, "gold_volatility"))


def q_gold_open_windows(spark, sf_dir):
    """The windows that stay open after the arrivals, with their metrics so
    far, read from the layer's state."""
    layout = _late_trades(spark, sf_dir)
    return for_compare(to_serving_contract(open_windows(spark, layout, "gold_volatility"), "gold_volatility"))


def q_late_trades_dropped(spark, sf_dir):
    """Rows that the Gold layer dropped as late over all of its runs: of each
    batch one for each closed window and symbol (trades are added up first)."""
    log = ProgressLog(scratch_dir(spark, "late_trades_progress"))
    spark.streams.addListener(log)
    try:
        _late_trades(spark, sf_dir, log=log)
    finally:
        spark.streams.removeListener(log)
    return totals(spark, log.path).select("layer", "rows_dropped")


# Rows of the first insert: half of what most windows with several rows hold, so its values differ from the full ones.
_SEED_ROWS = {"gold_volatility": "agg_trade_id % 2 = 0", "gold_spread": "update_id % 2 = 0", "gold_liquidity": "level % 2 = 0"}


def _q_insert_delta(table: str) -> Query:
    def run(spark, sf_dir):
        silver = _silver_for(table, spark, sf_dir).persist()  # read twice below
        try:
            target = f"{scratch_dir(spark, 'serving_' + table)}/{table}"
            insert_absent(spark, _gold(table, silver.filter(_SEED_ROWS[table])), target, table)
            insert_absent(spark, _gold(table, silver), target, table)
        finally:
            silver.unpersist()
        return for_compare(read_serving(spark, target, table))

    run.__name__ = f"q_insert_delta_{table}"
    return run


def _q_sync(table: str) -> Query:
    """Gold synced by the streaming sync, then replayed from a fresh
    checkpoint: the serving table must not change."""

    def run(spark, sf_dir):
        root = scratch_dir(spark, f"sync_{table}")
        gold_path = f"{root}/gold/{table}"
        build = {"gold_volatility": gold_volatility, "gold_spread": gold_spread, "gold_liquidity": gold_liquidity}[table]
        build(_silver_for(table, spark, sf_dir)).write.parquet(gold_path)
        target = f"{root}/serving/{table}"
        for run_no in (1, 2):
            spec = SyncSpec(table, gold_path, GOLD_SCHEMAS[table], target, f"{root}/checkpoints/{table}-{run_no}")
            handle = sync_all(spark, [spec], available_now=True)[table]
            if handle is None or handle.exception() is not None:
                raise RuntimeError(f"sync run {run_no} failed: {handle and handle.exception()}")
        return for_compare(read_serving(spark, target, table))

    run.__name__ = f"q_sync_{table}"
    return run


def q_sync_recovered(spark, sf_dir):
    """A sync that ends after its batch is applied and before it is committed,
    and a second one from the same checkpoint: Spark replays the batch, which
    must add nothing and lose nothing."""
    root, table = scratch_dir(spark, "sync_recovered"), "gold_volatility"
    gold_volatility(_silver_for(table, spark, sf_dir)).write.parquet(f"{root}/gold")
    spec = SyncSpec(table, f"{root}/gold", GOLD_SCHEMAS[table], f"{root}/serving/{table}", f"{root}/checkpoint")

    def lost(epoch_id: int) -> None:
        raise RuntimeError(f"lost after batch {epoch_id}")

    first = start_sync(spark, spec, available_now=True, on_applied=lost)
    try:
        first.awaitTermination()
    except StreamingQueryException:
        pass
    if first.exception() is None:
        raise RuntimeError("the first sync should have been lost")
    start_sync(spark, spec, available_now=True).awaitTermination()
    return for_compare(read_serving(spark, spec.target_path, table))


def q_dash_symbols(spark, sf_dir):
    return dashboard_symbols(_serving_table(spark, sf_dir, "gold_volatility"))


def _q_dash(table: str, series: Callable) -> Query:
    def run(spark, sf_dir):
        served = _serving_table(spark, sf_dir, table)
        return for_compare(series(served, DASHBOARD_SYMBOLS, DASHBOARD_FROM, DASHBOARD_TO))

    run.__name__ = f"q_dash_{table}"
    return run


QUERIES: dict[str, Query] = {
    "envelope_from_frames": q_envelope_from_frames,
    "quarantine_frames": q_quarantine_frames,
    "split_frames": q_split_frames,
    "subscription_filter": q_subscription_filter,
    "subscription_semi": q_subscription_semi,
    "strict_silver_quotes": q_strict_silver_quotes,
    "kafka_round_trip": q_kafka_round_trip,
    "bronze_all": q_bronze_all,
    "bronze_partitioned": q_bronze_partitioned,
    "bronze_lineage": q_bronze_lineage,
    "silver_agg_trade": q_silver_agg_trade,
    "silver_book_ticker": q_silver_book_ticker,
    "silver_depth10": q_silver_depth10,
    "gold_volatility": _q_gold("gold_volatility"),
    "gold_spread": _q_gold("gold_spread"),
    "gold_liquidity": _q_gold("gold_liquidity"),
    "gold_volatility_stream": _q_gold_stream("gold_volatility"),
    "gold_spread_stream": _q_gold_stream("gold_spread"),
    "gold_liquidity_stream": _q_gold_stream("gold_liquidity"),
    "gold_after_replay": q_gold_after_replay,
    "silver_after_replay": q_silver_after_replay,
    "silver_quality": q_silver_quality,
    "late_trades_stream": q_late_trades_stream,
    "late_trades_dropped": q_late_trades_dropped,
    "gold_open_windows": q_gold_open_windows,
    "insert_delta_volatility": _q_insert_delta("gold_volatility"),
    "insert_delta_spread": _q_insert_delta("gold_spread"),
    "insert_delta_liquidity": _q_insert_delta("gold_liquidity"),
    "sync_twice": _q_sync("gold_volatility"),
    "sync_spread": _q_sync("gold_spread"),
    "sync_liquidity": _q_sync("gold_liquidity"),
    "sync_recovered": q_sync_recovered,
    "dash_symbols": q_dash_symbols,
    "dash_volatility": _q_dash("gold_volatility", volatility_series),
    "dash_spread": _q_dash("gold_spread", spread_series),
    "dash_liquidity": _q_dash("gold_liquidity", liquidity_series),
}
