"""Streaming serving sync: Gold tables -> keyed serving tables.

One streaming query per table, each with its own checkpoint: a failing
table does not stop the others, and each micro-batch carries only the Gold
rows appended since the last one (no full rescan per cycle).  Each batch is
applied with ``insert_absent`` and then marked as applied beside the query's
checkpoint.  A batch that Spark replays, because the query ended before its
commit, is skipped by its marker without reading the target; if it ended before
the marker, ``insert_absent`` adds what is missing.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ticklake.operators.serving import JdbcTarget, insert_absent
from ticklake.schemas import (
    GOLD_LIQUIDITY_SCHEMA,
    GOLD_SPREAD_SCHEMA,
    GOLD_VOLATILITY_SCHEMA,
)
from ticklake.sources.layers import DEFAULT_FORMAT, read_layer, table_available, try_read_snapshot
from ticklake.streaming.layers import REPLAYED, TableLayout


@dataclass(frozen=True)
class SyncSpec:
    table: str  # serving table name (selects contract and key)
    gold_path: str
    gold_schema: StructType
    target_path: "str | JdbcTarget"  # table path or database table
    checkpoint_path: str


log = logging.getLogger(__name__)

# Gold files in one micro-batch, so that a cold start works the backlog off in
# bounded batches.
MAX_FILES_PER_TRIGGER = 256

GOLD_SCHEMAS = {
    "gold_volatility": GOLD_VOLATILITY_SCHEMA,
    "gold_spread": GOLD_SPREAD_SCHEMA,
    "gold_liquidity": GOLD_LIQUIDITY_SCHEMA,
}


_APPLIED_SCHEMA = StructType([StructField("epoch_id", LongType())])


def applied_epoch(spark: SparkSession, spec: SyncSpec) -> int:
    """The last batch of the sync's checkpoint that is known to be applied in
    full; -1 if there is none (or its marker was being written)."""
    marker = try_read_snapshot(spark, f"{spec.checkpoint_path}/applied", _APPLIED_SCHEMA)
    row = marker and marker.agg(F.max("epoch_id")).first()
    return -1 if not row or row[0] is None else row[0]


def _mark_applied(spark: SparkSession, spec: SyncSpec, epoch_id: int) -> None:
    done = spark.range(epoch_id, epoch_id + 1, 1, 1).select(F.col("id").alias("epoch_id"))
    done.write.mode("overwrite").parquet(f"{spec.checkpoint_path}/applied")


def start_sync(
    spark: SparkSession,
    spec: SyncSpec,
    fmt: str = DEFAULT_FORMAT,
    available_now: bool = False,
    trigger_interval: str = "30 seconds",
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    on_applied: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the sync of one Gold table; returns the running query.  After a
    batch is applied and marked, before Spark commits it, ``on_applied`` is
    called with its id; an error there fails the query, as a lost driver would.
    """

    def apply(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        if epoch_id <= applied_epoch(session, spec):
            log.info("batch %s of %s has been applied", epoch_id, spec.table)
            return
        insert_absent(session, batch, spec.target_path, spec.table, fmt)
        _mark_applied(session, spec, epoch_id)
        if on_applied is not None:
            on_applied(epoch_id)

    writer = (
        read_layer(spark, spec.gold_path, spec.gold_schema, fmt, max_files_per_trigger)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", spec.checkpoint_path)
    )
    writer = (
        writer.trigger(availableNow=True)
        if available_now
        else writer.trigger(processingTime=trigger_interval)
    )
    return writer.start()


def _start_if_there(spark: SparkSession, spec: SyncSpec, fmt: str, available_now: bool) -> StreamingQuery | None:
    """Start the sync of a table; None while its Gold table is not there yet
    or if the sync can't start.  Its jobs run in the table's own scheduler pool."""
    try:
        if not table_available(spark, spec.gold_path, spec.gold_schema, fmt):
            log.warning("gold table not available yet: %s", spec.gold_path)
            return None
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"sync_{spec.table}")
        try:
            return start_sync(spark, spec, fmt, available_now)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    except Exception as err:  # of this table only
        log.error("sync of %s can't start: %s", spec.table, err)
        return None


def sync_all(
    spark: SparkSession,
    specs: list[SyncSpec],
    fmt: str = DEFAULT_FORMAT,
    available_now: bool = False,
) -> dict[str, StreamingQuery | None]:
    """Start one sync per table; ``None`` for a table whose Gold table is not
    there yet or whose sync can't start (``sync_until_stopped`` tries again).
    All run at the same time, each in a scheduler pool of its own (fair shares
    need ``spark.scheduler.mode=FAIR``).  With ``available_now`` all are then
    awaited and a failure stays in its handle.  An error of one table, at its
    start or later, never keeps the others from syncing."""
    out = {spec.table: _start_if_there(spark, spec, fmt, available_now) for spec in specs}
    if available_now:
        for table, query in out.items():
            if query is not None:
                _awaited(table, query)
    return out


def _awaited(table: str, query: StreamingQuery) -> None:
    try:
        query.awaitTermination()
    except Exception as err:  # the handle keeps it
        log.error("sync of %s failed: %s", table, err)


def sync_until_stopped(
    spark: SparkSession,
    specs: list[SyncSpec],
    fmt: str = DEFAULT_FORMAT,
    interval_s: float = 30.0,
    stop: threading.Event | None = None,
) -> None:
    """Sync every table again and again until ``stop`` is set.  Each table has
    a thread with cycles of its own, so a slow or blocked table delays no
    other: a cycle takes what Gold has appended since the last one (the
    table's checkpoint knows); a table that is missing or has failed is tried
    again.  Setting ``stop`` ends a cycle that is running, too: its open batch
    is done by the next start."""
    stop = stop or threading.Event()

    def cycles(spec: SyncSpec) -> None:
        while not stop.is_set():
            query = _start_if_there(spark, spec, fmt, True)
            while query is not None and not stop.is_set():
                try:
                    if query.awaitTermination(1):
                        break
                except Exception as err:
                    log.error("sync of %s failed: %s", spec.table, err)
                    break
            if query is not None and query.isActive:
                query.stop()
            stop.wait(interval_s)

    threads = [threading.Thread(target=inheritable_thread_target(spark)(cycles), args=(spec,), name=f"sync_{spec.table}") for spec in specs]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()


def serving_specs(layout: TableLayout, targets: dict[str, "str | JdbcTarget"] | None = None) -> list[SyncSpec]:
    """The syncs of all Gold tables of a layout; a target is a table of the
    same layout unless given.  Of a replayed Gold table all rows are offered;
    the insert takes those whose key is absent."""
    targets = targets or {}
    with_mark = [StructField(REPLAYED, BooleanType())]
    return [
        SyncSpec(t, layout.table(t), StructType(schema.fields + with_mark) if layout.replayed(t) else schema, targets.get(t, layout.table(f"serving_{t}")), layout.checkpoint(f"serving_{t}"))
        for t, schema in GOLD_SCHEMAS.items()
    ]
