"""The layer template: read a layer as a stream -> transform -> append.

Layers share nothing but tables: each runs as its own streaming query with
its own checkpoint, so a layer can be reset and replayed from the one above
without touching the others.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from ticklake.contracts import assert_contract
from ticklake.sources.layers import DEFAULT_FORMAT, read_layer, table_available, write_layer
from ticklake.streaming.progress import ProgressLog


logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class LayerSpec:
    """One layer: where it reads, how it transforms, how it is laid out."""

    name: str
    source: str  # upstream table name (or the landing topic table)
    source_schema: StructType
    transform: Callable[[DataFrame], DataFrame]
    partition_by: str | None = None
    trigger_interval: str = "10 seconds"
    # Partition column of the source table, if any.  A streaming file source
    # fixes its partition columns when it starts, from the files it sees then;
    # started on a still-empty partitioned table it would read that column as
    # NULL for ever after.  Such a layer starts only once the column exists.
    source_partitioned_by: str | None = None
    output_schema: StructType | None = None  # the transform's contract, checked before the layer starts
    # Makes the counts of the layer's rows that each batch reports with its progress (see ProgressLog).
    counts: Callable[[], Mapping[str, Column]] = dict


class SourceNotReady(RuntimeError):
    """The layer's source table does not exist yet, or is partitioned and
    holds no partition yet."""


@dataclass(frozen=True)
class TableLayout:
    """Table and checkpoint paths under one root (on shared storage); ``at``
    gives the path of tables that lie elsewhere, ``versions`` which version of a
    replayed layer counts (``ticklake.streaming.replay``; 0 is the first)."""

    root: str
    fmt: str = DEFAULT_FORMAT
    at: Mapping[str, str] = field(default_factory=dict)
    versions: Mapping[str, int] = field(default_factory=dict)

    def _versioned(self, name: str) -> str:
        return f"{name}__v{self.versions[name]}" if self.replayed(name) else name

    def replayed(self, name: str) -> bool:
        return self.versions.get(name, 0) > 0

    def table(self, name: str) -> str:
        return self.at.get(name, f"{self.root}/tables/{self._versioned(name)}")

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{self._versioned(name)}"


# Partition column of a replayed layer's table: rows made again by the replay, which the layers below have had.
REPLAYED = "replayed"


def source_ready(spark: SparkSession, layout: TableLayout, spec: LayerSpec) -> bool:
    """True when the layer can start: its source table exists and, when it
    is partitioned, its partition column can be discovered from the files."""
    path = layout.table(spec.source)
    needed = {spec.source_partitioned_by} - {None} | ({REPLAYED} if layout.replayed(spec.source) else set())
    if not needed:
        return table_available(spark, path, spec.source_schema, layout.fmt)
    try:
        return needed <= set(spark.read.format(layout.fmt).load(path).columns)
    except AnalysisException:  # no table, or no data files yet to infer from
        return False


def wait_for_source(
    spark: SparkSession, layout: TableLayout, spec: LayerSpec, timeout_s: float = 300.0, poll_s: float = 1.0
) -> None:
    """Block until ``source_ready``; raise ``SourceNotReady`` after the timeout."""
    deadline = time.monotonic() + timeout_s
    while not source_ready(spark, layout, spec):
        if time.monotonic() > deadline:
            raise SourceNotReady(f"{spec.name}: source not ready: {layout.table(spec.source)}")
        time.sleep(poll_s)


def start_layer(
    spark: SparkSession,
    layout: TableLayout,
    spec: LayerSpec,
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
    known_ready: bool = False,
    replay: bool = False,
) -> StreamingQuery:
    """Start one layer's streaming query and return its handle.  Raises
    ``SourceNotReady`` instead of starting on a source it would misread
    (``known_ready``: the caller has just looked), and ``ContractError`` if
    the transform breaks the layer's output contract.  Of a source that was
    replayed it reads what is new; ``replay`` (for ``replay_layer``) reads all
    and marks its own rows as made again."""
    if not known_ready and not source_ready(spark, layout, spec):
        raise SourceNotReady(f"{spec.name}: source not ready: {layout.table(spec.source)}")
    stream = read_layer(
        spark,
        layout.table(spec.source),
        StructType([*spec.source_schema.fields, StructField(REPLAYED, BooleanType())]) if layout.replayed(spec.source) else spec.source_schema,
        layout.fmt,
        max_files_per_trigger=max_files_per_trigger,
    )
    if layout.replayed(spec.source):  # folders that the scan leaves out
        stream = (stream if replay else stream.where(~F.col(REPLAYED))).drop(REPLAYED)
    out = spec.transform(stream)
    if spec.output_schema is not None:
        assert_contract(out, spec.output_schema)
    if counted := spec.counts():
        out = out.observe(spec.name, *[c.alias(name) for name, c in counted.items()])
    partition_by = [spec.partition_by] if spec.partition_by else []
    if layout.replayed(spec.name):
        out, partition_by = out.withColumn(REPLAYED, F.lit(replay)), [REPLAYED, *partition_by]
    return write_layer(
        out,
        layout.table(spec.name),
        layout.checkpoint(spec.name),
        trigger_interval=None if available_now else spec.trigger_interval,
        partition_by=partition_by,
        fmt=layout.fmt,
        available_now=available_now,
        query_name=None,
    )


def start_all(
    spark: SparkSession,
    layout: TableLayout,
    specs: Iterable[LayerSpec],
    timeout_s: float = 300.0,
) -> dict[str, StreamingQuery]:
    """Start every layer as its own continuously running query, upstream
    first.  Each layer starts only once its source is ready (exists; holds a
    partition when partitioned), so no job fails on a path its upstream has
    not created yet or misreads a partition column; the file source then
    reads the upstream's sink log (committed files only).  Returns the
    handles by layer name; the caller waits on or stops them."""
    handles: dict[str, StreamingQuery] = {}
    try:
        for spec in specs:
            wait_for_source(spark, layout, spec, timeout_s)
            handles[spec.name] = start_layer(spark, layout, spec, known_ready=True)
    except Exception:
        for query in handles.values():
            query.stop()
        raise
    return handles


def supervise(
    spark: SparkSession,
    layout: TableLayout,
    specs: Iterable[LayerSpec],
    stop: threading.Event,
    first_wait_s: float = 1.0,
    longest_wait_s: float = 300.0,
    poll_s: float = 1.0,
    log: ProgressLog | None = None,
) -> dict[str, int]:
    """Keep every layer running until ``stop`` is set; returns how often each
    was restarted.  A layer whose source isn't there yet is looked at again; one
    that fails, at its start or later, is started again from its checkpoint
    after a pause that doubles with each failure in a row (a committed batch
    ends the row).  The others run on meanwhile."""
    by_name = {spec.name: spec for spec in specs}
    running: dict[str, StreamingQuery] = {}
    in_a_row, restarts, due = dict.fromkeys(by_name, 0), dict.fromkeys(by_name, 0), dict.fromkeys(by_name, 0.0)

    def failed(name: str, why: object) -> None:
        pause = min(longest_wait_s, first_wait_s * 2 ** in_a_row[name])
        in_a_row[name], restarts[name], due[name] = in_a_row[name] + 1, restarts[name] + 1, time.monotonic() + pause
        logger.error("layer %s failed (started again in %.1f s): %s", name, pause, why)

    try:
        while not stop.is_set():
            for name, spec in by_name.items():
                query = running.get(name)
                if query is not None and query.isActive:
                    if query.lastProgress is not None:
                        in_a_row[name] = 0
                elif query is not None:
                    del running[name]
                    if log is not None:
                        log.settle(spark, query, name)
                    failed(name, query.exception())
                elif time.monotonic() >= due[name]:
                    try:
                        if source_ready(spark, layout, spec):
                            running[name] = start_layer(spark, layout, spec, known_ready=True)
                    except Exception as err:
                        failed(name, err)
            spark.streams.resetTerminated()
            try:
                spark.streams.awaitAnyTermination(poll_s) if running else stop.wait(poll_s)
            except StreamingQueryException:  # looked at above
                pass
            if log is not None:
                log.flush(spark)
    finally:
        for name, query in running.items():
            query.stop()
            if log is not None:
                log.settle(spark, query, name)
    return restarts


def recent_rows_dropped_as_late(query: StreamingQuery) -> int:
    """Rows the query's stateful operators dropped because their window had
    already closed, over the progress reports that Spark keeps (the last 100
    unless configured): no total of a long-running query, for which there is
    ``ticklake.streaming.progress.ProgressLog``."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for op in progress.get("stateOperators", [])
    )


def run_layers_once(
    spark: SparkSession,
    layout: TableLayout,
    specs: Iterable[LayerSpec],
    max_files_per_trigger: int | None = None,
    log: ProgressLog | None = None,
) -> list[StreamingQuery]:
    """Process everything available in each layer, upstream first, then stop
    (``availableNow``).  Re-running continues from the checkpoints.  Returns
    the finished queries (progress reports, late-row counts); ``log``, a
    registered listener, takes over what their batches report."""
    done = []
    for spec in specs:
        if not source_ready(spark, layout, spec):  # nothing to read yet
            continue
        query = start_layer(spark, layout, spec, True, max_files_per_trigger, known_ready=True)
        try:
            query.awaitTermination()
        finally:
            if log is not None:
                log.settle(spark, query, spec.name)
        if query.exception() is not None:
            raise query.exception()
        done.append(query)
    return done
