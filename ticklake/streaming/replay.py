"""Reset one layer and replay it from the one above.

A replay makes a layer's table again, in a new version with a checkpoint of its
own, and then switches to it at once by a pointer; until then, and if it fails,
the old version counts.  The layers below keep their tables, state and
checkpoints: they have had the rows that the replay makes again, so these lie in
partitions of their own (``replayed=true``), which those layers leave out, and
they go on with the rows that are made after the switch.

For that, the new version must have made again what the layers below have read
of the old one, no more and no less.  The old version and the layers below are
caught up first, and the switch is made only if both versions' checkpoints list
the same files of the source.  If the source has grown in between, both go on
until they do.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ticklake.sources.layers import read_snapshot, try_read_snapshot
from ticklake.streaming.layers import LayerSpec, SourceNotReady, TableLayout, run_layers_once, source_ready, start_layer

# Formats whose streaming source logs the files it has read.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text")

_POINTER_SCHEMA = StructType([StructField("version", LongType())])
_LOG_SCHEMA = StructType([StructField("value", StringType())])


class ReplayError(RuntimeError):
    """The new version could not be brought level with the old one, which
    still counts."""


def _pointer(layout: TableLayout, name: str) -> str:
    return f"{layout.root}/versions/{name}"


def at_current_versions(spark: SparkSession, layout: TableLayout, names: Iterable[str]) -> TableLayout:
    """The layout with the version that counts of each named layer."""
    versions = dict(layout.versions)
    for name in names:
        pointer = try_read_snapshot(spark, _pointer(layout, name), _POINTER_SCHEMA)
        versions[name] = (pointer.agg(F.max("version")).first()[0] if pointer is not None else None) or 0
    return replace(layout, versions=versions)


def _switch(spark: SparkSession, layout: TableLayout, name: str) -> None:
    """One row, in one file, so the pointer is the old one or the new."""
    version = layout.versions[name]
    spark.range(version, version + 1, 1, 1).select(F.col("id").alias("version")).write.mode("append").parquet(_pointer(layout, name))


def files_read(spark: SparkSession, layout: TableLayout, spec: LayerSpec) -> DataFrame:
    """Paths of the source's files that the layer's checkpoint lists as read."""
    log = try_read_snapshot(spark, f"{layout.checkpoint(spec.name)}/sources/0", _LOG_SCHEMA, "text")
    if log is None:  # no batch yet
        return spark.createDataFrame([], "path string")
    return log.select(F.get_json_object("value", "$.path").alias("path")).where("path is not null").distinct()


def _level(spark: SparkSession, old: TableLayout, new: TableLayout, spec: LayerSpec) -> bool:
    """Whether both versions have read the same files of the source's version
    that counts (the old one has read those of versions before it, too)."""
    source = old.table(spec.source).split(":", 1)[-1].lstrip("/") + "/"
    was, now = files_read(spark, old, spec).where(F.col("path").contains(source)), files_read(spark, new, spec)
    return was.exceptAll(now).isEmpty() and now.exceptAll(was).isEmpty()


def replay_layer(
    spark: SparkSession, layout: TableLayout, spec: LayerSpec, below: Iterable[LayerSpec], attempts: int = 5
) -> TableLayout:
    """Replay the layer ``spec`` into a new version and switch to it; returns
    the layout to go on with (other jobs get it from ``at_current_versions``).

    ``below`` are the layers that read this one (and those below them, if they
    should be caught up too).  Neither they nor the layer may be running;
    layers above may.  Raises ``SourceNotReady`` if the layer has never run or
    its source isn't there, and ``ReplayError`` if the source grows faster than
    the versions level within ``attempts``; nothing is switched then, and the
    next replay begins anew.  A layer with state starts with none: rows that
    came late for it are then in time.  Old versions stay until they are removed
    by hand."""
    if layout.fmt not in FILE_FORMATS:
        raise ValueError(f"{layout.fmt}: only file tables keep a log of the files read")
    below = list(below)
    old = at_current_versions(spark, layout, [spec.name, spec.source, *[s.name for s in below]])
    if not source_ready(spark, old, spec):
        raise SourceNotReady(f"{spec.name}: source not ready: {old.table(spec.source)}")
    new = replace(old, versions={**old.versions, spec.name: _unused(spark, old, spec.name)})
    for _ in range(attempts):
        run_layers_once(spark, old, [spec, *below])
        query = start_layer(spark, new, spec, available_now=True, known_ready=True, replay=True)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        if _level(spark, old, new, spec):
            _switch(spark, new, spec.name)
            return new
    raise ReplayError(f"{spec.name}: {old.table(spec.source)} grows faster than it is replayed")


def _unused(spark: SparkSession, layout: TableLayout, name: str) -> int:
    """The first version after the current one that nothing has been written
    to: a replay that failed leaves its files."""
    version = layout.versions[name] + 1
    while try_read_snapshot(spark, replace(layout, versions={name: version}).table(name), _POINTER_SCHEMA, layout.fmt) is not None:
        version += 1
    return version


def read_version(spark: SparkSession, layout: TableLayout, name: str, schema: StructType) -> DataFrame:
    """All rows of a layer's version, replayed and new ones."""
    return read_snapshot(spark, layout.table(name), schema, layout.fmt).select(*schema.names)
