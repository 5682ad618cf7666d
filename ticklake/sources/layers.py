"""Layer tables: streaming and static scans, the availability probe and the
streaming append sink.

``fmt`` is ``"parquet"`` by default; pass ``"delta"`` when the Delta jar is
on the classpath.  Parquet streams need an explicit schema (a streaming
file source never infers one), which is also what keeps a layer readable
while it is still empty.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

DEFAULT_FORMAT = "parquet"


def read_layer(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    fmt: str = DEFAULT_FORMAT,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming scan of a layer table.

    A streaming file source fixes its partition columns when it starts, from
    the files present then: start it on a partitioned table only once the
    table holds a partition (``ticklake.streaming.layers.source_ready``), or
    the partition column reads as NULL."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_snapshot(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """Static scan of a layer table (filters and projections applied later
    are pushed into the scan)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def try_read_snapshot(
    spark: SparkSession, path: str, schema: StructType, fmt: str = DEFAULT_FORMAT
) -> DataFrame | None:
    """``read_snapshot`` with an explicit schema, or None while the path does
    not exist: the table is resolved (listed) once for both questions."""
    try:
        return read_snapshot(spark, path, schema, fmt)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def table_available(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = DEFAULT_FORMAT
) -> bool:
    """True when the table can be read; False when its path does not exist
    yet.  An existing but empty table counts as available.  Any other error
    propagates."""
    try:
        read_snapshot(spark, path, schema, fmt).schema  # resolves the relation
    except AnalysisException as err:
        condition = err.getCondition()
        if condition == "PATH_NOT_FOUND":
            return False
        if condition == "UNABLE_TO_INFER_SCHEMA":  # exists, no data files yet
            return True
        raise
    return True


def write_layer(
    df: DataFrame,
    path: str,
    checkpoint_path: str,
    trigger_interval: str | None = None,
    partition_by: str | list[str] | None = None,
    fmt: str = DEFAULT_FORMAT,
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start an append-mode streaming write of ``df`` into a layer table.

    One checkpoint per query gives exactly-once file output and restart
    from the last committed batch.  ``partition_by`` (e.g. ``stream_type`` on
    Bronze) turns a downstream equality filter into partition pruning.
    ``available_now`` processes what is there and stops (tests, backfills);
    otherwise ``trigger_interval`` sets a processing-time trigger.
    Returns the running query; the caller waits on it.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_interval is not None:
        writer = writer.trigger(processingTime=trigger_interval)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if query_name is not None:
        writer = writer.queryName(query_name)
    return writer.start(path)
