"""Ingestion as a Spark job: raw frames -> landing records and quarantine.

Frames arrive as a stream of text lines (one JSON frame per line; in
production a socket/topic source yields the same column).  One query reads
and checks each frame once and writes one table partitioned by ``status``:
``landing`` rows are topic records, ``quarantine`` rows the rejected frames
with their reason.  Both views are reads of that table, so source and JSON
work are paid once and a frame has one receive time.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ticklake.operators.envelope import checked_frames
from ticklake.plans.medallion import LAYERS, bronze_from_records, records_of
from ticklake.schemas import BRONZE_SCHEMA, KAFKA_RECORD_SCHEMA
from ticklake.sources.kafka import decode_envelopes
from ticklake.sources.layers import read_layer, read_snapshot, write_layer
from ticklake.streaming.layers import TableLayout

LANDING, QUARANTINE = "landing", "quarantine"
FRAMES_SCHEMA = StructType([StructField("frame", StringType()), StructField("received_at", TimestampType())])
LINEAGE = ("source_file", "source_row", "source_modified")
INGESTED_SCHEMA = StructType(
    KAFKA_RECORD_SCHEMA.fields
    + [StructField(name, StringType(), True) for name in ("frame", "reason", "status")]
)


def read_frame_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of text files holding one frame per line; the receive
    time is the micro-batch time."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.col("value").alias("frame"), F.current_timestamp().alias("received_at"))


def file_lineage() -> list[Column]:
    """Where a row of a Parquet source lies and when its file was written, from
    Spark's hidden file metadata: the LINEAGE columns."""
    return [
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("source_row"),
        F.col("_metadata.file_modification_time").alias("source_modified"),
    ]


def read_frame_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of Parquet files with a frame and its receive time per
    row, as a collector drops them, with the LINEAGE of each."""
    return read_layer(spark, path, FRAMES_SCHEMA, "parquet", max_files_per_trigger).select(*FRAMES_SCHEMA.names, *file_lineage())


def _with_lineage(rows: DataFrame, accepted: Column) -> DataFrame:
    """The files of a source are its log: the file is the topic, the number in
    its name (if any) the partition, the row in it the offset, and its
    modification time the record's timestamp (of accepted frames)."""
    number = F.regexp_extract(F.element_at(F.split("source_file", "/"), -1), r"([0-9]+)", 1)
    return rows.withColumns(
        {
            "topic": F.col("source_file"),
            "partition": number.try_cast("int"),
            "offset": F.col("source_row"),
            "timestamp": F.when(accepted, F.col("source_modified")).otherwise(F.col("timestamp")),
        }
    )


def ingested_rows(frames: DataFrame, stream_type: str | None = None) -> DataFrame:
    """Frames -> rows of the ingested table, one each.  With the LINEAGE
    columns (``read_frame_files``) topic, partition, offset and timestamp say
    where the frame lies.  Otherwise, without a ``seq`` column, the landing
    offset is NULL (a broker assigns offsets on publish)."""
    lineage = LINEAGE if set(LINEAGE) <= set(frames.columns) else ()
    if "seq" not in frames.columns:
        frames = frames.withColumn("seq", F.lit(None).cast("long"))
    checked = checked_frames(frames, keep=("seq", *lineage), stream_type=stream_type)
    rows = records_of(checked, keep=("raw_payload", "reason", *lineage))
    accepted = F.col("reason").isNull()
    if lineage:
        rows = _with_lineage(rows, accepted)
    return rows.select(
        F.when(accepted, F.col("key")).alias("key"),
        F.when(accepted, F.col("value")).alias("value"),
        "topic",
        F.when(accepted, F.col("partition")).alias("partition"),
        "offset",
        "timestamp",
        "timestampType",
        F.when(~accepted, F.col("raw_payload")).alias("frame"),
        "reason",
        F.when(accepted, LANDING).otherwise(QUARANTINE).alias("status"),
    )


def start_ingestion(
    frames: DataFrame,
    layout: TableLayout,
    available_now: bool = False,
    trigger_interval: str = "5 seconds",
    stream_type: str | None = None,
) -> StreamingQuery:
    """Start frames -> the ``ingested`` table; returns the running query."""
    return write_layer(
        ingested_rows(frames, stream_type),
        layout.table("ingested"),
        layout.checkpoint("ingested"),
        trigger_interval=None if available_now else trigger_interval,
        partition_by="status",
        fmt=layout.fmt,
        available_now=available_now,
    )


def landing_of(ingested: DataFrame) -> DataFrame:
    """The topic records of the ingested table (a partition filter)."""
    return ingested.filter(F.col("status") == LANDING).select(*KAFKA_RECORD_SCHEMA.fieldNames())


def quarantine_of(ingested: DataFrame) -> DataFrame:
    """The rejected frames of the ingested table (a partition filter)."""
    return ingested.filter(F.col("status") == QUARANTINE).select(F.col("timestamp").alias("received_at"), "frame", "reason")


def read_ingested(spark: SparkSession, layout: TableLayout) -> DataFrame:
    return read_snapshot(spark, layout.table("ingested"), INGESTED_SCHEMA, layout.fmt)


# Bronze behind the ingestion job instead of a topic.
BRONZE_FROM_INGESTED = replace(
    LAYERS["bronze"],
    source="ingested",
    source_schema=INGESTED_SCHEMA,
    source_partitioned_by="status",
    transform=lambda ingested: bronze_from_records(landing_of(ingested)),
)

# The same with the frame's file beside partition (its number), offset (row in it) and kafka_timestamp (its modification).
BRONZE_LINEAGE_SCHEMA = StructType([*BRONZE_SCHEMA.fields, StructField("source_file", StringType())])
BRONZE_WITH_LINEAGE = replace(
    BRONZE_FROM_INGESTED,
    transform=lambda ingested: decode_envelopes(landing_of(ingested), keep={"topic": "source_file"}),
    output_schema=BRONZE_LINEAGE_SCHEMA,
)
