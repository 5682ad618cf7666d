"""What batches report, kept for good.

Spark keeps the last progress reports of a running query and forgets them when
it ends.  ``ProgressLog`` listens to all queries of a session and writes what
each batch reported to a table: rows read, rows dropped as late and observed
metrics.  A batch is known by the query's id, which its checkpoint keeps over
restarts, and its batch id; if it is run again after a failure it reports
again, and totals count it once.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ticklake.sources.layers import try_read_snapshot

BATCHES_SCHEMA = StructType(
    [
        StructField("layer", StringType()),
        StructField("query_id", StringType()),
        StructField("batch_id", LongType()),
        StructField("reported_at", TimestampType()),
        StructField("rows_read", LongType()),
        StructField("rows_dropped", LongType()),
        StructField("observed", StringType()),  # JSON: {name: {metric: value}}
    ]
)


class ProgressLog(StreamingQueryListener):
    """Register with ``spark.streams.addListener``.  Reports wait on the driver
    (one small row a batch) until ``settle`` or ``flush`` appends them."""

    def __init__(self, path: str):
        self.path = path
        self._layer: dict[str, str] = {}  # of each query id
        self._pending: dict[tuple[str, int], tuple] = {}
        self._ended: set[str] = set()  # run ids
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in report.stateOperators)
        observed = {name: row.asDict() for name, row in report.observedMetrics.items()}
        with self._changed:
            self._pending[str(report.id), report.batchId] = (report.timestamp, report.numInputRows, dropped, json.dumps(observed, default=str))

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def name(self, query: StreamingQuery, layer: str) -> None:
        """Rows of this query are written under a layer's name."""
        with self._changed:
            self._layer[str(query.id)] = layer

    def settle(self, spark: SparkSession, query: StreamingQuery, layer: str, timeout_s: float = 60.0) -> None:
        """Wait until all reports of an ended query are here (the listener is
        told of the end after them) and write them."""
        self.name(query, layer)
        deadline = time.monotonic() + timeout_s
        with self._changed:
            while str(query.runId) not in self._ended and time.monotonic() < deadline:
                self._changed.wait(max(0.0, min(1.0, deadline - time.monotonic())))
        self.flush(spark)

    def flush(self, spark: SparkSession) -> None:
        """Append the reports that wait; call it now and then for queries that
        run on.  What can't be written goes on waiting."""
        with self._changed:
            taken = dict(self._pending)
        if not taken:
            return
        rows = [(self._layer.get(query), query, batch, *values) for (query, batch), values in taken.items()]
        text = ", ".join("reported_at string" if f.name == "reported_at" else f"{f.name} {f.dataType.simpleString()}" for f in BATCHES_SCHEMA)
        df = spark.createDataFrame(rows, text).withColumn("reported_at", F.col("reported_at").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(self.path)
        with self._changed:
            for key, values in taken.items():
                if self._pending.get(key) == values:
                    del self._pending[key]


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The last report of each batch."""
    found = try_read_snapshot(spark, path, BATCHES_SCHEMA)
    if found is None:
        return spark.createDataFrame([], BATCHES_SCHEMA)
    last = F.max(F.struct("reported_at", "layer", "rows_read", "rows_dropped", "observed")).alias("last")
    return found.groupBy("query_id", "batch_id").agg(last).select("last.layer", "query_id", "batch_id", "last.reported_at", "last.rows_read", "last.rows_dropped", "last.observed")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Batches, rows read and rows dropped as late, by layer.  A stateful
    operator counts what reaches it: of an aggregation the partly aggregated
    rows, one for each window and key in a batch."""
    return batches(spark, path).groupBy("layer").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows_read").alias("rows_read"), F.sum("rows_dropped").alias("rows_dropped")
    )


def observed_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts that layers observe (``LayerSpec.counts`` and others), added
    up over all batches: one row (layer, observed, name, total) each."""
    counts = F.from_json("observed", "map<string, map<string, bigint>>")
    rows = batches(spark, path).select("layer", F.explode(counts).alias("observed", "of"))
    return rows.select("layer", "observed", F.explode("of").alias("name", "n")).groupBy("layer", "observed", "name").agg(F.sum("n").alias("total"))
