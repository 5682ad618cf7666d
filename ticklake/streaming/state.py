"""Open windows, read from the state of a Gold layer's query.

In append mode a window reaches the Gold table only when the watermark has
passed its end; until then its aggregation buffers live in the query's state
store.  Spark's state data source reads them from the checkpoint, without the
query, as of its last committed batch.  The buffers become the Gold columns of
the windows that are still open: what the layer would emit if they closed now.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ticklake.streaming.layers import TableLayout
from ticklake.streaming.sync import GOLD_SCHEMAS


def _mean(total: str, count: str) -> Column:
    """An average, from its buffers (null over no values)."""
    return F.when(F.col(count) > 0, F.col(total) / F.col(count))


# The aggregation buffers of each Gold table, in the order of its metrics (an average holds a sum and a count, a
# standard deviation a count, a mean and the sum of squared distances, a decimal sum a value and whether it is empty).
_BUFFERS: dict[str, tuple[str, dict[str, Callable[[], Column]]]] = {
    "gold_volatility": (
        "price price_count n mean m2 volume no_volume trades",
        {
            "avg_price": lambda: _mean("price", "price_count"),
            "stddev_price": lambda: F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))),
            "total_volume": lambda: F.when(~F.col("no_volume"), F.col("volume")),
            "trade_count": lambda: F.col("trades"),
        },
    ),
    "gold_spread": (
        "spread spread_count lowest highest mid mid_count",
        {
            "avg_spread": lambda: _mean("spread", "spread_count"),
            "min_spread": lambda: F.col("lowest"),
            "max_spread": lambda: F.col("highest"),
            "avg_mid_price": lambda: _mean("mid", "mid_count"),
        },
    ),
    "gold_liquidity": ("quantity quantity_count", {"avg_depth_quantity": lambda: _mean("quantity", "quantity_count")}),
}


def open_windows(spark: SparkSession, layout: TableLayout, table: str, batch_id: int | None = None) -> DataFrame:
    """The Gold rows, so far, of the windows that the layer ``table`` holds
    open after its last committed batch (or after ``batch_id``, as far as the
    checkpoint still has its state).  One row per window and key; a window
    that the watermark has closed is in the Gold table instead."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(layout.checkpoint(table))
    names, metrics = _BUFFERS[table]
    fields = state.schema["value"].dataType.fields
    if len(fields) != len(names.split()):
        raise ValueError(f"{table}: its state holds {[f.name for f in fields]}, not {names}")
    buffers = StructType([StructField(n, f.dataType) for n, f in zip(names.split(), fields)])  # renamed by position: names repeat
    out = state.select("key.*", F.col("value").cast(buffers).alias("value")).select("*", "value.*")
    keys = {"window_start": F.col("window.start"), "window_end": F.col("window.end"), "symbol": F.col("symbol")}
    if "side" in GOLD_SCHEMAS[table].names:
        keys["side"] = F.col("side")
    columns = keys | {name: build() for name, build in metrics.items()}
    return out.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in GOLD_SCHEMAS[table].fields])
