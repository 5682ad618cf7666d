"""Gold layer: event-time windowed risk metrics.

Each metric is a tumbling-window aggregation keyed by ``(window, symbol)``
(plus ``side`` for liquidity) with a watermark.  In a stream (append mode)
a window's row is emitted once, when the watermark passes its end; rows
whose window already closed are dropped as late.  On batch input the
watermark is a no-op and every window is returned.

Scale: every aggregate is algebraic (sum / count / min / max / central
moments), so Spark aggregates partially before the shuffle.  A hot symbol
therefore ships at most one partial row per (window, symbol) per map task,
whatever its share of the trades: no salting needed.

Types stay exact and wide here (``avg`` of decimal(20,8) is decimal(24,12));
``ticklake.operators.serving.to_serving_contract`` narrows at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ticklake.functions.parsing import instant_from_utc_wall_clock
from ticklake.schemas import WATERMARK_DELAY, WINDOW_DURATION


def _windowed(
    df: DataFrame,
    time_col: str,
    keys: list[str],
    metrics: dict[str, Column],
    window_duration: str,
    watermark_delay: str | None,
) -> DataFrame:
    if isinstance(df.schema[time_col].dataType, TimestampNTZType):
        # A watermark needs an instant; read wall-clock time as UTC.
        df = df.withColumn(time_col, instant_from_utc_wall_clock(time_col))
    if watermark_delay is not None:
        df = df.withWatermark(time_col, watermark_delay)
    out = df.groupBy(F.window(time_col, window_duration).alias("window"), *keys).agg(
        *[expr.alias(name) for name, expr in metrics.items()]
    )
    return out.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        *metrics,
    )


def gold_volatility(
    trades: DataFrame,
    time_col: str = "trade_timestamp",
    window_duration: str = WINDOW_DURATION,
    watermark_delay: str | None = WATERMARK_DELAY,
) -> DataFrame:
    """Per (5-minute window, symbol): mean price, sample standard deviation
    of the price level (NULL for a single trade), total quantity and the
    number of aggregate trades.  Event time is the exchange trade time."""
    return _windowed(
        trades,
        time_col,
        ["symbol"],
        {
            "avg_price": F.avg("price"),
            "stddev_price": F.stddev_samp("price"),
            "total_volume": F.sum("quantity"),
            "trade_count": F.count("symbol"),
        },
        window_duration,
        watermark_delay,
    )


def gold_spread(
    quotes: DataFrame,
    time_col: str = "ingestion_timestamp",
    window_duration: str = WINDOW_DURATION,
    watermark_delay: str | None = WATERMARK_DELAY,
) -> DataFrame:
    """Per (5-minute window, symbol): mean, min and max bid-ask spread
    (ask - bid, may be negative on a crossed book) and mean mid price.
    Row-weighted; event time is the ingestion time (quotes carry none)."""
    with_spread = quotes.select(
        time_col,
        "symbol",
        (F.col("best_ask_price") - F.col("best_bid_price")).alias("spread"),
        ((F.col("best_bid_price") + F.col("best_ask_price")) / 2).alias("mid_price"),
    )
    return _windowed(
        with_spread,
        time_col,
        ["symbol"],
        {
            "avg_spread": F.avg("spread"),
            "min_spread": F.min("spread"),
            "max_spread": F.max("spread"),
            "avg_mid_price": F.avg("mid_price"),
        },
        window_duration,
        watermark_delay,
    )


def gold_liquidity(
    levels: DataFrame,
    time_col: str = "ingestion_timestamp",
    window_duration: str = WINDOW_DURATION,
    watermark_delay: str | None = WATERMARK_DELAY,
) -> DataFrame:
    """Per (5-minute window, symbol, side): mean quantity over all book
    levels of all snapshots in the window (``level`` is not a key)."""
    return _windowed(
        levels,
        time_col,
        ["symbol", "side"],
        {"avg_depth_quantity": F.avg("quantity")},
        window_duration,
        watermark_delay,
    )
