"""Layer transforms: pure ``DataFrame -> DataFrame`` functions (batch or stream)."""

from ticklake.operators.envelope import (
    envelope_from_frames,
    parse_symbols,
    quarantine_frames,
    split_frames,
    stream_names,
    subscription_filter,
)
from ticklake.operators.gold import gold_liquidity, gold_spread, gold_volatility
from ticklake.operators.serving import (
    dashboard_symbols,
    insert_absent,
    liquidity_series,
    spread_series,
    sync_table,
    to_serving_contract,
    volatility_series,
)
from ticklake.operators.silver import bronze, silver_agg_trade, silver_book_ticker, silver_depth10

__all__ = [
    "bronze",
    "dashboard_symbols",
    "envelope_from_frames",
    "gold_liquidity",
    "gold_spread",
    "gold_volatility",
    "insert_absent",
    "liquidity_series",
    "parse_symbols",
    "quarantine_frames",
    "silver_agg_trade",
    "silver_book_ticker",
    "silver_depth10",
    "split_frames",
    "spread_series",
    "stream_names",
    "subscription_filter",
    "sync_table",
    "to_serving_contract",
    "volatility_series",
]
