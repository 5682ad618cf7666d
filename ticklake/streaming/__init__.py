"""Structured Streaming wiring: layer runner and serving sync."""

from ticklake.streaming.layers import (
    LayerSpec,
    SourceNotReady,
    TableLayout,
    recent_rows_dropped_as_late,
    run_layers_once,
    source_ready,
    start_all,
    start_layer,
    wait_for_source,
)
from ticklake.streaming.sync import SyncSpec, serving_specs, start_sync, sync_all, sync_until_stopped

__all__ = [
    "LayerSpec",
    "SourceNotReady",
    "SyncSpec",
    "TableLayout",
    "recent_rows_dropped_as_late",
    "run_layers_once",
    "source_ready",
    "start_all",
    "start_layer",
    "start_sync",
    "serving_specs",
    "sync_all",
    "sync_until_stopped",
    "wait_for_source",
]
