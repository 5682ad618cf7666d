from datetime import datetime
from decimal import Decimal

from ticklake.operators.gold import gold_volatility
from ticklake.schemas import SILVER_AGG_TRADE_SCHEMA, GOLD_VOLATILITY_SCHEMA
from ticklake.sources.layers import read_snapshot
from ticklake.streaming.layers import TableLayout, LayerSpec, recent_rows_dropped_as_late, run_layers_once

GOLD = LayerSpec("gold_volatility", "silver_agg_trade", SILVER_AGG_TRADE_SCHEMA, gold_volatility)


def trade_rows(spark, times):
    rows = [
        ("S", None, "aggTrade", None, i, Decimal("1"), Decimal("1"), i, i, datetime(2026, 1, 1, *t), True, True)
        for i, t in enumerate(times)
    ]
    return spark.createDataFrame(rows, SILVER_AGG_TRADE_SCHEMA)


def windows(spark, layout):
    out = read_snapshot(spark, layout.table("gold_volatility"), GOLD_VOLATILITY_SCHEMA)
    return sorted((r.window_start.strftime("%H:%M"), r.trade_count) for r in out.collect())


def test_watermark_late_data_scenario(spark, scratch):
    """5-minute windows, 10-minute watermark, one input per micro-batch."""
    layout = TableLayout(scratch("late"))
    batches = [[(10, 1), (10, 6)], [(10, 16)], [(10, 2), (10, 7), (10, 20)], [(11, 0)]]
    seen, dropped = [], []
    for b in batches:
        trade_rows(spark, b).write.mode("append").parquet(layout.table("silver_agg_trade"))
        (query,) = run_layers_once(spark, layout, [GOLD])
        seen.append(windows(spark, layout))
        dropped.append(recent_rows_dropped_as_late(query))
    assert dropped == [0, 0, 1, 0]
    assert seen[0] == []
    assert seen[1] == [("10:00", 1)]
    assert seen[2] == [("10:00", 1), ("10:05", 2)]  # 10:02 dropped, late 10:07 accepted
    assert seen[3] == [("10:00", 1), ("10:05", 2), ("10:15", 1), ("10:20", 1)]  # 11:00 still open


def test_batch_over_same_rows_returns_every_window(spark):
    rows = [(10, 1), (10, 6), (10, 16), (10, 2), (10, 7), (10, 20), (11, 0)]
    got = sorted((r.window_start.strftime("%H:%M"), r.trade_count) for r in gold_volatility(trade_rows(spark, rows)).collect())
    assert got == [("10:00", 2), ("10:05", 2), ("10:15", 1), ("10:20", 1), ("11:00", 1)]


def test_restart_from_checkpoint_adds_no_duplicates(spark, scratch):
    layout = TableLayout(scratch("restart"))
    trade_rows(spark, [(10, 1), (10, 30)]).write.parquet(layout.table("silver_agg_trade"))
    run_layers_once(spark, layout, [GOLD])
    first = windows(spark, layout)
    run_layers_once(spark, layout, [GOLD])  # nothing new: no rows added
    assert windows(spark, layout) == first == [("10:00", 1)]


def test_stream_equals_batch_minus_open_windows(spark, scratch):
    from ticklake.plans.catalog import _q_gold_stream, _gold, _silver_for

    sf = "/root/testdata/sf0.001"
    stream = _q_gold_stream("gold_volatility")(spark, sf)
    batch = _gold("gold_volatility", _silver_for("gold_volatility", spark, sf))
    from ticklake.functions.parsing import utc_wall_clock

    batch = batch.withColumn("window_start", utc_wall_clock("window_start")).withColumn("window_end", utc_wall_clock("window_end"))
    s, b = stream.count(), batch.count()
    assert 0 < s < b
    # every streamed window is final and equal to the batch row
    assert stream.exceptAll(batch.select(*stream.columns)).count() == 0
    assert b - s <= 2  # the last windows are still open


def test_processing_time_trigger_runs_until_stopped(spark, scratch):
    from dataclasses import replace

    from ticklake.streaming.layers import start_layer

    layout = TableLayout(scratch("ptime"))
    trade_rows(spark, [(10, 1), (10, 30)]).write.parquet(layout.table("silver_agg_trade"))
    query = start_layer(spark, layout, replace(GOLD, trigger_interval="1 second"))
    try:
        query.processAllAvailable()
        assert query.isActive
        trade_rows(spark, [(10, 45)]).write.mode("append").parquet(layout.table("silver_agg_trade"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert windows(spark, layout) == [("10:00", 1), ("10:30", 1)]


def test_start_all_runs_the_whole_stack_concurrently(spark, scratch):
    import time
    from dataclasses import replace

    from ticklake.plans.catalog import _land
    from ticklake.plans.medallion import LAYERS, chain
    from ticklake.streaming.layers import start_all

    reference = TableLayout(scratch("stack-ref"))
    _land(spark, "/root/testdata/sf0.001", reference)
    run_layers_once(spark, reference, chain("gold_volatility"))
    want = read_snapshot(spark, reference.table("gold_volatility"), GOLD_VOLATILITY_SCHEMA).count()

    layout = TableLayout(scratch("stack"))
    _land(spark, "/root/testdata/sf0.001", layout)
    specs = [replace(s, trigger_interval="1 second") for s in LAYERS.values()]
    handles = start_all(spark, layout, specs, timeout_s=120)
    try:
        assert all(q.isActive for q in handles.values()) and len(handles) == 7
        for name in LAYERS:  # upstream first: drain each layer in order
            handles[name].processAllAvailable()
        # Closed windows are emitted by the batch after the watermark moves.
        deadline = time.monotonic() + 60
        got = 0
        while time.monotonic() < deadline:
            handles["gold_volatility"].processAllAvailable()
            got = read_snapshot(spark, layout.table("gold_volatility"), GOLD_VOLATILITY_SCHEMA).count()
            if got == want:
                break
            time.sleep(1)
    finally:
        for q in handles.values():
            q.stop()
    assert got == want > 0


def test_layer_does_not_start_on_an_empty_partitioned_source(spark, scratch):
    import os

    import pytest

    from ticklake.plans.catalog import _land
    from ticklake.plans.medallion import LAYERS
    from ticklake.streaming.layers import SourceNotReady, source_ready, start_layer

    layout = TableLayout(scratch("early"))
    _land(spark, "/root/testdata/sf0.001", layout)
    os.makedirs(layout.table("bronze") + "/_spark_metadata", exist_ok=True)  # upstream started, no data yet
    silver = LAYERS["silver_agg_trade"]
    assert not source_ready(spark, layout, silver)
    with pytest.raises(SourceNotReady):
        start_layer(spark, layout, silver)
    assert run_layers_once(spark, layout, [silver]) == []  # nothing to read: skipped
    run_layers_once(spark, layout, [LAYERS["bronze"], silver])
    assert read_snapshot(spark, layout.table("silver_agg_trade")).count() == 1000


def test_whole_chain_restart_reprocesses_nothing(spark, scratch):
    from ticklake.plans.catalog import _land
    from ticklake.plans.medallion import LAYERS
    from ticklake.schemas import BRONZE_SCHEMA, SILVER_DEPTH10_SCHEMA

    layout = TableLayout(scratch("restart-chain"))
    _land(spark, "/root/testdata/sf0.001", layout)
    specs = list(LAYERS.values())

    def counts():
        return (
            read_snapshot(spark, layout.table("bronze"), BRONZE_SCHEMA).count(),
            read_snapshot(spark, layout.table("silver_depth10"), SILVER_DEPTH10_SCHEMA).count(),
            read_snapshot(spark, layout.table("gold_volatility"), GOLD_VOLATILITY_SCHEMA).count(),
        )

    run_layers_once(spark, layout, specs)
    first = counts()
    run_layers_once(spark, layout, specs)  # restart every layer from its checkpoint
    assert counts() == first
    # new data arrives: only it flows through (the landing gets a second copy)
    from ticklake.plans.medallion import landing_records
    from ticklake.plans.testdata import market_frames

    landing_records(market_frames(spark, "/root/testdata/sf0.001")).write.mode("append").parquet(layout.table("landing"))
    run_layers_once(spark, layout, specs)
    bronze, depth, _ = counts()
    assert (bronze, depth) == (2 * first[0], 2 * first[1])
