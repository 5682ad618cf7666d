"""One layer is reset and replayed; those below keep their checkpoints."""

import os
from datetime import datetime
from decimal import Decimal

import pytest

from ticklake.operators.gold import gold_volatility
from ticklake.schemas import GOLD_VOLATILITY_SCHEMA, SILVER_AGG_TRADE_SCHEMA
from ticklake.sources.layers import read_snapshot
from ticklake.streaming import replay
from ticklake.streaming.layers import LayerSpec, SourceNotReady, TableLayout, run_layers_once
from ticklake.streaming.replay import ReplayError, at_current_versions, files_read, read_version, replay_layer

SILVER = LayerSpec("silver", "above", SILVER_AGG_TRADE_SCHEMA, lambda df: df, output_schema=SILVER_AGG_TRADE_SCHEMA)
GOLD = LayerSpec("gold", "silver", SILVER_AGG_TRADE_SCHEMA, gold_volatility)


def arrive(spark, layout, *times):
    rows = [
        ("S", None, "aggTrade", None, i, Decimal("1"), Decimal("1"), i, i, datetime(2026, 1, 1, *t), True, True)
        for i, t in enumerate(times)
    ]
    spark.createDataFrame(rows, SILVER_AGG_TRADE_SCHEMA).coalesce(1).write.mode("append").parquet(layout.table("above"))


def windows(spark, layout):
    out = read_snapshot(spark, layout.table("gold"), GOLD_VOLATILITY_SCHEMA)
    return sorted((r.window_start.strftime("%H:%M"), r.trade_count) for r in out.collect())


def started(spark, scratch):
    layout = TableLayout(scratch("replay"))
    arrive(spark, layout, (10, 1), (10, 2), (10, 16), (10, 17))  # 10:15 stays open
    run_layers_once(spark, layout, [SILVER, GOLD])
    return layout


@pytest.mark.parametrize("replays", [1, 2])
def test_gold_goes_on_with_its_state(spark, scratch, replays):
    first = layout = started(spark, scratch)
    for _ in range(replays):
        layout = replay_layer(spark, layout, SILVER, [GOLD])
    assert layout.versions["silver"] == replays and layout.checkpoint("gold") == first.checkpoint("gold")
    assert at_current_versions(spark, first, ["silver", "gold"]).versions == {"silver": replays, "gold": 0}
    arrive(spark, layout, (10, 18), (11, 0))
    run_layers_once(spark, layout, [SILVER, GOLD])
    run_layers_once(spark, layout, [SILVER, GOLD])
    assert windows(spark, layout) == [("10:00", 2), ("10:15", 3)]  # replayed rows count once
    assert read_version(spark, layout, "silver", SILVER_AGG_TRADE_SCHEMA).count() == 6
    assert read_snapshot(spark, first.table("silver"), SILVER_AGG_TRADE_SCHEMA).count() == 4  # the old version stays


def test_without_the_mark_they_would_count_twice(spark, scratch, monkeypatch):
    layout = started(spark, scratch)
    start = replay.start_layer
    monkeypatch.setattr(replay, "start_layer", lambda *a, **kw: start(*a, **{**kw, "replay": False}))
    layout = replay_layer(spark, layout, SILVER, [GOLD])
    arrive(spark, layout, (11, 0))
    run_layers_once(spark, layout, [SILVER, GOLD])
    assert ("10:15", 4) in windows(spark, layout)


def test_layer_above_replayed_then_this_one(spark, scratch):
    layout = started(spark, scratch)
    top = LayerSpec("above", "feed", SILVER_AGG_TRADE_SCHEMA, lambda df: df)
    layout = TableLayout(scratch("two"))
    feed = TableLayout(layout.root, at={"above": layout.table("feed")})
    arrive(spark, feed, (10, 1), (10, 16))
    run_layers_once(spark, layout, [top, SILVER, GOLD])
    layout = replay_layer(spark, layout, top, [SILVER, GOLD])
    arrive(spark, feed, (10, 17))
    run_layers_once(spark, layout, [top, SILVER, GOLD])
    layout = replay_layer(spark, layout, SILVER, [GOLD])
    arrive(spark, feed, (11, 0))
    run_layers_once(spark, layout, [top, SILVER, GOLD])
    assert layout.versions == {"feed": 0, "above": 1, "silver": 1, "gold": 0}
    assert windows(spark, layout) == [("10:00", 1), ("10:15", 2)]
    assert read_version(spark, layout, "silver", SILVER_AGG_TRADE_SCHEMA).count() == 4


def test_source_that_grows_meanwhile(spark, scratch, monkeypatch):
    layout = started(spark, scratch)
    run, more = replay.run_layers_once, [1, 2]

    def grows(*args):
        done = run(*args)
        if more:  # after the old version has caught up, before the new one starts
            arrive(spark, layout, (10, 17 + more.pop()))
        return done

    monkeypatch.setattr(replay, "run_layers_once", grows)
    now = replay_layer(spark, layout, SILVER, [GOLD])
    assert files_read(spark, layout, SILVER).count() == files_read(spark, now, SILVER).count() == 3
    arrive(spark, now, (11, 0))
    run_layers_once(spark, now, [SILVER, GOLD])
    assert windows(spark, now) == [("10:00", 2), ("10:15", 4)]

    more.extend(range(1, 30))
    with pytest.raises(ReplayError):
        replay_layer(spark, now, SILVER, [GOLD], attempts=2)
    assert at_current_versions(spark, layout, ["silver"]).versions["silver"] == 1  # nothing is switched
    more.clear()
    assert replay_layer(spark, now, SILVER, [GOLD]).versions["silver"] == 3  # begins anew


def test_serving_sync_of_a_replayed_gold_table(spark, scratch):
    from ticklake.operators.serving import read_serving
    from ticklake.plans.medallion import LAYERS
    from ticklake.streaming.sync import serving_specs, sync_all

    gold = LAYERS["gold_volatility"]
    layout = TableLayout(scratch("served"))
    trades = TableLayout(layout.root, at={"above": layout.table(gold.source)})
    served = []
    for times in ([(10, 1), (10, 2), (10, 40)], [(10, 41), (11, 30)]):
        arrive(spark, trades, *times)
        run_layers_once(spark, layout, [gold])
        if not served:
            layout = replay_layer(spark, layout, gold, [])
        (spec,) = [s for s in serving_specs(layout) if s.table == gold.name]
        query = sync_all(spark, [spec], available_now=True)[gold.name]
        assert query is not None and query.exception() is None
        rows = read_serving(spark, spec.target_path, gold.name).collect()
        served.append(sorted((r.window_start.strftime("%H:%M"), r.trade_count) for r in rows))
    assert served == [[("10:00", 2)], [("10:00", 2), ("10:40", 2)]]


def test_nothing_to_replay(spark, scratch):
    with pytest.raises(SourceNotReady):
        replay_layer(spark, TableLayout(scratch("none")), SILVER, [GOLD])
    with pytest.raises(ValueError):
        replay_layer(spark, TableLayout(scratch("none"), "delta"), SILVER, [GOLD])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_replayed_query_has_open_windows_at_the_reset(spark):
    from ticklake.plans.catalog import RESET_AT, _gold, _silver_for

    gold = _gold("gold_volatility", _silver_for("gold_volatility", spark, "/root/testdata/sf0.01"))
    at = RESET_AT.isoformat(sep=" ")
    assert gold.where(f"window_start < '{at}' and window_end > timestamp '{at}' - interval 15 minutes").count() > 0
