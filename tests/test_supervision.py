"""Layers that fail and are started again, counts of the Silver layers, and the
Gold layers on another state store."""

import threading
import time
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ticklake.plans.medallion import LAYERS
from ticklake.schemas import BRONZE_SCHEMA
from ticklake.sources.layers import read_snapshot
from ticklake.streaming.layers import TableLayout, run_layers_once, supervise
from ticklake.streaming.progress import ProgressLog, observed_counts
from ticklake.streaming.state import open_windows
from ticklake.streaming.sync import GOLD_SCHEMAS

FRAMES = [
    ("aggTrade", '{"data":{"p":"1.5","q":"2","T":%d}}'),
    ("aggTrade", '{"data":{}}'),
    ("aggTrade", '{"data":null}'),
    ("bookTicker", '{"data":{"b":"1","a":"2"}}'),
    ("bookTicker", '{"data":"text"}'),
    ("depth10", '{"data":{"lastUpdateId":1,"bids":[["1","2"],["3"]],"asks":[["4","5"]]}}'),
    ("depth10", "{}"),
]


def add_bronze(spark, layout, first, n=20):
    start = datetime(2026, 1, 1, 10, 0)
    rows = []
    for i in range(first, first + n):
        stream_type, payload = FRAMES[i % len(FRAMES)]
        when = start.replace(hour=10 + i // 60, minute=i % 60)
        payload = payload % int((when - datetime(1970, 1, 1)).total_seconds() * 1000) if "%d" in payload else payload
        rows.append((when, f"S{i % 2}", stream_type, payload, 0, i, when))
    df = spark.createDataFrame(rows, BRONZE_SCHEMA)
    df.write.mode("append").partitionBy("stream_type").parquet(layout.table("bronze"))


def wait_for(condition, timeout_s=90):
    deadline = time.monotonic() + timeout_s
    while time.monotonic() < deadline and not condition():
        time.sleep(0.3)
    assert condition()


def test_a_layer_that_fails_is_started_again(spark, scratch):
    layout, calls, stop, restarts = TableLayout(scratch("supervised")), [], threading.Event(), {}
    good = replace(LAYERS["silver_agg_trade"], trigger_interval="1 second")

    def fails_twice(bronze):
        calls.append(time.monotonic())
        if len(calls) == 1:
            raise RuntimeError("can't start")
        out = good.transform(bronze)
        if len(calls) == 2:  # fails in its first batch
            out = out.withColumn("symbol", F.when(F.col("symbol").isNotNull(), F.raise_error(F.lit("bad batch")).cast("string")))
        return out

    log = ProgressLog(scratch("supervised_log"))
    spark.streams.addListener(log)
    add_bronze(spark, layout, 0)
    specs = [replace(good, transform=fails_twice), replace(LAYERS["silver_book_ticker"], trigger_interval="1 second"), replace(LAYERS["gold_volatility"], trigger_interval="1 second")]
    loop = threading.Thread(target=lambda: restarts.update(supervise(spark, layout, specs, stop, first_wait_s=0.5, poll_s=0.3, log=log)))
    loop.start()
    rows = lambda: sorted(map(str, read_snapshot(spark, layout.table("silver_agg_trade"), good.output_schema).collect()))

    def equal():
        try:
            return rows() == sorted(map(str, good.transform(read_snapshot(spark, layout.table("bronze"), BRONZE_SCHEMA)).collect()))
        except Exception:
            return False

    try:
        wait_for(equal)
        add_bronze(spark, layout, 20, 60)
        wait_for(equal)
    finally:
        stop.set()
        loop.join(60)
        spark.streams.removeListener(log)
    assert not loop.is_alive() and not [q for q in spark.streams.active if q.isActive]
    assert restarts["silver_agg_trade"] == 2 and restarts["silver_book_ticker"] == 0
    assert calls[2] - calls[1] > calls[1] - calls[0] - 0.5  # the second pause is longer
    totals = {(r.layer, r.name): r.total for r in observed_counts(spark, log.path).collect()}
    assert totals["silver_agg_trade", "rows"] == len(rows()) == 24  # a batch that failed counts once


def test_silver_layers_count_frames_rows_and_empty_payloads(spark, scratch):
    layout, log = TableLayout(scratch("counts")), ProgressLog(scratch("counts_log"))
    spark.streams.addListener(log)
    try:
        for first in (0, 70):  # two runs
            add_bronze(spark, layout, first, 70)
            run_layers_once(spark, layout, [s for s in LAYERS.values() if s.source == "bronze"], log=log)
    finally:
        spark.streams.removeListener(log)
    found = {(r.layer, r.name): r.total for r in observed_counts(spark, log.path).collect()}
    assert found == {
        ("silver_agg_trade", "frames"): 60, ("silver_agg_trade", "rows"): 40, ("silver_agg_trade", "empty"): 20,
        ("silver_book_ticker", "frames"): 40, ("silver_book_ticker", "rows"): 40, ("silver_book_ticker", "empty"): 20,
        ("silver_depth10", "frames"): 40, ("silver_depth10", "rows"): 60, ("silver_depth10", "empty"): 0,
    }


@pytest.mark.parametrize("table", list(GOLD_SCHEMAS))
def test_gold_on_rocksdb_with_changelogs_and_a_restart(spark, scratch, table):
    names = ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")
    rocks = ("org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "true")
    results = []
    for values in (rocks, (None, None)):
        before = [spark.conf.get(n, None) for n in names]
        for n, v in zip(names, values):
            if v is not None:
                spark.conf.set(n, v)
        try:
            layout = TableLayout(scratch(table))
            gold = LAYERS[table]
            for first in (0, 140):  # the second run starts from the state of the first
                add_bronze(spark, layout, first, 140)
                run_layers_once(spark, layout, [LAYERS[gold.source], gold])
            closed = read_snapshot(spark, layout.table(table), GOLD_SCHEMAS[table])
            results.append([sorted(map(str, df.collect())) for df in (closed, open_windows(spark, layout, table))])
        finally:
            for n, v in zip(names, before):
                spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    assert results[0] == results[1] and all(results[0])


