"""Batches of the serving sync that Spark replays, and tables that are slow."""

import threading
import time
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException

from ticklake.operators import serving
from ticklake.operators.serving import read_serving
from ticklake.schemas import GOLD_SPREAD_SCHEMA, GOLD_VOLATILITY_SCHEMA
from ticklake.sources.layers import table_available
from ticklake.streaming import sync
from ticklake.streaming.sync import SyncSpec, applied_epoch, start_sync, sync_all, sync_until_stopped


def add_gold(spark, path, minutes):
    start = lambda m: datetime(2026, 1, 1, 10, m)
    rows = [(start(m), start(m + 5), "A", Decimal(m), 1.0, Decimal(1), 1) for m in minutes]
    spark.createDataFrame(rows, GOLD_VOLATILITY_SCHEMA).write.mode("append").parquet(path)


@pytest.fixture
def spec(scratch):
    root = scratch("sync_commit")
    return SyncSpec("gold_volatility", f"{root}/gold", GOLD_VOLATILITY_SCHEMA, f"{root}/serving", f"{root}/checkpoint")


@pytest.fixture
def key_reads(monkeypatch):
    reads, target_keys = [], serving._target_keys
    monkeypatch.setattr(serving, "_target_keys", lambda *a: reads.append(a) or target_keys(*a))
    return reads


def fails(query):
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()


def served(spark, spec):
    return sorted(r.window_start.minute for r in read_serving(spark, spec.target_path, spec.table).collect())


def lost(epoch_id):
    raise RuntimeError("lost")


def test_a_replayed_batch_reads_no_target_keys(spark, spec, key_reads):
    add_gold(spark, spec.gold_path, [0, 5])
    fails(start_sync(spark, spec, available_now=True, on_applied=lost))  # applied, not committed
    assert served(spark, spec) == [0, 5] and applied_epoch(spark, spec) == 0 and len(key_reads) == 1
    add_gold(spark, spec.gold_path, [10])
    start_sync(spark, spec, available_now=True).awaitTermination()  # replays batch 0, then takes batch 1
    assert served(spark, spec) == [0, 5, 10] and applied_epoch(spark, spec) == 1 and len(key_reads) == 2


def test_a_batch_that_is_written_but_not_marked_adds_nothing_again(spark, spec, key_reads, monkeypatch):
    add_gold(spark, spec.gold_path, [0, 5])
    with monkeypatch.context() as m:
        m.setattr(sync, "_mark_applied", lambda *a: lost(0))
        fails(start_sync(spark, spec, available_now=True))
    assert served(spark, spec) == [0, 5] and applied_epoch(spark, spec) == -1
    start_sync(spark, spec, available_now=True).awaitTermination()
    assert served(spark, spec) == [0, 5] and applied_epoch(spark, spec) == 0 and len(key_reads) == 2


def test_a_fresh_checkpoint_has_no_marks(spark, spec, scratch):
    add_gold(spark, spec.gold_path, [0, 5])
    for checkpoint in (spec.checkpoint_path, scratch("fresh")):
        again = SyncSpec(spec.table, spec.gold_path, spec.gold_schema, spec.target_path, checkpoint)
        assert applied_epoch(spark, again) == -1
        assert sync_all(spark, [again], available_now=True)[spec.table].exception() is None
        assert applied_epoch(spark, again) == 0 and served(spark, spec) == [0, 5]


def test_a_blocked_table_does_not_delay_the_others(spark, spec, scratch, monkeypatch):
    root = scratch("blocked")
    spread = SyncSpec("gold_spread", f"{root}/gold", GOLD_SPREAD_SCHEMA, f"{root}/serving", f"{root}/checkpoint")
    rows = [(datetime(2026, 1, 1, 10, 0), datetime(2026, 1, 1, 10, 5), "A", *[Decimal(1)] * 4)]
    spark.createDataFrame(rows, GOLD_SPREAD_SCHEMA).write.parquet(spread.gold_path)
    add_gold(spark, spec.gold_path, [0])
    blocked, release, stop, insert = threading.Event(), threading.Event(), threading.Event(), sync.insert_absent

    def slow(spark, batch, target, table, fmt):
        if table == "gold_spread":
            blocked.set()
            release.wait(120)
        return insert(spark, batch, target, table, fmt)

    monkeypatch.setattr(sync, "insert_absent", slow)
    loop = threading.Thread(target=sync_until_stopped, args=(spark, [spread, spec]), kwargs={"interval_s": 0.2, "stop": stop})
    loop.start()
    try:
        assert blocked.wait(60)
        for minutes in ([0], [0, 5]):  # two cycles of the other table go by
            deadline = time.monotonic() + 60
            while time.monotonic() < deadline and not (table_available(spark, spec.target_path) and served(spark, spec) == minutes):
                time.sleep(0.2)
            assert served(spark, spec) == minutes and not table_available(spark, spread.target_path)
            if minutes == [0]:
                add_gold(spark, spec.gold_path, [5])
        release.set()
        deadline = time.monotonic() + 60
        while time.monotonic() < deadline and not table_available(spark, spread.target_path):
            time.sleep(0.2)
    finally:
        release.set()
        stop.set()
        loop.join(60)
    assert not loop.is_alive() and read_serving(spark, spread.target_path, "gold_spread").count() == 1
