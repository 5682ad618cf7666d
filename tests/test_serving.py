from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticklake.operators.serving import (
    DuplicateKeyError,
    dashboard_symbols,
    insert_absent,
    liquidity_series,
    sync_table,
    volatility_series,
)
from ticklake.schemas import SERVING_VOLATILITY_SCHEMA
from ticklake.sources.layers import read_snapshot, table_available

VOL_DDL = (
    "window_start timestamp, window_end timestamp, symbol string, avg_price decimal(24,12), "
    "stddev_price double, total_volume decimal(30,8), trade_count long"
)


def vol(spark, rows):
    return spark.createDataFrame(
        [(datetime(2026, 1, 1, 10, m), datetime(2026, 1, 1, 10, m + 5), s, Decimal(p), None, Decimal("1"), n) for m, s, p, n in rows],
        VOL_DDL,
    )


def target_rows(spark, path):
    return sorted(
        (r.symbol, r.window_start.minute, r.avg_price, r.trade_count)
        for r in read_snapshot(spark, path, SERVING_VOLATILITY_SCHEMA).collect()
    )


def test_insert_absent_is_idempotent_and_first_write_wins(spark, scratch):
    path = scratch("serving") + "/vol"
    insert_absent(spark, vol(spark, [(0, "A", "1", 1), (5, "A", "2", 1)]), path, "gold_volatility")
    insert_absent(spark, vol(spark, [(0, "A", "1", 1), (5, "A", "2", 1)]), path, "gold_volatility")
    assert len(target_rows(spark, path)) == 2
    # a changed metric for an existing key is ignored; a new key is added
    insert_absent(spark, vol(spark, [(0, "A", "9", 9), (10, "A", "3", 1)]), path, "gold_volatility")
    assert target_rows(spark, path) == [
        ("A", 0, Decimal("1.00000000"), 1),
        ("A", 5, Decimal("2.00000000"), 1),
        ("A", 10, Decimal("3.00000000"), 1),
    ]


def test_duplicate_key_in_batch_raises_and_writes_nothing(spark, scratch):
    path = scratch("serving") + "/vol"
    with pytest.raises(DuplicateKeyError):
        insert_absent(spark, vol(spark, [(0, "A", "1", 1), (0, "A", "2", 1)]), path, "gold_volatility")
    assert not table_available(spark, path, SERVING_VOLATILITY_SCHEMA)


def test_null_key_raises(spark, scratch):
    path = scratch("serving") + "/vol"
    with pytest.raises(DuplicateKeyError):
        insert_absent(spark, vol(spark, [(0, None, "1", 1)]), path, "gold_volatility")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_overflowing_metric_fails_at_the_serving_edge(spark, scratch, ansi):
    path = scratch("serving") + "/vol"
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        big = vol(spark, [(0, "A", "1", 1)]).withColumn("total_volume", F.lit("10000000000000").cast("decimal(30,8)"))
        with pytest.raises(Exception, match="total_volume does not fit decimal"):
            insert_absent(spark, big, path, "gold_volatility")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert not table_available(spark, path, SERVING_VOLATILITY_SCHEMA)


def test_table_available_missing_empty_and_present(spark, scratch):
    import os

    root = scratch("avail")
    assert not table_available(spark, root + "/missing", SERVING_VOLATILITY_SCHEMA)
    empty = root + "/empty"
    os.makedirs(empty.replace("file:", ""), exist_ok=True)
    assert table_available(spark, empty, SERVING_VOLATILITY_SCHEMA)
    assert table_available(spark, empty)


def test_sync_table_skips_missing_source(spark, scratch):
    root = scratch("sync")
    assert sync_table(spark, root + "/gold", root + "/target", "gold_volatility") is False
    assert not table_available(spark, root + "/target", SERVING_VOLATILITY_SCHEMA)
    vol(spark, [(0, "A", "1", 1)]).write.parquet(root + "/gold")
    assert sync_table(spark, root + "/gold", root + "/target", "gold_volatility") is True
    assert sync_table(spark, root + "/gold", root + "/target", "gold_volatility") is True
    assert len(target_rows(spark, root + "/target")) == 1


def test_streaming_sync_isolates_tables(spark, scratch):
    from ticklake.streaming.sync import GOLD_SCHEMAS, SyncSpec, sync_all

    root = scratch("syncall")
    vol(spark, [(0, "A", "1", 1)]).write.parquet(root + "/gold_volatility")
    specs = [
        SyncSpec("gold_volatility", root + "/gold_volatility", GOLD_SCHEMAS["gold_volatility"], root + "/t/vol", root + "/c/vol"),
        SyncSpec("gold_spread", root + "/gold_spread", GOLD_SCHEMAS["gold_spread"], root + "/t/spread", root + "/c/spread"),
    ]
    handles = sync_all(spark, specs, available_now=True)
    assert handles["gold_spread"] is None  # source not there yet
    assert handles["gold_volatility"].exception() is None
    assert len(target_rows(spark, root + "/t/vol")) == 1


def test_dashboard_queries(spark):
    v = vol(spark, [(5, "B", "1", 1), (0, "A", "1", 1), (0, "C", "1", 1)])
    assert [r.symbol for r in dashboard_symbols(v).collect()] == ["A", "B", "C"]
    rows = volatility_series(v, ["A", "B"]).collect()
    assert [(r.symbol, r.time.minute) for r in rows] == [("A", 0), ("B", 5)]
    assert volatility_series(v, ["A"], start=datetime(2026, 1, 1, 10, 1)).count() == 0
    liq = spark.createDataFrame(
        [(datetime(2026, 1, 1, 10, 0), datetime(2026, 1, 1, 10, 5), "A", "bid", Decimal("1")),
         (datetime(2026, 1, 1, 10, 0), datetime(2026, 1, 1, 10, 5), "A", None, Decimal("1"))],
        "window_start timestamp, window_end timestamp, symbol string, side string, avg_depth_quantity decimal(20,8)",
    )
    assert sorted(r.metric for r in liquidity_series(liq, ["A"]).collect()) == ["A - ", "A - bid"]


def test_target_key_read_is_range_bounded_in_the_scan(spark, scratch):
    from ticklake.operators.serving import _target_keys

    path = scratch("serving") + "/vol"
    insert_absent(spark, vol(spark, [(0, "A", "1", 1), (20, "A", "1", 1)]), path, "gold_volatility")
    keys = _target_keys(
        spark, path, SERVING_VOLATILITY_SCHEMA, ("symbol", "window_start"),
        _micros(datetime(2026, 1, 1, 10, 0)), _micros(datetime(2026, 1, 1, 10, 5)), "parquet",
    )
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(window_start" in plan and "LessThanOrEqual" in plan
    assert "ReadSchema: struct<window_start:timestamp,symbol:string>" in plan
    assert keys.count() == 1


def test_one_failing_table_does_not_stop_the_others(spark, scratch):
    from ticklake.streaming.sync import GOLD_SCHEMAS, SyncSpec, sync_all

    root = scratch("isolation")
    vol(spark, [(0, "A", "1", 1), (0, "A", "2", 1)]).write.parquet(root + "/gold_volatility")  # duplicate key
    spread = spark.createDataFrame(
        [(datetime(2026, 1, 1, 10, 0), datetime(2026, 1, 1, 10, 5), "A", Decimal("1"), Decimal("1"), Decimal("1"), Decimal("1"))],
        GOLD_SCHEMAS["gold_spread"],
    )
    spread.write.parquet(root + "/gold_spread")
    specs = [
        SyncSpec("gold_volatility", root + "/gold_volatility", GOLD_SCHEMAS["gold_volatility"], root + "/t/vol", root + "/c/vol"),
        SyncSpec("gold_spread", root + "/gold_spread", GOLD_SCHEMAS["gold_spread"], root + "/t/spread", root + "/c/spread"),
    ]
    handles = sync_all(spark, specs, available_now=True)
    assert handles["gold_volatility"].exception() is not None
    assert not table_available(spark, root + "/t/vol", SERVING_VOLATILITY_SCHEMA)
    assert handles["gold_spread"].exception() is None
    assert read_snapshot(spark, root + "/t/spread").count() == 1


def _micros(dt):
    from datetime import timezone

    return int(dt.replace(tzinfo=timezone.utc).timestamp() * 1_000_000)


def test_insert_absent_is_independent_of_the_driver_time_zone(spark, scratch):
    """Windows inside a DST fall-back hour of the driver's local zone: the
    replayed window must still be found in the target (no duplicate)."""
    import os
    import time

    def batch(*utc):
        return spark.createDataFrame(
            [(i,) for i in range(len(utc))], "i int"
        ).select(
            F.timestamp_micros(F.element_at(F.array(*[F.lit(_micros(u)) for u in utc]), F.col("i") + 1)).alias("window_start"),
            F.timestamp_micros(F.element_at(F.array(*[F.lit(_micros(u) + 300_000_000) for u in utc]), F.col("i") + 1)).alias("window_end"),
            F.lit("A").alias("symbol"),
            F.lit(1).cast("decimal(24,12)").alias("avg_price"),
            F.lit(None).cast("double").alias("stddev_price"),
            F.lit(1).cast("decimal(30,8)").alias("total_volume"),
            F.lit(1).cast("long").alias("trade_count"),
        )

    first, second = datetime(2026, 11, 1, 5, 30), datetime(2026, 11, 1, 6, 30)  # 01:30 EDT, 01:30 EST
    path = scratch("dst") + "/vol"
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        insert_absent(spark, batch(first, second), path, "gold_volatility")
        insert_absent(spark, batch(second), path, "gold_volatility")
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()
    assert read_snapshot(spark, path, SERVING_VOLATILITY_SCHEMA).count() == 2


def test_an_error_at_the_start_of_one_table_does_not_stop_the_others(spark, scratch):
    from ticklake.streaming.sync import GOLD_SCHEMAS, SyncSpec, sync_all

    root = scratch("start_error")
    vol(spark, [(0, "A", "1", 1)]).write.parquet(root + "/gold_volatility")
    specs = [
        SyncSpec("gold_spread", "nosuchstore://x/gold", GOLD_SCHEMAS["gold_spread"], root + "/t/spread", root + "/c/spread"),
        SyncSpec("gold_volatility", root + "/gold_volatility", GOLD_SCHEMAS["gold_volatility"], root + "/t/vol", root + "/c/vol"),
    ]
    handles = sync_all(spark, specs, available_now=True)
    assert handles["gold_spread"] is None and handles["gold_volatility"].exception() is None
    assert len(target_rows(spark, root + "/t/vol")) == 1


def test_sync_until_stopped_picks_up_a_gold_table_that_appears_later(spark, scratch):
    import threading
    import time

    from ticklake.streaming.sync import GOLD_SCHEMAS, SyncSpec, sync_until_stopped

    root, stop = scratch("later"), threading.Event()
    spec = SyncSpec("gold_volatility", root + "/gold", GOLD_SCHEMAS["gold_volatility"], root + "/t", root + "/c")
    loop = threading.Thread(target=sync_until_stopped, args=(spark, [spec]), kwargs={"interval_s": 0.2, "stop": stop})
    loop.start()
    try:
        time.sleep(1)
        assert not table_available(spark, root + "/t", SERVING_VOLATILITY_SCHEMA)
        rows = vol(spark, [(0, "A", "1", 1)])
        rows.select(*[rows[f.name].cast(f.dataType) for f in GOLD_SCHEMAS["gold_volatility"].fields]).write.parquet(root + "/gold")
        deadline = time.monotonic() + 60
        while time.monotonic() < deadline and not table_available(spark, root + "/t", SERVING_VOLATILITY_SCHEMA):
            time.sleep(0.3)
    finally:
        stop.set()
        loop.join(60)
    assert len(target_rows(spark, root + "/t")) == 1


def test_file_targets_list_only_the_days_of_the_batch(spark, scratch):
    from ticklake.operators.serving import _target_keys, read_serving

    path = scratch("days") + "/vol"
    days = vol(spark, [(0, "A", "1", 1)])
    for n in range(3):
        shifted = days.withColumns({c: F.col(c) + F.make_dt_interval(F.lit(n)) for c in ("window_start", "window_end")})
        assert insert_absent(spark, shifted, path, "gold_volatility")
    day = _micros(datetime(2026, 1, 2, 10, 0))
    keys = _target_keys(spark, path, SERVING_VOLATILITY_SCHEMA, ("symbol", "window_start"), day, day, "parquet")
    assert len(keys.inputFiles()) == 1 and keys.count() == 1
    absent = _micros(datetime(2026, 2, 2))
    assert _target_keys(spark, path, SERVING_VOLATILITY_SCHEMA, ("symbol", "window_start"), absent, absent, "parquet") is None
    assert _target_keys(spark, path, SERVING_VOLATILITY_SCHEMA, ("symbol", "window_start"), 0, absent, "parquet").count() == 3
    assert read_serving(spark, path, "gold_volatility").columns == SERVING_VOLATILITY_SCHEMA.fieldNames()
