"""Open windows read from state, and what batches report."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticklake.operators.gold import gold_liquidity, gold_spread, gold_volatility
from ticklake.schemas import SILVER_AGG_TRADE_SCHEMA, SILVER_BOOK_TICKER_SCHEMA, SILVER_DEPTH10_SCHEMA
from ticklake.sources.layers import read_snapshot
from ticklake.streaming.layers import LayerSpec, TableLayout, run_layers_once
from ticklake.streaming.progress import ProgressLog, batches, totals
from ticklake.streaming.state import open_windows
from ticklake.streaming.sync import GOLD_SCHEMAS

GOLD = LayerSpec("gold_volatility", "silver_agg_trade", SILVER_AGG_TRADE_SCHEMA, gold_volatility)
ARRIVALS = [[(10, 1), (10, 6)], [(10, 16)], [(10, 2), (10, 7), (10, 20)], [(11, 0)]]


def at(t):
    return datetime(2026, 1, 1, *t)


def trades(spark, times, symbol="S"):
    rows = [(symbol, None, "aggTrade", None, i, Decimal(i + 1), Decimal("1.5"), i, i, at(t), True, True) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, SILVER_AGG_TRADE_SCHEMA)


def starts(df):
    return sorted(r.window_start.strftime("%H:%M") for r in df.collect())


def test_closed_windows_leave_the_state(spark, scratch):
    layout, seen = TableLayout(scratch("state")), []
    for batch in ARRIVALS:
        trades(spark, batch).write.mode("append").parquet(layout.table("silver_agg_trade"))
        run_layers_once(spark, layout, [GOLD])
        seen.append(starts(open_windows(spark, layout, "gold_volatility")))
    assert seen == [["10:00", "10:05"], ["10:05", "10:15"], ["10:15", "10:20"], ["11:00"]]
    gold = read_snapshot(spark, layout.table("gold_volatility"), GOLD_SCHEMAS["gold_volatility"])
    assert not set(starts(gold)) & set(seen[-1])  # each window is in one of them
    assert starts(open_windows(spark, layout, "gold_volatility", batch_id=0)) == seen[0]  # as of an earlier batch


def silver(spark):
    times = [at((10, m)) for m in (0, 1, 2, 6, 7, 8)] + [at((10, 40)), at((10, 41))]
    one = [
        (s, None, "aggTrade", None, i, p and Decimal(p), Decimal(q), i, i, t, True, True)
        for i, t in enumerate(times)
        for s, p, q in (("A", f"{i}.1", "2"), ("B", None, "3"), ("A", "7.25", "0.00000001"))
    ]
    two = [(s, t, i, Decimal(i), Decimal(1), Decimal(f"{i}.{k}"), Decimal(1)) for i, t in enumerate(times) for s, k in (("A", 3), ("B", 7), ("A", 1))]
    three = [(s, t, i, side, 0, Decimal(1), Decimal(f"{i}.{k}")) for i, t in enumerate(times) for s, side, k in (("A", "bid", 1), ("A", "ask", 2), ("A", "bid", 9))]
    return {
        "gold_volatility": spark.createDataFrame(one, SILVER_AGG_TRADE_SCHEMA),
        "gold_spread": spark.createDataFrame(two, SILVER_BOOK_TICKER_SCHEMA),
        "gold_liquidity": spark.createDataFrame(three, SILVER_DEPTH10_SCHEMA),
    }


@pytest.mark.parametrize("table, build", [("gold_volatility", gold_volatility), ("gold_spread", gold_spread), ("gold_liquidity", gold_liquidity)])
def test_closed_and_open_windows_are_the_batch_result(spark, scratch, table, build):
    rows, layout = silver(spark)[table], TableLayout(scratch(table))
    rows.write.parquet(layout.table("silver"))
    run_layers_once(spark, layout, [LayerSpec(table, "silver", rows.schema, build)])
    closed = read_snapshot(spark, layout.table(table), GOLD_SCHEMAS[table])
    still_open = open_windows(spark, layout, table)
    assert still_open.schema == GOLD_SCHEMAS[table] and still_open.count() > 0 and closed.count() > 0
    expected = build(rows, watermark_delay=None)
    rounded = lambda df: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
    assert rounded(closed.unionByName(still_open)) == rounded(expected)


def test_dropped_rows_add_up_over_restarts(spark, scratch):
    layout, path = TableLayout(scratch("progress")), scratch("log")
    late = [[(10, 1)], [(11, 0)], [(10, 2), (10, 7)], [(10, 1), (11, 1)], [(12, 0)]]
    for batch in late:
        log = ProgressLog(path)  # a new driver
        spark.streams.addListener(log)
        try:
            trades(spark, batch).write.mode("append").parquet(layout.table("silver_agg_trade"))
            run_layers_once(spark, layout, [GOLD], log=log)
        finally:
            spark.streams.removeListener(log)
    row = totals(spark, path).first()
    assert (row.layer, row.rows_dropped, row.rows_read) == ("gold_volatility", 3, 7)
    assert batches(spark, path).select("query_id").distinct().count() == 1


def test_a_batch_that_reports_again_counts_once(spark, scratch):
    class Event:
        def __init__(self, batch, dropped, when):
            operator = type("Operator", (), {"numRowsDroppedByWatermark": dropped})()
            self.progress = type(
                "Report", (), {"id": "q", "batchId": batch, "timestamp": when, "numInputRows": 10, "stateOperators": [operator, operator], "observedMetrics": {}}
            )()

    path = scratch("log")
    for batch, dropped, when in ((0, 1, "2026-01-01T00:00:00Z"), (1, 2, "2026-01-01T00:01:00Z"), (1, 3, "2026-01-01T00:02:00Z")):
        log = ProgressLog(path)
        log.onQueryProgress(Event(batch, dropped, when))
        log.flush(spark)
        log.flush(spark)  # nothing waits any more
    assert totals(spark, path).select("batches", "rows_read", "rows_dropped").first() == (2, 20, 8)
    assert totals(spark, scratch("none")).count() == 0


def test_bronze_rows_say_where_their_frames_lie(spark, scratch):
    from ticklake.operators.silver import silver_agg_trade
    from ticklake.plans.ingest import BRONZE_LINEAGE_SCHEMA, BRONZE_WITH_LINEAGE, FRAMES_SCHEMA, quarantine_of, read_frame_files, read_ingested, start_ingestion

    layout, inbox = TableLayout(scratch("lineage")), scratch("inbox")
    frame = '{"stream":"aaa@aggTrade","data":{"p":"%d","T":1}}'
    for first in (0, 100):  # the second folder of files arrives later
        texts = [frame % (first + i) for i in range(20)] + ["not json"]
        rows = spark.createDataFrame([(t, at((10, 0))) for t in texts], FRAMES_SCHEMA).repartition(3)
        rows.write.mode("append").parquet(inbox)
        start_ingestion(read_frame_files(spark, inbox), layout, available_now=True).awaitTermination()
        run_layers_once(spark, layout, [BRONZE_WITH_LINEAGE])
    bronze = read_snapshot(spark, layout.table("bronze"), BRONZE_LINEAGE_SCHEMA)
    assert bronze.count() == 40
    places = spark.read.parquet(inbox).select("frame", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("offset"))
    found = bronze.join(places, ["source_file", "offset"]).where("frame = raw_payload")
    assert found.count() == 40 and bronze.select("source_file").distinct().count() == 6
    assert {r.partition for r in bronze.collect()} == {0, 1, 2}
    rejected = quarantine_of(read_ingested(spark, layout)).collect()
    assert [(r.frame, r.received_at) for r in rejected] == [("not json", at((10, 0)))] * 2
    assert silver_agg_trade(bronze).where("price is not null").count() == 40
