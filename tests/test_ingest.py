import json
import os

from ticklake.plans.ingest import BRONZE_FROM_INGESTED, landing_of, quarantine_of, read_frame_lines, read_ingested, start_ingestion
from ticklake.plans.medallion import chain
from ticklake.schemas import KAFKA_RECORD_SCHEMA, SILVER_AGG_TRADE_SCHEMA
from ticklake.sources.layers import read_snapshot
from ticklake.streaming.layers import TableLayout, run_layers_once

TRADE = {"stream": "aaausdt@aggTrade", "data": {"e": "aggTrade", "E": 1767261600123, "s": "AAAUSDT", "a": 7,
         "p": "10.5", "q": "2", "f": 11, "l": 12, "T": 1767261600120, "m": True, "M": True}}


def test_frames_stream_to_landing_quarantine_and_silver(spark, scratch):
    root = scratch("ingest")
    inbox = root + "/inbox"
    os.makedirs(inbox.replace("file:", ""), exist_ok=True)
    with open(inbox.replace("file:", "") + "/part-1.txt", "w") as fh:
        fh.write(json.dumps(TRADE) + "\n")
        fh.write("not-json\n")
        fh.write('{"stream":"aaausdt@kline_1m","data":{}}\n')
    layout = TableLayout(root)
    start_ingestion(read_frame_lines(spark, inbox), layout, available_now=True).awaitTermination()
    landing = landing_of(read_ingested(spark, layout))
    assert landing.columns == KAFKA_RECORD_SCHEMA.fieldNames()
    assert landing.count() == 1 and bytes(landing.first().key) == b"AAAUSDT"
    rejected = quarantine_of(read_ingested(spark, layout))
    assert "PartitionFilters: [isnotnull(status" in rejected._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.reason for r in rejected.collect()) == ["invalid_json", "unknown_stream_type"]
    run_layers_once(spark, layout, [BRONZE_FROM_INGESTED, *chain("silver_agg_trade")[1:]])
    trades = read_snapshot(spark, layout.table("silver_agg_trade"), SILVER_AGG_TRADE_SCHEMA).collect()
    assert [(t.symbol, t.agg_trade_id, str(t.price)) for t in trades] == [("AAAUSDT", 7, "10.50000000")]


def test_ingest_bronze_and_serving_jobs(spark, scratch):
    from ticklake.plans.jobs import main

    root = scratch("jobs_ingest")
    inbox = root + "/inbox"
    os.makedirs(inbox.replace("file:", ""), exist_ok=True)
    for i, minute in enumerate((0, 30, 31)):  # the last ones close the first window
        trade = {"stream": TRADE["stream"], "data": TRADE["data"] | {"a": i, "T": TRADE["data"]["T"] + minute * 60_000}}
        with open(f"{inbox.replace('file:', '')}/part-{i}.txt", "w") as fh:
            fh.write(json.dumps(trade) + "\n")
    assert main(["ingest", "--root", root, "--frames", inbox, "--available-now"]) == 0
    assert main(["bronze", "--root", root, "--from-ingested", "--available-now"]) == 0
    for layer in ("silver_agg_trade", "gold_volatility", "serving"):
        assert main([layer, "--root", root, "--available-now"]) == 0
    served = read_snapshot(spark, root + "/tables/serving_gold_volatility").collect()
    assert [(r.symbol, r.trade_count) for r in served] == [("AAAUSDT", 1)]
