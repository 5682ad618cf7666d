"""Physical-plan properties the scale design relies on."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ticklake.operators.envelope import subscription_filter
from ticklake.operators.gold import gold_volatility


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_aggregates_partially_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("A", datetime(2026, 1, 1, 10, 0), Decimal("1"), Decimal("1"))],
        "symbol string, trade_timestamp timestamp, price decimal(20,8), quantity decimal(20,8)",
    )
    plan = _plan(gold_volatility(df))
    assert "partial_avg" in plan and "partial_stddev_samp" in plan and "partial_sum" in plan
    assert plan.index("Exchange") < plan.index("partial_avg")  # printed top-down: partial agg sits below the shuffle
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan


def test_subscription_list_is_a_set_filter_not_a_join(spark):
    df = spark.createDataFrame([('{"stream":"a@aggTrade"}',)], "frame string")
    plan = _plan(subscription_filter(df, "A,B,C,D,E,F,G,H,I,J,K", ["aggTrade"]))
    assert "Join" not in plan and "Exchange" not in plan
    assert "INSET" in plan.upper()


def test_bronze_read_of_one_stream_type_prunes_partitions(spark, scratch):
    from ticklake.schemas import BRONZE_SCHEMA
    from ticklake.sources.layers import read_snapshot

    path = scratch("prune") + "/bronze"
    rows = [(datetime(2026, 1, 1), "A", t, "{}", 0, i, datetime(2026, 1, 1)) for i, t in enumerate(["aggTrade", "depth10"])]
    spark.createDataFrame(rows, BRONZE_SCHEMA).write.partitionBy("stream_type").parquet(path)
    df = read_snapshot(spark, path, BRONZE_SCHEMA).filter(F.col("stream_type") == "depth10")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(stream_type" in plan and "(stream_type#" in plan
    assert df.count() == 1


def test_layer_job_entry_point(spark, scratch):
    from ticklake.plans.jobs import main
    from ticklake.plans.medallion import landing_records
    from ticklake.plans.testdata import market_frames
    from ticklake.schemas import BRONZE_SCHEMA
    from ticklake.sources.layers import read_snapshot

    root = scratch("jobs")
    landing_records(market_frames(spark, "/root/testdata/sf0.001")).write.parquet(root + "/tables/landing")
    assert main(["bronze", "--root", root, "--available-now"]) == 0
    assert main(["silver_depth10", "--root", root, "--available-now"]) == 0
    bronze = read_snapshot(spark, root + "/tables/bronze", BRONZE_SCHEMA)
    assert bronze.filter("stream_type = 'depth10'").count() == read_snapshot(spark, root + "/tables/silver_depth10").select("last_update_id").distinct().count()


def test_bounded_micro_batches_give_the_same_table(spark, scratch):
    from ticklake.plans.jobs import main
    from ticklake.schemas import SILVER_AGG_TRADE_SCHEMA
    from ticklake.sources.layers import read_snapshot
    from ticklake.streaming.layers import TableLayout

    root = scratch("bounded")
    rows = [("S", None, "aggTrade", None, i, Decimal("1"), Decimal("1"), i, i, datetime(2026, 1, 1, 10, i), True, True) for i in range(0, 40, 3)]
    for i in range(0, len(rows), 4):
        spark.createDataFrame(rows[i : i + 4], SILVER_AGG_TRADE_SCHEMA).coalesce(1).write.mode("append").parquet(root + "/tables/silver_agg_trade")
    assert main(["gold_volatility", "--root", root, "--available-now", "--max-per-trigger", "1"]) == 0
    streamed = read_snapshot(spark, TableLayout(root).table("gold_volatility")).count()
    assert streamed == 5  # watermark 10:39 - 10 min: windows ending 10:05..10:25 close


def test_every_payload_is_parsed_once(spark):
    from ticklake.plans.catalog import _gold, _silver_for

    for table in ("gold_volatility", "gold_spread", "gold_liquidity"):
        plan = _plan(_gold(table, _silver_for(table, spark, "/root/testdata/sf0.001")))
        # one from_json checks the frame, one parses the payload; the mixed feed is a union of three scans
        payload = [line for line in plan.splitlines() if "from_json" in line and "_corrupt" not in line]
        assert len(payload) == plan.count("get_json_object(raw_payload") > 0, table


def test_filters_reach_the_scan_through_the_serving_contract(spark, scratch):
    from ticklake.operators.serving import to_serving_contract, volatility_series
    from ticklake.schemas import GOLD_VOLATILITY_SCHEMA

    path = scratch("pushed") + "/gold"
    spark.createDataFrame([], GOLD_VOLATILITY_SCHEMA).write.parquet(path)
    served = to_serving_contract(spark.read.parquet(path), "gold_volatility")
    series = volatility_series(served, ["A"], datetime(2026, 1, 1), datetime(2026, 1, 2))
    plan = series._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(symbol,A)" in pushed and "GreaterThanOrEqual(window_start" in pushed and "LessThan(window_start" in pushed


def test_symbol_table_is_broadcast_after_a_count(spark):
    df = spark.createDataFrame([('{"stream":"a@aggTrade"}',)], "frame string")
    plan = _plan(subscription_filter(df, spark.createDataFrame([("A",)], "symbol string")))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_key_slices_hold_every_window_once():
    from ticklake.operators.serving import key_slices

    lo, hi = 1_704_067_200_000_000, 1_704_070_800_000_000
    slices = key_slices(lo, hi, 7)
    edges = [s.split("'")[1::2] for s in slices]
    assert len(slices) == 7 and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
    assert edges[0][0] == "2024-01-01 00:00:00+00:00" and edges[-1][1] > "2024-01-01 01:00:00"
    assert len(key_slices(lo, lo)) == 1
