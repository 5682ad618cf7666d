"""One table-driven entry point for every layer job.

    python -m ticklake.plans.jobs <layer> --root <shared folder> [--available-now]
        [--trigger "10 seconds"] [--format parquet|delta] [--max-per-trigger N]
        [--shuffle-partitions N] [--rocksdb]

``<layer>`` is one of ``bronze``, ``silver_agg_trade``, ``silver_book_ticker``,
``silver_depth10``, ``gold_volatility``, ``gold_spread``, ``gold_liquidity``,
or ``ingest`` (frames as text lines from ``--frames``, then ``--from-ingested``
for Bronze), or ``serving`` (all Gold tables into their serving tables, every
``--interval`` seconds, once with ``--available-now``).
Each runs as its own streaming query with its own checkpoint under
``<root>/checkpoints/<layer>``; tables live under ``<root>/tables``.  With a
broker, Bronze's source is the topic (``--topic``/``--bootstrap``) instead of
the ``landing`` table.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ticklake.plans.ingest import BRONZE_FROM_INGESTED, read_frame_lines, start_ingestion
from ticklake.plans.medallion import LAYERS, bronze_from_records
from ticklake.sources.kafka import read_topic
from ticklake.sources.layers import write_layer
from ticklake.streaming.layers import TableLayout, start_layer, wait_for_source
from ticklake.streaming.replay import at_current_versions, replay_layer
from ticklake.streaming.sync import serving_specs, sync_all, sync_until_stopped


def run_layer(
    spark: SparkSession,
    layout: TableLayout,
    name: str,
    available_now: bool = False,
    trigger_interval: str | None = None,
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    max_per_trigger: int | None = None,
    source_timeout_s: float = 300.0,
    from_ingested: bool = False,
) -> StreamingQuery:
    """Start layer ``name`` and return its query handle (the caller waits).

    ``max_per_trigger`` bounds each micro-batch (files of the upstream table,
    or topic offsets for Bronze on a broker), so a backlog is worked off in
    bounded batches instead of one huge first batch.  A layer started before
    its upstream has produced a readable table waits for it (up to
    ``source_timeout_s``) rather than failing or misreading it."""
    spec = BRONZE_FROM_INGESTED if name == "bronze" and from_ingested else LAYERS[name]
    if trigger_interval:
        spec = replace(spec, trigger_interval=trigger_interval)
    if name == "bronze" and bootstrap_servers and topic:
        records = read_topic(spark, bootstrap_servers, topic, max_offsets_per_trigger=max_per_trigger)
        return write_layer(
            bronze_from_records(records),
            layout.table(name),
            layout.checkpoint(name),
            trigger_interval=None if available_now else spec.trigger_interval,
            partition_by=spec.partition_by,
            fmt=layout.fmt,
            available_now=available_now,
        )
    wait_for_source(spark, layout, spec, timeout_s=source_timeout_s)
    return start_layer(spark, layout, spec, available_now, max_files_per_trigger=max_per_trigger, known_ready=True)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("layer", choices=[*sorted(LAYERS), "ingest", "serving"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--trigger", default=None)
    parser.add_argument("--available-now", action="store_true")
    parser.add_argument("--bootstrap", default=None)
    parser.add_argument("--topic", default=None)
    parser.add_argument("--max-per-trigger", type=int, default=None)
    parser.add_argument("--frames", default=None, help="folder of text files with a frame per line (ingest)")
    parser.add_argument("--from-ingested", action="store_true", help="Bronze reads what ingest has written")
    parser.add_argument("--replay", action="store_true", help="make the layer again from the one above, and switch to it; neither it nor those that read it may be running")
    parser.add_argument("--interval", type=float, default=30.0, help="seconds between serving cycles")
    parser.add_argument(
        "--shuffle-partitions", type=int, default=None,
        help="state partitions of a Gold job; fixed in its checkpoint at first start",
    )
    parser.add_argument("--rocksdb", action="store_true", help="RocksDB state store (large key sets)")
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName(f"ticklake-{args.layer}")
    if args.shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.rocksdb:
        builder = builder.config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    spark = builder.getOrCreate()
    layout = at_current_versions(spark, TableLayout(args.root.rstrip("/"), args.format), LAYERS)
    if args.replay:
        if args.layer not in LAYERS:
            parser.error("only a layer can be replayed")
        replay_layer(spark, layout, LAYERS[args.layer], [s for s in LAYERS.values() if s.source == args.layer])
        return 0
    if args.layer == "serving":
        if not args.available_now:
            sync_until_stopped(spark, serving_specs(layout), layout.fmt, args.interval)
            return 0
        handles = sync_all(spark, serving_specs(layout), layout.fmt, available_now=True)
        failed = [t for t, q in handles.items() if q is not None and q.exception() is not None]
        return 1 if failed else 0
    if args.layer == "ingest":
        if not args.frames:
            parser.error("ingest needs --frames")
        lines = read_frame_lines(spark, args.frames, args.max_per_trigger)
        query = start_ingestion(lines, layout, args.available_now, args.trigger or "5 seconds")
    else:
        query = run_layer(
            spark, layout, args.layer, args.available_now, args.trigger, args.bootstrap, args.topic, args.max_per_trigger,
            from_ingested=args.from_ingested,
        )
    try:
        query.awaitTermination()
    except Exception as err:  # the query failed: report and exit non-zero
        print(f"{args.layer} failed: {err}", file=sys.stderr)
        return 1
    return 0 if query.exception() is None else 1


if __name__ == "__main__":
    sys.exit(main())
