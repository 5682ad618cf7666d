"""Write the physical plans of the main operators to PLANS.md.

Builds real Bronze / Silver / Gold / serving tables from an sf directory in
the shared scratch folder, then records ``explain("formatted")`` of each
operator reading those tables.  Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ticklake.operators.gold import gold_volatility  # noqa: E402
from ticklake.operators.serving import _target_keys, absent_rows, insert_absent, to_serving_contract  # noqa: E402
from ticklake.operators.silver import silver_agg_trade, silver_depth10  # noqa: E402
from ticklake.plans.catalog import _land  # noqa: E402
from ticklake.plans.medallion import chain  # noqa: E402
from ticklake.schemas import BRONZE_SCHEMA, SERVING_VOLATILITY_SCHEMA, SILVER_AGG_TRADE_SCHEMA  # noqa: E402
from ticklake.session import scratch_dir  # noqa: E402
from ticklake.sources.layers import read_snapshot  # noqa: E402
from ticklake.streaming.layers import TableLayout, run_layers_once  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"#\d+L?", "", buf.getvalue())
    text = re.sub(r"(?:file:)?/\S+?/ticklake/[^/\]]+", "<scratch>", text)
    return text.strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    layout = TableLayout(scratch_dir(spark, "plans"))
    _land(spark, sf_dir, layout)
    run_layers_once(spark, layout, chain("silver_agg_trade"))
    bronze = read_snapshot(spark, layout.table("bronze"), BRONZE_SCHEMA)
    silver = read_snapshot(spark, layout.table("silver_agg_trade"), SILVER_AGG_TRADE_SCHEMA)
    target = layout.root + "/serving/gold_volatility"
    gold = gold_volatility(silver)
    early = gold.filter(F.col("window_start") < F.lit("2024-01-15").cast("timestamp"))
    insert_absent(spark, early, target, "gold_volatility")
    batch = to_serving_contract(gold.filter(F.col("window_start") >= F.lit("2024-01-20").cast("timestamp")), "gold_volatility")
    jan20, jan31 = 1705708800 * 10**6, 1706659200 * 10**6  # 2024-01-20 / 2024-01-31 UTC, epoch us
    keys = _target_keys(spark, target, SERVING_VOLATILITY_SCHEMA, ("symbol", "window_start"), jan20, jan31, "parquet")
    sections = [
        ("Silver aggTrade from partitioned Bronze",
         "Partition filter on stream_type in the scan; json_tuple extracts `data` once; from_json runs once per kept row.",
         silver_agg_trade(bronze)),
        ("Silver depth10 from partitioned Bronze",
         "One scan; both sides exploded by one `inline` generator, then `posexplode` for levels.",
         silver_depth10(bronze)),
        ("Gold volatility from Silver",
         "Column pruning to 4 columns; partial aggregation (`partial_avg`, `partial_stddev_samp`, ...) before the only shuffle.",
         gold),
        ("Serving insert: new rows of a batch against the target",
         "Target keys read only for the batch's window range (PushedFilters on window_start); anti-join on the keys.",
         absent_rows(batch, keys, ("symbol", "window_start"))),
    ]
    out = ["# PLANS", "", f"Physical plans (`explain(\"formatted\")`) over tables built from `{sf_dir}`, "
           "generated by `scripts/show_plans.py`. Expression ids and scratch paths are elided.", ""]
    for title, note, df in sections:
        out += [f"## {title}", "", note, "", "```", formatted(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print("wrote", path)


if __name__ == "__main__":
    main()
