"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

``build_gold`` is the batch part (bronze, silver, features, gold) from the given tables; the other entries
run on the tables it wrote, as report and tool queries do. Every result is fully computed and written to the
no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from clientele.catalog import QUERIES  # noqa: E402
from clientele.plans.warehouse import warehouse  # noqa: E402

HEADLINE = (
    "int1_recency", "int2_txn_trend", "int7_nbi", "int8_majority_channel", "mrt3_composite_risk", "mrt6_customer_segments",
    "scr3_engagement_score", "srv1_at_risk", "srv5_complaint_analysis", "rpt8_segment_recap", "rpt12_latest_month_txn",
    "rpt13_channel_adoption", "rpt15_monthly_volume", "rpt17_segment_profile", "rpt19_call_list", "rpt25_product_snapshot",
    "rpt27_recent_txns", "dq9_rule_suite", "dq13_iqr_outliers", "eda4_balance_five_numbers", "eda10_correlations",
    "syn3_remap_transactions", "syn5_inject_churn", "ml9_roc_points", "ml10_psi_risk", "ml5_logistic",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clientele-bench-"))
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = sys.argv[1:] or HEADLINE
    spark = session()
    times = {"build_gold": timed(lambda: warehouse(spark, folder).gold())}
    for name in wanted:
        times[name] = timed(lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
