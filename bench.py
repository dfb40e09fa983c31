"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (3 unless set); its time is the median.
A run includes the jobs a query starts while it is built and the full evaluation of its result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from sparkmart.queries import QUERIES
from sparkmart.runtime import drop_scratch, local_session

HEADLINE = (
    "sales_mart",
    "fact_sales",
    "fact_news",
    "star_extract",
    "news_clean",
    "dq_duplicates",
    "dq_nulls",
    "dq_validate",
    "dq_autoclean",
    "impute_interpolate",
    "col_stats",
    "strip_punct",
    "src_json_nested",
    "src_html_headings",
    "load_incremental",
    "apply_changes",
    "interval_backfill",
    "run_metrics",
    "tables_equal",
    "diff_keyed",
    "diff_summary",
    "diff_cells",
    "diff3",
    "merge3",
    "patch_roundtrip",
    "fact_news_reload",
    "diff_moves",
    "dim_cleaned",
    "diff_auto",
    "diff_reordered",
    "diff_auto_repeated",
    "diff_context",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    drop_scratch(spark)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
