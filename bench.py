"""Time the headline queries: one warm-up, then the median of three runs.

The test tables are single files, which one task would read.  They are copied
into a file per core first, as larger tables would have; that is not timed.
Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from mailloom.plans.queries import all_queries
from mailloom.session import build_session

HEADLINE = (
    "contacts_consolidated", "contacts_extracted", "contacts_text", "visible_text_length",
    "url_normalized", "base_domain_counts", "links_extracted", "links_ranked_topk",
    "page_diagnostics", "reply_class_counts", "campaign_replies", "suppressed_recipients",
    "send_plan", "open_fold", "master_tracking", "funnel_metrics",
)
TABLES = ("pages", "documents", "conversations", "events", "customer", "nation")
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    found = all_queries()
    split = tempfile.mkdtemp(prefix="bench-")
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(int(cpus)).write.parquet(f"{split}/{table}.parquet")

    def once(name: str) -> float:
        start = time.perf_counter()
        found[name](spark, split).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "shuffle_partitions": int(cpus), "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
