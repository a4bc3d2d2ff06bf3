"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, median).
Every row of a result is produced: it is written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluiceway.session import build_session  # noqa: E402
from suite.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "flagship_load", "rule_pseudonymize", "incr_cursor", "incr_two_runs_state", "dedup_pk", "dedup_sort_desc",
    "merge_delete_insert_pk", "merge_delete_insert_merge_key", "merge_delete_insert_both", "merge_hard_delete_bool",
    "merge_upsert", "merge_composite_key", "merge_child_tables", "scd2_snapshot", "scd2_three_runs", "scd2_natural_key",
    "scd2_partition_key", "norm_flatten", "norm_child_table", "norm_row_id", "decode_json", "write_append",
    "write_replace_staging", "sink_parquet_roundtrip", "stream_append", "stream_upsert", "metrics_observe", "manifest_dispositions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    QUERIES["flagship_load"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up, not timed
    seconds: dict[str, float] = {}
    for name in wanted:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(found.group(1)) if found else None, "cores": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
