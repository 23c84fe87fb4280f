"""Time the headline queries and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. Every
query is computed in full into the noop sink; after one warm-up the median of
BENCH_RUNS runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "normalize_urls",
    "shred_facts",
    "deduplicate_page_views",
    "connected_components",
    "normalize_user_ids",
    "page_view_batch_view",
    "uniques_view",
    "traffic_view",
    "analyze_visits",
    "bounces_view",
    "publish_bounces",
    "aggregate_count_sum_average",
    "first_of_group",
    "unique_rows",
    "co_group_inner",
    "co_group_outer",
    "co_group_three_mixed",
    "hash_join_left",
    "group_sorted",
    "custom_aggregate",
    "regex_generator",
    "regex_split_generator",
    "date_parser_fields",
    "trap_rejected_rows",
    "template_sink",
    "delimited_text",
    "ingest_facts",
    "batch_page_views",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(2 * int(cpus)),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        times = []
        for turn in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if turn:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
