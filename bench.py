"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every query is built and run in full, its rows going to the no-op sink; the better of two runs
counts. Query names on the command line replace the default list.
"""

from __future__ import annotations

import json
import os
import sys
import time

from threadloom.registry import QUERIES
from threadloom.session import get_spark

HEADLINES = [
    "a1_forum_stats",
    "x1_records",
    "x1_nested_records",
    "x3_joined_paragraphs",
    "x4_element_text",
    "x7_autohome",
    "x7_tesla",
    "x7_tieba",
    "x8_autohome",
    "x8_tieba",
    "x8_tesla",
    "p2_dates_rel",
    "p3_clean_inline",
    "p4_clean_block",
    "p6_utc",
    "f1_keyword",
    "f2_date_range",
    "f3_link_filter",
    "f8_accepted",
    "f11_dedupe",
    "w1_page_cap",
    "w2_page_prefix",
    "s5_worklist_csv",
    "r1_stream",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    seconds = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
