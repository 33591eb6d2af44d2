"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data
and cores; ``BENCH_ALL=1`` runs every query. Inputs are derived and written
before anything is timed. Each query runs to the end into a sink that discards
rows: once to warm the JVM and Python workers, then three times, of which the
median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blockloom.session import build_session  # noqa: E402
from workload import fixtures  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

RUNS = 3
HEADLINE = (
    "decoded_logs",
    "erc20_transfer",
    "erc20_transfer_exact",
    "topic_filter",
    "parse_num",
    "uint256_double",
    "uint256_exact",
    "log_pages_typed",
    "transactions_typed",
    "page_completeness",
    "append_distinct",
    "append_latest_by_key",
    "new_rows",
    "resume_block",
    "chunk_plan",
    "block_at_time",
    "not_null_transfer",
    "stablecoin_history",
    "token_price",
    "price_ohlc",
    "revenue_breakdown",
    "event_catalog",
    "event_labels",
    "decoded_params",
    "stream_dedup_logs",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    fixtures.prepare(spark, sf_dir)
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
