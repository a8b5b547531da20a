"""Times the headline queries at one scale and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue.queries import QUERIES  # noqa: E402
from trendloom.session import local_session  # noqa: E402

HEADLINE = (
    "all_points",
    "count_trends_multi",
    "service_rollup",
    "duration_stats_1m",
    "duration_stats_rollup",
    "stats_long",
    "strict_counts",
    "strict_duration",
    "strict_dense",
    "late_points",
    "quality_summary",
    "time_in_topic",
    "keyed_sink",
    "stream_counts",
    "stream_strict",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # One small query first, so that the first measured one does not pay for starting up.
    QUERIES["valid_spans"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "trend_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
