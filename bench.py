"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each time is the median of ``$BENCH_RUNS`` runs (default 5) after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from surgelens.registry.queries import QUERIES  # noqa: E402
from surgelens.session import build_session  # noqa: E402

HEADLINE = [
    "minute_counts",
    "waf_hotspots",
    "union_hotspots",
    "sliding_windows",
    "ewma_mean",
    "ewma_std",
    "baseline_train",
    "detect_prior",
    "detect_last_prior",
    "detect_post_update",
    "topk_anomalies",
    "detection_cycle",
    "ioc_cidr",
    "ioc_cidr_v6",
    "ioc_regex",
    "ioc_combined",
    "waf_json_scan",
    "alert_rows",
    "cusum_alarms",
    "ioc_asn",
    "ioc_many_patterns",
    "detect_silent",
    "saved_cycle",
    "stream_accounted",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("surgelens-bench", master=f"local[{cpus}]", cpus=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 4)
    version = spark.version
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "median seconds per query, summed",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
                "spark": version,
            }
        )
    )


if __name__ == "__main__":
    main()
