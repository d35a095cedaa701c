"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8)
choose the data and the number of cores. Every query runs once to warm up and
then ``BENCH_RUNS`` (default 3) times; the median counts. All rows are
computed and thrown away, none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tickwell.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "ohlcv_bars_hourly",
    "ohlcv_bars_auto_width",
    "series_resample_mean",
    "moving_averages",
    "rsi_14",
    "bollinger_20",
    "macd",
    "returns",
    "bar_indicators",
    "ohlcv_stats",
    "tick_stats",
    "financial_reports",
    "latest_fact",
    "report_text",
    "impute_scale",
    "similarity_topk",
    "ivf_search",
    "hash_embedding",
    "expansion_union",
    "rerank",
    "answer_context",
    "token_sequences",
    "token_batches",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "12g"))

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries, each the median of warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
