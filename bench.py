"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1)  BENCH_CPUS (default: all)
    BENCH_RUNS (default 3)

Each query is written to the ``noop`` sink (full execution, no output cost)
once to warm up, then ``BENCH_RUNS`` times; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline import schema  # noqa: E402
from tideline.operators import windows  # noqa: E402
from tideline.plans import catalog  # noqa: E402
from tideline.session import get_session, scratch_path  # noqa: E402
from tideline.streaming.runner import file_stream  # noqa: E402

HEADLINE = [
    "tumbling_reduce", "sliding_topn", "interval_join", "interval_join_plain", "over_range_count",
    "late_data_split", "allowed_lateness", "running_top3", "running_sum", "session_window",
    "word_count_running", "word_count_final", "broadcast_threshold", "group_sum_changelog",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", app="tideline-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    out: dict[str, float] = {}
    for name in names:
        q = catalog.QUERIES[name]
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(runs):
            t = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        out[name] = round(statistics.median(times), 3)
    stream_rows_per_s = None
    if not os.environ.get("BENCH_QUERIES"):
        out["stream_tumbling_reduce"], stream_rows_per_s = stream_bench(spark, sf_dir, runs)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_query_time_sum", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": int(cpus), "runs": runs,
                      "stream_rows_per_s": stream_rows_per_s}))
    spark.stop()


def stream_bench(spark, sf_dir: str, runs: int) -> tuple[float, float]:
    """The sensor readings as 16 arrival-ordered files, consumed as a stream
    (tumbling reduce, 1 day, watermark 1 h, ``noop`` sink, availableNow)."""
    src = scratch_path(spark, f"bench-stream-{time.time_ns()}")
    data = schema.sensor_arrivals(spark, sf_dir)
    data.repartitionByRange(16, "seq").sortWithinPartitions("seq").write.parquet(src)
    n = data.count()
    times = []
    for i in range(runs + 1):
        s = windows.with_watermark(file_stream(spark, src, schema.SENSOR_SEQ, max_files_per_trigger=4), 3600)
        q = (windows.tumbling_reduce(s, 86400).writeStream.format("noop").outputMode("append")
             .option("checkpointLocation", f"{src}-ckpt-{i}").trigger(availableNow=True))
        t = time.perf_counter()
        q.start().awaitTermination()
        if i:  # first run is the warm-up
            times.append(time.perf_counter() - t)
    med = statistics.median(times)
    return round(med, 3), round(n / med, 1)


if __name__ == "__main__":
    main()
