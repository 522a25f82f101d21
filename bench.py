"""Benchmark: wall time of every batch query and some stream twins.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``, materialising the full result through the ``noop``
sink (nothing is collected to the driver).  One warm-up run, then the median
of ``$BENCH_REPEAT`` (default 3) timed runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

STREAMS = ["stream_tumble_count", "stream_interval_join", "stream_order_match"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))

    from eventide.plans.registry import load_all
    from eventide.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="eventide-bench")
    registry = load_all()
    # Every batch query, and some stream twins (each runs micro-batches twice).
    names = sys.argv[1:] or [n for n in registry if not n.startswith("stream_")] + STREAMS
    times: dict[str, float] = {}
    for name in names:
        fn = registry[name].fn

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        # A stream twin takes many micro-batch starts: one run, not warmed up.
        once = name.startswith("stream_")
        if not once:
            run()  # warm-up: JIT, Python workers, file listing
        times[name] = round(statistics.median(run() for _ in range(1 if once else repeat)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
