"""Time every registered query; one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_ONLY (comma-separated) a
choice of queries. Results go to a sink that reads every row and stores none.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from concordat.plans.queries import registered  # noqa: E402
from concordat.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = local_session("bench", cores, partitions=int(cores) if cores.isdigit() else 8, memory="12g")
    # Start-up of the JVM and of the Python workers is not what is measured.
    for name in ("load_register", "object_inventory"):
        registered()[name](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, query in registered().items():
        if only and name not in only:
            continue
        started = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name:22s} {times[name]:8.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
