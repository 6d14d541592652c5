"""Time every registered query; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS``
the timed runs per query (the best one counts).  A query is timed from the call that
builds it, since some write tables on the way, to the last row of its result.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from estrato.plans.registered import all_queries  # noqa: E402
from estrato.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, shuffle_partitions=8)

    def once(query, where: str) -> float:
        start = time.perf_counter()
        query(spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    small = str(Path(sf_dir).parent / "sf0.001")
    timings = {}
    for name, (query, _) in all_queries().items():
        if os.path.isdir(small):
            once(query, small)  # warm-up: classes and generated code
        timings[name] = round(min(once(query, sf_dir) for _ in range(runs)), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": timings,
        "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
