"""Times all queries on the given tables and prints one JSON line.

Each query runs once on the smallest tables first, if they lie beside the timed ones, so that the times
are not those of a cold JVM.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from gramledger.plans.driver_queries import QUERIES
from gramledger.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "gramledger-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES")
    chosen = names.split(",") if names else list(QUERIES)
    smallest = Path(folder).parent / "sf0.001"
    if smallest.exists():
        for name in chosen:
            QUERIES[name](spark, str(smallest)).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
