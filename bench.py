"""Times the registered market queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query runs $BENCH_RUNS times (2 unless set) and counts with its best: the first run
also plans and compiles. $BENCH_QUERIES names a choice of them.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from tickbars.plans.queries import QUERIES
from tickbars.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "tickbars-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            # All tasks of a local session run on this machine.
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tickbars-bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One unmeasured run starts the JVM's compilers.
    QUERIES["ohlc_60m"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(QUERIES)).split(","):
        taken = []
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(min(taken), 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
