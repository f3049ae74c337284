"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS
(default 3; the median counts) set the conditions; no further round begins that would end after BENCH_SECONDS
(default 720).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from check_queries import local_session
from shopspan.plans.queries import REGISTRY

HEADLINES = (
    "transaction_grain", "customer_weeks", "household_weeks", "undersample", "densify", "tte_discrete",
    "train_sequences", "fit_weibull", "horizon_metrics", "risk_report", "churn_output",
    "annualized_sales", "household_churn", "merge_household_churn", "quality_report", "retention_flow",
)


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = float(os.environ.get("BENCH_SECONDS", "720"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    timed(spark, "household_weeks", folder)  # start-up of the JVM is not a query's time
    began, times = time.perf_counter(), {name: [] for name in HEADLINES}
    for turn in range(runs):
        # Whole rounds, so that every query is measured equally often.
        if turn and (time.perf_counter() - began) * (turn + 1) / turn > seconds:
            break
        for name in HEADLINES:
            times[name].append(timed(spark, name, folder))
    queries = {name: round(statistics.median(t), 3) for name, t in times.items()}
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
