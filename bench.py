"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and ``BENCH_REPEATS`` the runs per query, of which the
median counts. Every run starts from the raw tables, writes its own intermediate tables and produces all result rows.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from caremeld.session import local_session, remove_intermediate
from verification.queries import QUERIES

HEADLINE = [
    "person",
    "condition_occurrence",
    "measurement",
    "observation_period",
    "mutations_deid",
    "unique_patients",
    "recon_mapping",
    "reconciliation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session("bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - started
        remove_intermediate(spark)
        return seconds

    run("unique_patients")  # starts the JVM's compilers; not counted
    seconds = {name: round(statistics.median(run(name) for _ in range(repeats)), 3) for name in HEADLINE}
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
