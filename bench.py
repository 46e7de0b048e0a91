"""Wall time of the headline queries; prints one JSON line.

Every query runs twice in one session: the first run compiles its plan
("cold"), the second is the reported one. A run covers building the DataFrame
(for rankings and exact quantiles that includes writing their table) and
computing all its rows.

BENCH_SF_DIR   folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: analyses and marts)
BENCH_TWINS    1: also time each query's SQL twin in process, on as many threads
"""

from __future__ import annotations

import json
import os
import time

from workload.check import open_oracle, session
from workload.oracle import oracle_sql
from workload.suite import QUERIES


def timed(spark, folder: str, name: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def twins(folder: str, names: list[str], cpus: int) -> dict[str, float]:
    """Seconds of each query's SQL twin, second run."""
    con, sql, out = open_oracle(folder), oracle_sql(), {}
    con.execute(f"SET threads = {cpus}")
    for name in names:
        for _ in range(2):
            begun = time.perf_counter()
            con.execute(sql[name]).fetchall()
            out[name] = round(time.perf_counter() - begun, 3)
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    asked = os.environ.get("BENCH_QUERIES", "")
    if asked == "all":
        names = list(QUERIES)
    elif asked:
        names = asked.split(",")
    else:
        names = [n for n in QUERIES if n.startswith(("q", "m"))]
    spark = session(cpus)
    cold = {name: timed(spark, folder, name) for name in names}
    warm = {name: timed(spark, folder, name) for name in names}
    marts = [n for n in names if n.startswith("m")]
    more = {}
    if os.environ.get("BENCH_TWINS") == "1":
        more["twin_queries"] = twins(folder, names, cpus)
        more["twin_value"] = round(sum(more["twin_queries"].values()), 3)
    print(
        json.dumps(
            more
            | {
                "metric": "total query wall time, second run",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in warm.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "cold_value": round(sum(cold.values()), 3),
                "cold_queries": {n: round(s, 3) for n, s in cold.items()},
                "model_build_cold_sec": round(sum(cold[n] for n in marts), 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
