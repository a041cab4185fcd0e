"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of sample tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_MEMORY   heap of the one local process (default 16g)
BENCH_REPLICAS copies of the events for the ``replica`` run (default 15: 1.5 M events at sf0.1; 0: none)

``build_*`` entries write each upstream table from nothing; the queries after
them read those tables and compute their own operator in full. Everything runs
twice in one process: ``cold`` is the first run, ``queries`` the second, when
the JVM has compiled the code.

``replica`` times every table of the warehouse once, built in order from that
many copies of the events and customers with shifted ids; ``replica_total`` is
their sum.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from questlog.plans.catalog import QUERIES
from questlog.plans.store import Store
from questlog.session import build_session, scratch_dir

# Chained upstream tables, each from the one before it.
BUILD = ["events_clean", "sessions", "users_dim", "monetization_summary"]


def _timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def _replicate(spark: SparkSession, sf_dir: str, copies: int) -> str:
    """Folder with ``copies`` of the events and customers, each under ids of its own."""
    folder = scratch_dir(spark, "replica")
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    for table, ids in (("events", ["event_id", "user_id"]), ("customer", ["c_custkey"])):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        shift = {i: 1_000_000_000_000 if i == "event_id" else 10_000_000 for i in ids}
        shifted = {i: (F.col(i) + F.col("copy") * by).cast(rows.schema[i].dataType) for i, by in shift.items()}
        rows.select("*", copy).withColumns(shifted).drop("copy").write.parquet(f"{folder}/{table}.parquet")
    return folder


def _replica_run(spark: SparkSession, sf_dir: str, copies: int) -> dict[str, float]:
    folder = _replicate(spark, sf_dir, copies)
    store, timings = Store(spark, folder, fresh=True), {}
    for table in BUILD:
        timings[f"build_{table}"] = _timed(lambda t=table: getattr(store, t))
    for name in QUERIES:
        if name.startswith(("mart_", "dq_checks")):
            query = QUERIES[name]
            timings[name] = _timed(lambda q=query: q(spark, folder).write.format("noop").mode("overwrite").save())
    return timings


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "questlog-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode(
            "overwrite"
        ).save()

    only = sys.argv[1:]

    def measure() -> dict[str, float]:
        timings: dict[str, float] = {}
        store = Store(spark, sf_dir, fresh=True)
        for table in BUILD:
            timings[f"build_{table}"] = _timed(lambda t=table: getattr(store, t))
        for name in QUERIES:
            if not only or name in only:
                timings[name] = _timed(run(name))
        return timings

    cold, timings = measure(), measure()
    copies = int(os.environ.get("BENCH_REPLICAS", "15"))
    replica = _replica_run(spark, sf_dir, copies) if copies else {}
    result = {
        "metric": "total wall time of all queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "cold": cold,
        "replica": replica,
        "replica_total": round(sum(replica.values()), 3),
        "replicas": copies,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
