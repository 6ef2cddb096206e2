"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores.  Every query runs once to warm up and is then timed
writing its whole result to the no-op sink, building the plan included.  What
queries store goes to a temporary shared folder that is deleted at the end.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from modelspend.config import session_settings
from modelspend.registry import QUERIES

HEADLINE = (
    "usage_overlap_pairs",
    "usage_period_totals",
    "usage_allocation",
    "window_containment",
    "execution_query_join_left",
    "fact_usage_split",
    "fact_credits",
    "fact_bytes_slots",
    "fact_rpu",
    "fact_node_time",
    "daily_savings_usage",
    "daily_savings_credits",
    "daily_savings_bytes",
    "savings_summary",
    "ingest_executions",
    "ingest_job_runs",
    "snapshot_by_check",
)


def session(cpus: str, shared: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("modelspend-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", shared)
    )
    for key, value in session_settings().items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(spark: SparkSession, sf_dir: str, cpus: str, to: str) -> str:
    """A copy of the test tables whose ``events`` are as many files as there are cores.

    The given file is one row group, which one task would read while the others wait;
    histories of any size worth timing are many files.
    """
    os.makedirs(to)
    for name in os.listdir(sf_dir):
        if name != "events.parquet":
            os.symlink(os.path.abspath(os.path.join(sf_dir, name)), os.path.join(to, name))
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(int(cpus)).write.parquet(f"{to}/events.parquet")
    return to


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    given = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    seconds = {}
    with tempfile.TemporaryDirectory(prefix="modelspend-bench-") as shared:
        cpus = os.environ.get("BENCH_CPUS", "8")
        spark = session(cpus, f"{shared}/stages")
        sf_dir = spread(spark, given, cpus, f"{shared}/tables")
        for name in names or HEADLINE:
            run(spark, name, sf_dir)
            seconds[name] = round(run(spark, name, sf_dir), 3)
        spark.stop()
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(given)).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main(sys.argv[1:])
