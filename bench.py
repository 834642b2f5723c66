"""Seconds per headline query on one machine; prints one JSON line.

``BENCH_SF_DIR`` is the data folder and ``BENCH_CPUS`` the number of cores.  Results go to
Spark's noop sink; streaming queries write and read back their output."""

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from sluicegate.plans.queries import QUERIES, events
from sluicegate.session import SETTINGS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3  # the fastest counts

HEADLINE = (
    "q_wire_split",
    "q_schema_attach",
    "q_decode_phone",
    "q_decode_full",
    "q_decode_types",
    "q_decode_large_registry",
    "q_decode_joined_registry",
    "q_route_first",
    "q_route_many_rules",
    "q_route_1000_rules",
    "q_routed_all",
    "q_errors_out",
    "q_valid_out",
    "q_routing_summary",
    "q_stream_route",
    "q_foreachbatch",
)


def session():
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("sluicegate-bench")
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    builder = builder.config("spark.sql.shuffle.partitions", CPUS)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark, name):
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    spark = session()
    messages = events(spark, SF_DIR).count()
    times = {}
    for name in HEADLINE:
        times[name] = round(min(seconds(spark, name) for _ in range(RUNS)), 4)
    two_branches = times["q_errors_out"] + times["q_valid_out"]
    result = {
        "metric": "headline queries, sum of the fastest run of each",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "messages": messages,
        "messages_per_sec": {
            name: round(messages / times[name])
            for name in ("q_wire_split", "q_decode_phone", "q_routed_all")
        },
        "routed_all_vs_two_branches": round(two_branches / times["q_routed_all"], 2),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
