"""The driver contract, in a process of its own."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
spark = builder.config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as entry
assert set(entry.oracle_sql()) <= set(entry.queries())
assert set(entry.QUERIES) <= set(entry.oracle_sql())
rows = entry.entry(spark).collect()
print("ROWS", len(rows), sorted({r.error or "" for r in rows}))
"""


def test_entry_runs_where_workers_cannot_import_the_package(tmp_path):
    """Only the driver knows the package: the decoder travels inside its UDF."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(REPO)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    expected = ["", "bad_wire_header", "decode_failed", "empty_value", "unknown_schema"]
    assert f"ROWS 1000 {expected}" in done.stdout
