"""Session helpers: settings worth having, and where shared scratch data goes."""

import tempfile
import uuid

# A topic per output partition: with concurrent writers a task keeps one file open per
# topic instead of sorting its rows by topic first (it falls back to sorting beyond that).
SETTINGS = {
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}


def work_dir(spark, name):
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session, as in tests, may fall back to a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="sluicegate-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
