"""Hand-written messages for stage tests."""

from sluicegate.plans import fixtures as fx
from sluicegate.sources.tables import MESSAGE_COLUMNS


def messages(spark, values, topic="raw-a"):
    """Messages with the given values (hex or None), offsets counting from 0."""
    rows = [
        (b"k", None if v is None else bytearray.fromhex(v), [("trace", b"1")], topic, 0, i, None, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, MESSAGE_COLUMNS)


def texts(frame, column):
    """One column in offset order."""
    return [r[0] for r in frame.select(column, "offset").orderBy("offset").collect()]


def schemas(spark, *pairs):
    rows = [(fx.SUBJECT, n + 1, i, text) for n, (i, text) in enumerate(pairs)]
    return spark.createDataFrame(rows, "subject string, version bigint, schema_id bigint, schema_json string")


def record(**fields):
    import json

    listed = [{"name": n, "type": t} for n, t in fields.items()]
    return json.dumps({"type": "record", "name": "R", "fields": listed})


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def framed_text(schema_id, body):
    """Hex of a framed value, from the hex of its body."""
    return f"00{schema_id:08x}{body}"
