"""Wire split as a step on messages."""

from pyspark.sql import functions as F

from sluicegate.functions.wire import payload, schema_id, wire_error


def split_wire(messages, policy="strict"):
    """Add ``schema_id, payload, wire_error``; no Python, no shuffle.

    ``payload`` is a column of its own, so a plan that does not use it does not make it."""
    value = F.col("value")
    found = messages.withColumns(
        {"schema_id": schema_id(value), "wire_error": wire_error(value, policy)}
    )
    body = payload(value, F.col("schema_id"), F.col("wire_error"))
    return found.select(*messages.columns, "schema_id", body.alias("payload"), "wire_error")
