"""Messages whose schema is not registered yet.

A message that names an unknown schema id is an error at once in the plain router.  Here it waits: each
micro-batch stores the messages that wait and takes up those that its predecessor stored.  A message
leaves with the first batch that knows its schema, or as an error with the first that starts ``hold`` seconds
after the batch it came with.  Waiting messages are files, written and read in parallel, with no limit to
their number and no shuffle, so a schema id that most messages name is no hot key.

Two folders take turns: a batch replaces the one and reads the other, so a replay finds what its first
attempt found.  The clock is the ledger's, so a replay decides alike.  Messages leave only when a batch
runs: a stopped or idle stream keeps them until it goes on."""

from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluicegate.operators.schemas import attach_schema
from sluicegate.operators.wire import split_wire

SINCE = "_waits_since"


def waiting(messages, path, batch_id):
    """The messages that the batch before left waiting, or None."""
    try:
        found = messages.sparkSession.read.parquet(f"{path}/turn={(batch_id - 1) % 2}")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return found.where(F.col("_batch") == batch_id - 1)


def with_waiting(messages, path, batch_id, started):
    """The batch's messages and those that wait, with the time each came."""
    came = messages.withColumn(SINCE, F.lit(started))
    before = waiting(messages, path, batch_id)
    return came if before is None else came.unionByName(before.drop("_batch"))


def unknown_schema(messages, registry, config):
    """The messages with ``_unknown``: whether they name a schema id that is not registered."""
    split = split_wire(messages, config.wire)
    registry = registry.in_use(split)
    if registry.texts is None:  # too large even so: join ids alone
        registry = replace(registry, table=registry.table.withColumn("schema_json", F.lit("")))
    attached = attach_schema(split, registry)
    unknown = F.coalesce(~F.col("known"), F.lit(False))
    return attached.select(*messages.columns, unknown.alias("_unknown"))


def hold_unknown(messages, registry, config, path, batch_id, started, hold):
    """The messages that go on with this batch; those that wait are stored for the next."""
    judged = unknown_schema(with_waiting(messages, path, batch_id, started), registry, config)
    waits = F.col("_unknown") & (F.lit(started) - F.col(SINCE) < F.lit(float(hold)))
    left = judged.where(waits).drop("_unknown").withColumn("_batch", F.lit(batch_id).cast("bigint"))
    left.write.mode("overwrite").parquet(f"{path}/turn={batch_id % 2}")
    return judged.where(~waits).drop("_unknown", SINCE)
