"""Sinks for routed messages.

The plain sinks take one routed DataFrame with both verdicts, so a message is decoded
once.  The batch writers are for ``foreachBatch``: a replayed batch overwrites its own
``batch_id`` folder, so file output holds each message once."""

from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import functions as F

from sluicegate.operators.classify import rejected_messages, valid_messages
from sluicegate.sources.kafka import sink_options
from sluicegate.sources.tables import jdbc_options

SINK_COLUMNS = ("key", "value", "headers", "topic")


def _started(writer, checkpoint, once, name):
    if once:
        writer = writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).outputMode("append").start()


def to_kafka(routed, config, checkpoint="", once=False, name=""):
    """Both verdicts to Kafka in one query."""
    writer = routed.select(*SINK_COLUMNS).writeStream.format("kafka")
    writer = writer.options(**sink_options(config))
    return _started(writer, checkpoint or config.checkpoint, once, name)


def to_files(routed, path, checkpoint, once=False, name=""):
    """Both verdicts to files by topic; each file is written once even after a restart."""
    writer = routed.writeStream.format("parquet").option("path", path).partitionBy("topic")
    return _started(writer, checkpoint, once, name)


def to_batches(stream, step, checkpoint, once=False, name=""):
    """Hand every micro-batch to ``step(batch, batch_id)``."""
    return _started(stream.writeStream.foreachBatch(step), checkpoint, once, name)


def run_id(rows):
    """The id of the streaming query that hands out ``rows``; it lasts as long as its checkpoint."""
    found = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return found or "none"


def write_batch(rows, path, batch_id, by=()):
    """Write one micro-batch to its own folder of ``path``, replacing an earlier attempt.

    A query with a new checkpoint counts its batches from 0 again, so the folder also holds the
    query's id: what an earlier query wrote stays."""
    folder = f"{path}/run={run_id(rows)}/batch_id={batch_id}"
    rows.write.mode("overwrite").partitionBy(*by).parquet(folder)


@contextmanager
def persisted(rows, keep=False):
    """With ``keep``, rows that several writes read are read and decoded once; spills to disk,
    and a lost executor's part is computed again.  Rows kept already stay so.

    Keeping has its price: from files, reading and decoding small messages again for a
    second sink took a quarter less time."""
    kept_here = keep and rows.storageLevel == StorageLevel.NONE
    if kept_here:
        rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        if kept_here:
            rows.unpersist()


def write_branches(routed, valid_path, errors_path, batch_id, keep=False):
    """One micro-batch to two sinks."""
    with persisted(routed, keep):
        write_batch(valid_messages(routed), valid_path, batch_id, by=["topic"])
        write_batch(rejected_messages(routed), errors_path, batch_id)


def sink_of(config=None):
    """Column: the sink of a routed message, ``valid``, ``errors`` or, with a ``config`` that says how
    much a producer takes, ``fallback``."""
    sink = F.when(F.col("error").isNull(), "valid").otherwise("errors")
    return sink if config is None else F.when(oversized(config), "fallback").otherwise(sink)


def write_sinks(routed, path, batch_id, config=None):
    """All sinks of one micro-batch in one write, so its messages are read and decoded once.

    Files lie by sink and topic in the batch's own folder, which a replay replaces as a whole: no
    sink keeps what another attempt wrote."""
    write_batch(routed.withColumn("sink", sink_of(config)), path, batch_id, by=["sink", "topic"])


def staged(routed, path, config=None):
    """One micro-batch as files by sink, for sinks that cannot be written together.

    The batch is read and decoded once, into ``path``, which holds the last batch only; every sink then
    reads its own part of the files.  The rows keep their columns and have ``sink``."""
    folder = f"{path}/run={run_id(routed)}"
    made = routed.withColumn("sink", sink_of(config))
    made.write.mode("overwrite").partitionBy("sink").parquet(folder)
    return routed.sparkSession.read.schema(made.schema).parquet(folder)


def write_staged(rows, write, path, batch_id):
    """Staged rows to ``write(rows)``, those that a producer would refuse to files under ``path``."""
    write(rows.where("sink != 'fallback'").drop("sink"))
    rest = rows.where("sink = 'fallback'").drop("sink")
    if not rest.isEmpty():  # looks at one file of the sink's folder, if there is one
        write_batch(rest, path, batch_id)


def matched_events(routed):
    """Valid messages as rows of the matched-events table.

    The source coordinates are the natural key: an append to a database is repeated when a
    batch is replayed, and duplicates share the key."""
    return valid_messages(routed).select(
        "source_topic",
        "partition",
        "offset",
        F.hex("key").alias("key_hex"),
        "schema_id",
        "route_value",
        "bucket",
        "topic",
    )


def append_to_jdbc(rows, connections=32, **connection):
    """Append rows over at most so many connections, however many tasks there are."""
    options = jdbc_options(**connection) | {"numPartitions": str(connections)}
    rows.write.format("jdbc").options(**options).mode("append").save()


# What a producer adds to the bytes of a message, generously: per message and per header.
MESSAGE_OVERHEAD = 128
HEADER_OVERHEAD = 16


def message_size(key, value, headers):
    """Upper estimate of the bytes a message takes in a producer request."""
    header_bytes = F.aggregate(
        F.coalesce(headers, F.array()),
        F.lit(0),
        lambda total, h: total
        + HEADER_OVERHEAD
        + F.coalesce(F.octet_length(h["key"]), F.lit(0))
        + F.coalesce(F.octet_length(h["value"]), F.lit(0)),
    )
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in (key, value)]
    return sizes[0] + sizes[1] + header_bytes + MESSAGE_OVERHEAD


def oversized(config):
    """Whether a producer would refuse a message for its size."""
    size = message_size(F.col("key"), F.col("value"), F.col("headers"))
    return size > config.max_request_size


def write_with_fallback(routed, config, write, path, batch_id):
    """One micro-batch to ``write(rows)``, without the messages a producer would refuse for
    their size, which would stop the query; those go to files under ``path``."""
    with persisted(routed, config.keep_batches):
        write(routed.where(~oversized(config)))
        rest = routed.where(oversized(config))
        if not rest.isEmpty():
            write_batch(rest, path, batch_id)


SLOTS = 1 << 32


def write_isolating(rows, write, path, batch_id, budget=200, key=("source_topic", "partition", "offset")):
    """One micro-batch to ``write(rows)``, without the messages that it refuses; those go to files.

    A part that is refused is halved, by a hash of its messages' keys, until the refused messages
    are alone; ``write`` takes a part as a whole or not at all.  After ``budget`` attempts the parts still
    refused go to the files as they are: every message is in one of the two places.  A sink that takes no
    part at all is down, and its failure is raised.  Parts are read anew: give stored rows (``staged``)."""
    slot = F.pmod(F.xxhash64(*key), F.lit(SLOTS))
    waiting, refused, accepted, spent, failure = [(0, SLOTS)], [], False, 0, None
    while waiting:
        low, high = waiting.pop()
        part = rows.where((slot >= low) & (slot < high))
        few = part.limit(2).count()
        if not few:
            continue
        if spent >= budget:
            refused.append((low, high))
            continue
        spent += 1
        try:
            write(part)
            accepted = True
        except Exception as e:
            failure = e
            if few == 1 or high - low == 1:
                refused.append((low, high))
            else:
                middle = (low + high) // 2
                waiting += [(middle, high), (low, middle)]
    if refused and not accepted:
        raise failure
    if refused:
        inside = [(slot >= low) & (slot < high) for low, high in refused]
        write_batch(rows.where(reduce(or_, inside)), path, batch_id)


def append_to_kafka(rows, config):
    """One micro-batch to Kafka: the writer for ``write_with_fallback``."""
    rows.select(*SINK_COLUMNS).write.format("kafka").options(**sink_options(config)).save()
