"""Archived messages read like a topic: from a start position, with a report of lost offsets.

The tables have the columns of the Kafka source.  Start positions are written as that source takes them
(``startingOffsets``, ``startingOffsetsByTimestamp``), so a job's setting can be replayed on its archive."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

EARLIEST, LATEST = -2, -1  # fixed values of the source's JSON
POSITIONS = "topic string, partition int, position bigint"
BLOCK = 1_000_000  # offsets looked at together
MOST_POSITIONS = 100_000  # topic partitions with a position of their own that are broadcast


class LostOffsets(ValueError):
    """Offsets are missing in an archive that must be whole."""


def positions(text):
    """``(topic, partition, position)`` rows of a JSON text ``{"topic": {"0": 5}}``."""
    try:
        found = json.loads(text)
        return [(t, int(p), int(at)) for t, parts in found.items() for p, at in parts.items()]
    except (ValueError, AttributeError, TypeError):
        raise ValueError(f"not start positions: {text!r}") from None


def _with_positions(messages, rows):
    """The messages with the ``position`` of their topic partition, null where none is given."""
    table = messages.sparkSession.createDataFrame(rows, POSITIONS)
    side = table.select(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "position")
    side = F.broadcast(side) if len(rows) <= MOST_POSITIONS else side
    same = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
    return messages.join(side, same, "left").drop("_topic", "_partition")


def from_offsets(messages, start="earliest"):
    """Messages from ``start`` on: ``earliest``, ``latest`` (none of those archived) or JSON with an offset, or
    -2 and -1 for these, per topic partition; those that are not named start at the earliest."""
    if start in ("earliest", "latest"):
        return messages if start == "earliest" else messages.where(F.lit(False))
    rows = _with_positions(messages, positions(start))
    at = F.coalesce("position", F.lit(EARLIEST))
    return rows.where((at == EARLIEST) | ((at >= 0) & (F.col("offset") >= at))).drop("position")


def from_timestamps(messages, start):
    """Messages from the first offset on whose timestamp is at or after ``start``: JSON with milliseconds
    since 1970 per topic partition.  Later offsets are read whatever their timestamps; a partition
    without such an offset gives nothing, one that is not named all."""
    rows = _with_positions(messages, positions(start))
    late = F.col("timestamp") >= F.timestamp_millis("position")
    keys = ["topic", "partition"]
    first = (
        rows.where(late).groupBy(*keys).agg(F.min("offset").alias("_first"))  # a row per partition
    ).select(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "_first")
    same = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
    begun = F.col("position").isNull() | (F.col("offset") >= F.col("_first"))
    return rows.join(first, same, "left").where(begun).drop("_topic", "_partition", "_first", "position")


def offset_gaps(messages, block=BLOCK):
    """Offsets missing between a topic partition's first and last: topic, partition, first_missing,
    last_missing, missing.

    Gaps are looked for in blocks of offsets, then between the blocks, so a partition that holds most
    messages is spread over many tasks.  Repeated offsets are no gap; null offsets are not looked at."""
    keys = ["topic", "partition"]
    seen = messages.where("offset is not null").select(
        *keys, "offset", F.floor(F.col("offset") / block).alias("_block")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy("offset")
    follows = seen.select(*keys, "offset", F.lead("offset").over(inside).alias("_next"))
    ends = seen.groupBy(*keys, "_block").agg(F.min("offset").alias("_first"), F.max("offset").alias("offset"))
    between = Window.partitionBy(*keys).orderBy("offset")  # a row per block
    across = ends.select(*keys, "offset", F.lead("_first").over(between).alias("_next"))
    return (
        follows.unionByName(across)
        .where(F.col("_next") > F.col("offset") + 1)
        .select(
            *keys,
            (F.col("offset") + 1).alias("first_missing"),
            (F.col("_next") - 1).alias("last_missing"),
            (F.col("_next") - F.col("offset") - 1).alias("missing"),
        )
    )


def whole(messages):
    """The messages, or ``LostOffsets`` if offsets are missing: an archive's ``failOnDataLoss``."""
    found = offset_gaps(messages).orderBy("topic", "partition", "first_missing").limit(5).collect()
    if found:
        named = [f"{r.topic}-{r.partition}: {r.first_missing} to {r.last_missing}" for r in found]
        raise LostOffsets("missing offsets, the first of them: " + ", ".join(named))
    return messages
