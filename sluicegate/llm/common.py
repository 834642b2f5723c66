"""Helpers that several operators share."""

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluicegate.session import work_dir


#: Spark then removes the files of a frame's shuffles when its action ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(frame):
    """The rows, written once to the cluster's shared checkpoint folder; lineage ends there.

    What was shuffled for them is removed at once, not when the driver's memory happens to be collected."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(
            frame.sparkSession.conf.get("spark.checkpoint.dir", None)
            or work_dir(frame.sparkSession, "checkpoint")
        )
    conf = frame.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return frame.select("*").checkpoint()  # a new frame, as the setting is read where a frame is made
    finally:
        conf.set(CLEANUP, before)


def text_batches(frame):
    """Bounds the Arrow batches of texts by 8 MB, unless the session has a bound of its own.

    Spark's bound of 64 MB is met several times over in each worker and in the JVM beside it; batches
    of short rows are bounded by their rows and do not change."""
    conf, name = frame.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not conf._jconf.contains(name):
        conf.set(name, "8m")


def row_key(id_column, text_column):
    """64 bits that tell rows apart; rows that repeat id and text share it."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


def let(value, then):
    """``then(value)``, with the value computed once: a lambda's body is evaluated for each
    element, and a plain column in it would be computed each time."""
    return F.get(F.transform(F.array(value), lambda v: then(v)), F.lit(0))


def partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(frame, keys, order, name, salts):
    """Adds ``name``: 0, 1, 2, ... without gaps within ``keys``, any number of rows per key.

    Rows of a key are dealt into ``salts`` parts by a hash of ``order``; parts are numbered
    apart and moved up by the rows of the parts before.  ``frame`` is read twice."""
    dealt = frame.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(salts)))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        dealt.groupBy(*keys, "_part")
        .agg(F.count("*").alias("_rows"))
        .select(*keys, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    )
    within = Window.partitionBy(*keys, "_part").orderBy(*order)
    return (
        dealt.withColumn("_place", F.row_number().over(within) - 1)
        .join(first, [*keys, "_part"])
        .withColumn(name, (F.col("_first") + F.col("_place")).cast("long"))
        .drop("_part", "_place", "_first")
    )


def tidy(work):
    """``work`` on batches, giving freed memory back to the system at the end of a task.

    Python workers live on from stage to stage, and what one leaves would count for the next."""

    def then_release(batches):
        try:
            yield from work(batches)
        finally:
            import ctypes
            import gc

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim:
                trim(0)

    return then_release


def whole_groups(batches, keys, rows):
    """Tables of at least ``rows`` rows that never split a run of equal ``keys``."""
    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = [table.column(k)[-1] for k in keys]
        cut = table.num_rows - 1
        low, high = 0, cut  # the first row of the last group, by bisection
        while low < high:
            middle = (low + high) // 2
            if all(table.column(k)[middle] == v for k, v in zip(keys, last)):
                high = middle
            else:
                low = middle + 1
        if low:
            yield table.slice(0, low)
        rest = table.slice(low)
        held, count = rest.to_batches(), rest.num_rows
        if count >= rows:
            rows = 2 * count  # a group larger than a chunk: look for its end less often
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
