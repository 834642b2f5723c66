"""Several streaming queries that belong together: one that fails ends all."""

import time

from pyspark.errors import StreamingQueryException


def run_together(spark, queries, grace=600, poll=1):
    """Wait until all queries have ended; when one fails, stop the others and raise its failure.

    The others may finish the batch they are at, for at most ``grace`` seconds each."""
    left = list(queries)
    while left:
        failed = next((q for q in left if not q.isActive and q.exception() is not None), None)
        if failed is not None:
            for query in left:
                if query is not failed:
                    stop_after_batch(query, grace)
            raise failed.exception()
        left = [q for q in left if q.isActive]
        if left:
            try:  # any query of the session; whether it is one of these is seen above
                spark.streams.awaitAnyTermination(poll)
            except StreamingQueryException:
                pass
            spark.streams.resetTerminated()
    return queries


def last_batch(query):
    return query.lastProgress["batchId"] if query.lastProgress else None


def stop_after_batch(query, grace):
    """Stop a query between two batches, or in one that takes longer than ``grace`` seconds."""
    deadline, at = time.monotonic() + grace, last_batch(query)
    while query.isActive and query.status["isTriggerActive"] and last_batch(query) == at:
        if time.monotonic() > deadline:
            break
        time.sleep(0.1)
    query.stop()
