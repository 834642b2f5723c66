"""Counts of a running router, observed on the rows as they pass: no extra pass or shuffle."""

import logging
import threading
from collections import Counter

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sluicegate.functions.errors import CODES, error_text

OBSERVATION = "routing"
log = logging.getLogger(__name__)


def routing_counts(topics, style="code"):
    """Columns that count all messages, those per topic, and those per error code.

    ``style`` is the router's ``error_style``: a code is counted by the text it has there."""
    counts = [F.count(F.lit(1)).alias("total")]
    counts += [F.count_if(F.col("topic") == t).alias(f"topic_{i}") for i, t in enumerate(topics)]
    for code in CODES:
        text = error_text(F.lit(code), F.col("value"), style)
        counts.append(F.count_if(F.col("error") == text).alias(code))
    return counts


def observe_routing(routed, topics, style="code"):
    """Count all messages, those per topic, and those per error code, as they pass."""
    return routed.observe(OBSERVATION, *routing_counts(topics, style))


#: Sketches of a topic's messages: constant memory for any number of them.
SKETCHES = (
    ("keys", lambda chosen: F.hll_sketch_agg(F.when(chosen, F.col("key")))),
    ("sizes", lambda chosen: F.kll_sketch_agg_bigint(F.when(chosen, F.octet_length("value").cast("bigint")))),
)


def sketch_columns(topics):
    """Per topic a sketch of the different keys and one of the values' sizes."""
    return [
        made(F.col("topic") == topic).alias(f"{name}_{i}")
        for i, topic in enumerate(topics)
        for name, made in SKETCHES
    ]


class BatchCounts:
    """Counts and sketches of the batches that a router hands to its writers, added up.

    A batch that is repeated counts once.  Kept: totals, one merged sketch per topic and kind,
    and the last batch's number, per query."""

    def __init__(self, spark, topics, style="code", sketches=True):
        self.spark, self.topics, self.style, self.sketches = spark, list(topics), style, sketches
        self.counted = {}  # query: (last batch, totals, sketches)

    def columns(self):
        return routing_counts(self.topics, self.style) + (
            sketch_columns(self.topics) if self.sketches else []
        )

    def add(self, run, batch_id, row):
        last, total, merged = self.counted.get(run, (-1, Counter(), {}))
        if batch_id <= last:
            return
        names = {f"topic_{i}": t for i, t in enumerate(self.topics)}
        kinds = {f"{n}_{i}": (n, t) for i, t in enumerate(self.topics) for n, _ in SKETCHES}
        total.update({names.get(k, k): v for k, v in row.items() if k not in kinds})
        found = {kinds[k]: v for k, v in row.items() if k in kinds and v is not None}
        self.counted[run] = (batch_id, total, self._merged(merged, found))
        log.info("routed so far: %s", dict(total))

    def _merged(self, old, new):
        """Sketches put together two by two, in one query over a single row."""
        both = [k for k in new if k in old]
        if not both:
            return {**old, **new}
        union = {"keys": "hll_union(unhex('{}'), unhex('{}'))", "sizes": "kll_sketch_merge_bigint(unhex('{}'), unhex('{}'))"}
        made = [union[k[0]].format(bytes(old[k]).hex(), bytes(new[k]).hex()) for k in both]
        row = self.spark.sql("select " + ", ".join(f"{m} as c{i}" for i, m in enumerate(made))).head()
        return {**old, **new, **dict(zip(both, row))}

    def totals(self, run):
        """Counts by name."""
        return dict(self.counted.get(run, (-1, {}, {}))[1])

    def shapes(self, run, ranks=(0.5, 0.99)):
        """Rows (topic, different keys, value sizes at the ranks) of the topics that got messages."""
        merged = self.counted.get(run, (-1, {}, {}))[2]
        rows = []
        for topic in self.topics:
            keys, sizes = merged.get(("keys", topic)), merged.get(("sizes", topic))
            if keys is None or sizes is None:
                continue
            at = ", ".join(str(float(r)) for r in ranks)
            sql = (
                f"select hll_sketch_estimate(unhex('{bytes(keys).hex()}')), "
                f"kll_sketch_get_n_bigint(unhex('{bytes(sizes).hex()}')), "
                f"if(kll_sketch_get_n_bigint(unhex('{bytes(sizes).hex()}')) > 0, "
                f"kll_sketch_get_quantile_bigint(unhex('{bytes(sizes).hex()}'), array({at})), null)"
            )
            different, n, quantiles = self.spark.sql(sql).head()
            if n:
                rows.append((topic, different, *quantiles))
        return rows


def observed_batch(routed, counts, run, batch_id):
    """The batch's rows, counted by the first action on them, and what adds the counts up after it."""
    seen = Observation()
    observed = routed.observe(seen, *counts.columns())
    return observed, lambda: counts.add(run, batch_id, seen.get)


class RoutingMetrics(StreamingQueryListener):
    """Adds up the observed counts of every micro-batch while the ``with`` block runs.

    A batch that is repeated counts once.  Only totals and the last batch's number are kept."""

    def __init__(self, spark, topics):
        self.spark = spark
        self.names = {f"topic_{i}": t for i, t in enumerate(topics)}
        self.counted = {}  # query: (last batch, totals)
        self.ended = {}

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        """Adds up a batch's counts, and logs them for whoever collects the job's metrics."""
        progress = event.progress
        if OBSERVATION in progress.observedMetrics:
            row = progress.observedMetrics[OBSERVATION].asDict()
            last, total = self.counted.get(str(progress.id), (-1, Counter()))
            if progress.batchId > last:
                total.update({self.names.get(k, k): v for k, v in row.items()})
                self.counted[str(progress.id)] = (progress.batchId, total)
                log.info("routed so far: %s", dict(total))

    def onQueryTerminated(self, event):
        self._end(event.id).set()

    def _end(self, query_id):
        return self.ended.setdefault(str(query_id), threading.Event())

    def totals(self, query, timeout=60):
        """Counts by name so far; for a query that has ended, all of them."""
        if not query.isActive and not self._end(query.id).wait(timeout):
            raise TimeoutError("the last progress reports of the query have not arrived")
        return dict(self.counted.get(str(query.id), (-1, {}))[1])
