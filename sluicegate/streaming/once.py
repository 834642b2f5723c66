"""Appending to a table that cannot replace what an earlier attempt wrote, each row once."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

KEY = ("source_topic", "partition", "offset")
MOST_SPANS = 500  # conditions in one filter; more topic partitions are covered by a coarser one


def spans(rows):
    """First and last offset of each topic partition among the rows: a row per topic partition."""
    return rows.groupBy("source_topic", "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last")
    )


def same(name, value):
    return F.col(name).isNull() if value is None else F.col(name) == F.lit(value)


def within(table, found):
    """Rows of a table that lie in spans (or not far from them): a filter that its source can use."""
    if not found:
        return table.where(F.lit(False))
    if len(found) <= MOST_SPANS:
        each = [
            same("source_topic", s.source_topic)
            & same("partition", s["partition"])
            & F.col("offset").between(s["first"], s["last"])
            for s in found
        ]
        return table.where(reduce(or_, each))
    known = [s for s in found if s["first"] is not None]
    return table.where(
        F.col("offset").between(min(s["first"] for s in known), max(s["last"] for s in known))
    )


def missing(rows, table, key=KEY):
    """The rows whose key the table does not have; reads only the part of it that may have them."""
    there = within(table, spans(rows).collect()).select(*[F.col(c).alias(f"_{c}") for c in key])
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    return rows.join(there, equal, "left_anti")


def append_once(rows, append, existing, begun, key=KEY):
    """Append the rows of a micro-batch through ``append(rows)``.

    ``begun``: whether an earlier attempt of the batch may have appended some of them (see
    ``Ledger.begun``).  If so, only those that ``existing()``, the table as it is, does not have go again;
    a first attempt reads nothing.  A task that is repeated within one attempt is the table's to refuse,
    by a unique key over ``key``: the batch then fails, and its next attempt adds what is missing."""
    append(missing(rows, existing(), key) if begun else rows)
