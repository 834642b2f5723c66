"""Verdict and output form of a decoded message."""

from pyspark.sql import functions as F

from sluicegate.functions.errors import NO_ROUTE_MATCHED, error_headers, error_text

HEADERS = "array<struct<key:string,value:binary>>"


def classify(routed, config):
    """Add ``error``: the first reason that applies, null for a valid message."""
    code = F.coalesce(
        "wire_error", "decode_error", F.when(F.col("bucket").isNull(), NO_ROUTE_MATCHED)
    )
    error = error_text(F.col("code"), F.col("value"), config.error_style)
    return routed.withColumn("code", code).withColumn("error", error).drop("code")


def to_output(classified, config, keep=()):
    """One output row per message: original bytes, headers and topic by verdict.

    Valid messages keep their headers and go to ``<prefix>_<bucket>``; the others go to the
    errors topic with the reason as their only header.  The input's ``topic`` becomes
    ``source_topic``; the columns in ``keep`` and ``bucket``, ``error`` follow."""
    valid = F.col("error").isNull()
    topic = F.concat(F.lit(config.topic_prefix + "_"), F.col("bucket"))
    headers = F.col("headers") if "headers" in classified.columns else F.lit(None).cast(HEADERS)
    return classified.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value"),
        F.when(valid, headers).otherwise(error_headers(F.col("error"))).alias("headers"),
        F.when(valid, topic).otherwise(F.lit(config.errors_topic)).alias("topic"),
        *[F.col("topic").alias("source_topic") if c == "topic" else F.col(c) for c in keep],
        F.when(valid, F.col("bucket")).alias("bucket"),
        F.col("error"),
    )


def valid_messages(routed):
    """The rows for the route topics."""
    return routed.where(F.col("error").isNull())


def rejected_messages(routed):
    """The rows for the errors topic."""
    return routed.where(F.col("error").isNotNull())
