"""Counts of routed messages."""

from pyspark.sql import functions as F


def routing_summary(routed):
    """Messages per topic and error; counted per task before the shuffle."""
    return routed.groupBy("topic", "error").agg(F.count("*").alias("n"))


def branch_counts(routed):
    """Messages per verdict; the two add up to the input."""
    branch = F.when(F.col("error").isNull(), "valid").otherwise("error").alias("branch")
    return routed.groupBy(branch).agg(F.count("*").alias("n"))
