"""Messages, schemas and rules kept as files or database tables."""

from pyspark.sql import functions as F

from sluicegate.operators.rules import RULE_COLUMNS
from sluicegate.operators.schemas import SCHEMA_COLUMNS

MESSAGE_COLUMNS = (
    "key binary, value binary, headers array<struct<key:string,value:binary>>, topic string, "
    "partition int, offset bigint, timestamp timestamp, timestampType int"
)


def from_topics(messages, topics):
    """Messages of the given source topics (a stored table's counterpart of ``subscribe``)."""
    return messages.where(F.col("topic").isin(list(topics)))


def message_stream(spark, path, **options):
    """Stored messages as a stream: new files under ``path`` are new messages."""
    return spark.readStream.schema(MESSAGE_COLUMNS).options(**options).parquet(path)


def schemas_from_files(spark, path, format="parquet"):
    return spark.read.schema(SCHEMA_COLUMNS).format(format).load(path)


def rules_from_files(spark, path, format="parquet"):
    return spark.read.schema(RULE_COLUMNS).format(format).load(path)


def jdbc_options(url, table, user="", password="", driver=""):
    given = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    return {k: v for k, v in given.items() if v}


def table_from_jdbc(spark, **connection):
    """A database table; filters on it are evaluated there."""
    return spark.read.format("jdbc").options(**jdbc_options(**connection)).load()


def rules_from_jdbc(spark, **connection):
    """A rules table ``ord, pattern, bucket`` in a database; the columns are read by name."""
    return table_from_jdbc(spark, **connection).selectExpr(
        "cast(ord as int) as ord",
        "cast(pattern as string) as pattern",
        "cast(bucket as string) as bucket",
    )
