"""The router as a job, set up by environment variables: ``python -m sluicegate.job``.

Without a rules table, a target table, a fallback folder, a time to wait for late schemas or a registry too
large to broadcast it is one plain streaming query.  With any of them each micro-batch is routed with
the rules and schemas of its moment, noted in a ledger beside the checkpoint for replays, and
written to every sink; with several sinks it is read and decoded once, into files that they share."""

import json
import os
from urllib.parse import quote
from urllib.request import urlopen

from pyspark.sql import SparkSession

from sluicegate.config import DEFAULT_RULES, RouterConfig
from sluicegate.operators.rules import Rules
from sluicegate.operators.schemas import SCHEMA_COLUMNS, Registry
from sluicegate.plans.route import route
from sluicegate.session import SETTINGS
from sluicegate.sources.kafka import read_stream
from sluicegate.sources.tables import rules_from_jdbc, schemas_from_files, table_from_jdbc
from sluicegate.streaming.ledger import Ledger
from sluicegate.streaming.metrics import BatchCounts, RoutingMetrics, observe_routing
from sluicegate.streaming.once import append_once
from sluicegate.streaming.run import route_batches
from sluicegate.streaming.sinks import (
    append_to_jdbc,
    append_to_kafka,
    matched_events,
    oversized,
    persisted,
    run_id,
    staged,
    to_kafka,
    write_staged,
    write_with_fallback,
)

VARIANTS = {"message": RouterConfig.per_message, "reader": RouterConfig.one_schema}


def settings(env):
    """The job's settings: a variant's defaults (``ROUTER_VARIANT``) and the environment."""
    variant = env.get("ROUTER_VARIANT", "")
    if variant and variant not in VARIANTS:
        raise ValueError(f"ROUTER_VARIANT must be one of {sorted(VARIANTS)}")
    return RouterConfig.from_env(VARIANTS.get(variant, RouterConfig)(), env)


def database(env, table):
    if not env.get("MSSQL_JDBC_URL"):
        raise ValueError(f"MSSQL_JDBC_URL is not set, but the table {table} is")
    return {
        "url": env["MSSQL_JDBC_URL"],
        "table": table,
        "user": env.get("MSSQL_USER", ""),
        "password": env.get("MSSQL_PASSWORD", ""),
        "driver": env.get("MSSQL_DRIVER", ""),
    }


def registered_schema(url, subject, open_url=urlopen):
    """The newest schema of a subject as a row of the schema table, asked of a registry.

    For the driver, once per start: messages are never looked up one by one."""
    path = f"{url.rstrip('/')}/subjects/{quote(subject, safe='')}/versions/latest"
    with open_url(path, timeout=10) as answer:
        found = json.loads(answer.read().decode("utf-8"))
    return subject, found.get("version"), found.get("id"), found["schema"]


def schemas_loader(spark, env, config, open_url=urlopen):
    """The schema table under ``SCHEMAS_PATH``; else, for a router with one reader schema that
    is not given, the newest one at ``REGISTRY_COMPAT_URL``; else an empty table: a job with a
    reader schema or a default schema can do without."""
    path, form = env.get("SCHEMAS_PATH"), env.get("SCHEMAS_FORMAT") or "parquet"
    if path:
        return lambda: schemas_from_files(spark, path, form)
    url = env.get("REGISTRY_COMPAT_URL")
    rows = []
    if url and config.schema_mode == "reader":
        if not (config.reader_schema.strip() or config.reader_schema_file.strip()):
            rows = [registered_schema(url, config.subject, open_url)]
    elif url and not config.default_schema.strip():
        raise ValueError("schemas per message come from SCHEMAS_PATH, not from REGISTRY_COMPAT_URL")
    return lambda: spark.createDataFrame(rows, SCHEMA_COLUMNS)


def rules_loader(spark, env):
    """Rules from the database table if one is named, else from JSON text."""
    if env.get("MSSQL_RULES_TABLE"):
        return lambda: rules_from_jdbc(spark, **database(env, env["MSSQL_RULES_TABLE"]))
    rules = Rules.of(env.get("ROUTING_RULES_JSON") or DEFAULT_RULES)
    return lambda: rules


def fallback_folder(env):
    """Folder for oversized messages: a bucket name means that bucket over s3a."""
    if env.get("MINIO_ENABLE") != "true":
        return ""
    bucket = env.get("MINIO_BUCKET", "")
    if not bucket:
        raise ValueError("MINIO_ENABLE is set, but MINIO_BUCKET is not")
    return bucket if "/" in bucket else f"s3a://{bucket}"


def object_store(env):
    """Hadoop settings of the object store that holds the fallback folder."""
    given = {
        "fs.s3a.endpoint": env.get("MINIO_ENDPOINT"),
        "fs.s3a.access.key": env.get("MINIO_ACCESS_KEY"),
        "fs.s3a.secret.key": env.get("MINIO_SECRET_KEY"),
    }
    if not fallback_folder(env) or not any(given.values()):
        return {}
    missing = [name for name, value in given.items() if not value]
    if missing:
        raise ValueError(f"the object store lacks {missing}")
    return given | {"fs.s3a.path.style.access": "true"}


def batch_writer(config, env, sink=append_to_kafka):
    """Writer of one routed micro-batch to the sinks the environment names.

    Rows of the target table carry source topic, partition and offset; a replayed batch adds only those
    that the table does not have yet."""
    target, fallback = env.get("MSSQL_TARGET_TABLE"), fallback_folder(env)
    base = config.checkpoint.rstrip("/")
    ledger = Ledger(f"{base}/ledger") if base else None

    def append(events, batch_id):
        connection = database(env, target)
        spark, run = events.sparkSession, run_id(events)
        begun = ledger is not None and ledger.begun(spark, run, batch_id, "target")
        append_once(
            events,
            lambda rows: append_to_jdbc(rows, **connection),
            lambda: table_from_jdbc(spark, **connection),
            begun,
        )

    def write_from_files(routed, batch_id):
        rows = staged(routed, f"{base}/staged", config if fallback else None)
        write_staged(rows, lambda r: sink(r, config), f"{fallback}/oversized", batch_id)
        if target:  # what reached its topic
            append(matched_events(rows.where("sink = 'valid'")), batch_id)

    def write_each(routed, batch_id):
        with persisted(routed, config.keep_batches):
            if fallback:
                folder = f"{fallback}/oversized"
                write_with_fallback(routed, config, lambda r: sink(r, config), folder, batch_id)
            else:
                sink(routed, config)
            if target:
                sent = routed.where(~oversized(config)) if fallback else routed
                append(matched_events(sent), batch_id)

    return write_from_files if base and (target or fallback) else write_each


def start(spark, env, messages=None):
    """Start the router on Kafka, or on another stream of messages; returns its query."""
    config = settings(env)
    if not config.checkpoint:
        raise ValueError("CHECKPOINT_LOCATION is not set")
    messages = read_stream(spark, config) if messages is None else messages
    load_schemas, load_rules = schemas_loader(spark, env, config), rules_loader(spark, env)
    for name, value in object_store(env).items():
        spark.sparkContext._jsc.hadoopConfiguration().set(name, value)
    counted = env.get("OTEL_ENABLE") == "true"
    tables = env.get("MSSQL_RULES_TABLE") or env.get("MSSQL_TARGET_TABLE")
    late = config.hold_seconds and config.schema_mode == "message"
    if tables or fallback_folder(env) or late or too_large(load_schemas, config):
        counts = None
        if counted:  # topics of the rules at the start; others count in the total
            counts = BatchCounts(spark, topics_of(load_rules(), config), config.error_style)
        write = batch_writer(config, env)
        return route_batches(
            messages, load_schemas, load_rules, config, write, config.checkpoint,
            hold=config.hold_seconds, counts=counts,
        )
    rules = Rules.of(load_rules())
    routed = route(messages, load_schemas(), rules, config)
    if counted:
        topics = topics_of(rules, config)
        routed = observe_routing(routed, topics, config.error_style)
        spark.streams.addListener(RoutingMetrics(spark, topics))
    return to_kafka(routed, config)


def topics_of(rules, config):
    return [f"{config.topic_prefix}_{b}" for b in Rules.of(rules).buckets] + [config.errors_topic]


def too_large(load_schemas, config):
    """Whether the registry cannot be broadcast as a whole.  A plain stream would then join it to all
    messages; a micro-batch knows its ids and broadcasts the schemas in use."""
    if config.schema_mode == "reader":
        return False
    limits = config.max_broadcast_bytes, config.max_broadcast_schemas, config.max_copied_bytes
    return Registry.load(load_schemas(), *limits).texts is None


def main():
    builder = SparkSession.builder.appName("message-router")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    start(spark, os.environ).awaitTermination()


if __name__ == "__main__":
    main()
