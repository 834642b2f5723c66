"""One query per operator.  Every query reads the whole ``events`` table as messages.

Results have primitive columns only: bytes as hex, a header as two strings."""

import json

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sluicegate.config import RouterConfig
from sluicegate.functions.wire import wire_info
from sluicegate.operators.classify import rejected_messages, valid_messages
from sluicegate.operators.decode import as_record, decode, decode_with, record_fields
from sluicegate.operators.rules import Rules
from sluicegate.operators.schemas import (
    Registry,
    attach_schema,
    latest_schema,
    resolve_schema,
)
from sluicegate.operators.summary import (
    branch_counts,
    routing_summary,
)
from sluicegate.operators.wire import split_wire
from sluicegate.plans import fixtures as fx
from sluicegate.plans.route import route
from sluicegate.session import work_dir
from sluicegate.sources.archive import from_offsets, from_timestamps, offset_gaps
from sluicegate.sources.tables import (
    from_topics,
    message_stream,
    rules_from_files,
    schemas_from_files,
)
from sluicegate.streaming.ledger import Ledger
from sluicegate.streaming.metrics import BatchCounts, RoutingMetrics, observe_routing
from sluicegate.streaming.once import append_once
from sluicegate.streaming.run import route_batches
from sluicegate.streaming.sinks import (
    matched_events,
    run_id,
    staged,
    to_batches,
    to_files,
    write_batch,
    write_sinks,
    write_staged,
)

CONFIG = RouterConfig(default_schema=fx.SCHEMA_7, input_topics=("raw-a", "raw-b"))


def event_id():
    return F.col("offset").alias("event_id")


UNANCHORED = tuple((p.removeprefix("^"), b) for p, b in fx.RULES)
WITHOUT_CATCH_ALL = fx.RULES[:2]
BLANK_RULES = ((r"^$", "blank"), (r".*", "rest"))
SWAPPED = tuple((p, {"ru": "ua", "ua": "ru"}.get(b, b)) for p, b in fx.RULES)
SMALL_REQUEST = 180  # bytes; splits the fixture's messages into fitting and oversized


def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def messages(spark, sf_dir):
    return fx.raw_messages(events(spark, sf_dir))


def event_stream(spark, sf_dir):
    """The events table as a stream, turned into messages on the way.

    The path is a glob because a file stream takes a plain path for a folder, while the
    table may be one file."""
    schema = events(spark, sf_dir).schema
    source = spark.readStream.schema(schema)
    return fx.raw_messages(source.parquet(f"{sf_dir}/events.parque[t]"))


def routed(spark, sf_dir, rules=fx.RULES, config=CONFIG):
    return route(messages(spark, sf_dir), fx.schemas_table(spark), rules, config)


def buckets(spark, sf_dir, rules=fx.RULES, **settings):
    config = RouterConfig(default_schema=fx.SCHEMA_7, **settings)
    return routed(spark, sf_dir, rules, config).select(event_id(), "bucket")


def decoded(spark, sf_dir, fields, schemas=None, default=fx.SCHEMA_7, error="error"):
    """Messages decoded per schema id; ``error`` covers the wire and the decode."""
    registry = Registry.load(schemas or fx.schemas_table(spark))
    rows = decode(split_wire(messages(spark, sf_dir)), fields, registry, default)
    return rows.select(
        event_id(), *fields, F.coalesce("wire_error", "decode_error").alias(error)
    )


# -- wire -----------------------------------------------------------------------------


def wire_split(policy):
    def query(spark, sf_dir):
        rows = messages(spark, sf_dir).select(event_id(), wire_info("value", policy).alias("wire"))
        return rows.select(
            "event_id",
            "wire.schema_id",
            F.hex("wire.payload").alias("payload_hex"),
            "wire.wire_error",
        )

    return query


# -- schemas --------------------------------------------------------------------------


def event_registry(spark, sf_dir):
    """A registry that grows with the events: each event registers a schema version for
    the subject of its type."""
    field = F.concat(F.lit('{"name":"f'), F.col("user_id").cast("string"), F.lit('","type":"long"}'))
    return events(spark, sf_dir).select(
        F.concat("event_type", F.lit("-value")).alias("subject"),
        F.col("event_id").alias("version"),
        (F.col("event_id") + 1000).alias("schema_id"),
        F.concat(F.lit('{"type":"record","name":"E","fields":['), field, F.lit("]}")).alias(
            "schema_json"
        ),
    )


def q_schema_latest(spark, sf_dir):
    return latest_schema(event_registry(spark, sf_dir))


def q_schema_attach(spark, sf_dir):
    registry = Registry.load(fx.schemas_table(spark))
    rows = attach_schema(split_wire(messages(spark, sf_dir)), registry)
    return rows.select(event_id(), "schema_id", "known")


def schema_file(spark, text):
    """A schema stored as a file in the shared folder."""
    path = work_dir(spark, "schema")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def with_reader_schema(spark, sf_dir, config):
    """All messages decoded with the reader schema the settings resolve to."""
    source, schema = resolve_schema(spark, fx.schemas_table(spark), config)
    split = split_wire(messages(spark, sf_dir), "lenient")
    rows = decode_with(split, {"phone": "phone"}, schema)
    return rows.select(
        F.lit(source).alias("source"),
        event_id(),
        "phone",
        F.coalesce("wire_error", "decode_error").alias("error"),
    )


def q_schema_file(spark, sf_dir):
    path = schema_file(spark, fx.SCHEMA_7)
    return with_reader_schema(spark, sf_dir, RouterConfig(reader_schema_file=path))


def q_schema_precedence(spark, sf_dir):
    """Inline beats file beats registry; the registry's newest schema differs from both."""
    path = schema_file(spark, fx.SCHEMA_7)
    inline = with_reader_schema(
        spark, sf_dir, RouterConfig(reader_schema=fx.SCHEMA_8, reader_schema_file=path)
    )
    file = with_reader_schema(spark, sf_dir, RouterConfig(reader_schema_file=path))
    registry = with_reader_schema(spark, sf_dir, RouterConfig(subject=fx.SUBJECT))
    return inline.unionAll(file).unionAll(registry)


# -- decode ---------------------------------------------------------------------------


def q_decode_phone(spark, sf_dir):
    return decoded(spark, sf_dir, {"phone": "phone"}, error="decode_error")


def q_decode_default(spark, sf_dir):
    return decoded(spark, sf_dir, {"phone": "phone"})


def q_no_default_schema(spark, sf_dir):
    return decoded(spark, sf_dir, {"phone": "phone"}, default="")


def q_decode_single_schema(spark, sf_dir):
    rows = decode_with(split_wire(messages(spark, sf_dir)), {"phone": "phone"}, fx.SCHEMA_7)
    return rows.select(
        event_id(), "phone", F.coalesce("wire_error", "decode_error").alias("decode_error")
    )


def q_decode_full(spark, sf_dir):
    """The whole record as one struct, here flattened again."""
    fields, registry = record_fields(fx.SCHEMA_7), Registry.load(fx.schemas_table(spark))
    rows = decode(split_wire(messages(spark, sf_dir)), fields, registry, fx.SCHEMA_7)
    return rows.select(event_id(), as_record(fields).alias("record")).select("event_id", "record.*")


def enveloped(text):
    """The schema as the only field of another record: the same bytes, one level deeper."""
    return json.dumps(
        {
            "type": "record",
            "name": "Envelope",
            "fields": [{"name": "event", "type": json.loads(text)}],
        }
    )


def q_decode_nested(spark, sf_dir):
    wrap = F.when(F.col("schema_id") == 7, enveloped(fx.SCHEMA_7)).otherwise(enveloped(fx.SCHEMA_8))
    schemas = fx.schemas_table(spark).withColumn("schema_json", wrap)
    rows = decoded(spark, sf_dir, {"phone": "event.phone"}, schemas, enveloped(fx.SCHEMA_7))
    return rows.select("event_id", "phone")


def q_decode_missing_field(spark, sf_dir):
    return buckets(spark, sf_dir, route_field="msisdn")


def q_decode_types(spark, sf_dir):
    """One record with every kind of Avro type, whole and by path."""
    typed = fx.typed_messages(events(spark, sf_dir))
    fields = record_fields(fx.TYPED_SCHEMA) | {
        "attr_k": ("attrs.k", "bigint"),
        "inner_name": "inner.name",
        "either_text": "either",
    }
    rows = decode(split_wire(typed), fields, Registry.load(fx.typed_schemas(spark)))
    return rows.select(
        event_id(),
        "user",
        "flag",
        F.expr("cast(ratio as double)").alias("ratio"),
        F.expr("cast(amount * 100 as bigint)").alias("amount_cents"),
        F.expr("unix_micros(ts)").alias("ts_micros"),
        F.expr("unix_date(day)").alias("day_number"),
        F.array_join("tags", ",").alias("tags"),
        F.expr("aggregate(numbers, 0L, (a, x) -> a + x)").alias("numbers_sum"),
        F.size("attrs").alias("attrs_size"),
        "attr_k",
        "inner_name",
        "colour",
        F.hex("mark").alias("mark_hex"),
        F.hex("blob").alias("blob_hex"),
        "either_text",
        F.col("either.member0").alias("either_string"),
        F.col("either.member1").alias("either_boolean"),
        "decode_error",
    )


def q_decode_large_registry(spark, sf_dir):
    """A registry with an entry per event besides one schema per user: too large to broadcast
    as a whole, here by its bytes, but not the schemas in use."""
    base = events(spark, sf_dir)
    unused = event_registry(spark, sf_dir).withColumn("schema_id", -1 - F.col("schema_id"))
    used = fx.user_schemas(base)
    [size] = used.agg(F.sum(F.octet_length("schema_json")).alias("bytes")).collect()
    registry = Registry.load(used.unionByName(unused), max_bytes=size.bytes or 0)
    rows = decode(split_wire(fx.user_messages(base)), {"phone": "phone"}, registry)
    return rows.select(event_id(), "schema_id", "phone", "decode_error")


def q_decode_joined_registry(spark, sf_dir):
    """One schema per user, also those in use treated as too large: joined to the messages."""
    base = events(spark, sf_dir)
    registry = Registry.load(fx.user_schemas(base), max_schemas=0)
    rows = decode(split_wire(fx.user_messages(base)), {"phone": "phone"}, registry)
    return rows.select(event_id(), "schema_id", "phone", "decode_error")


# -- rules ----------------------------------------------------------------------------


def q_route_first(spark, sf_dir):
    """The rules as a JSON object, in the order of its keys."""
    return buckets(spark, sf_dir, rules=json.dumps(dict(fx.RULES)))


def q_route_last(spark, sf_dir):
    return buckets(spark, sf_dir, match="last")


def q_route_search(spark, sf_dir):
    return buckets(spark, sf_dir, rules=UNANCHORED)


def q_route_anchored(spark, sf_dir):
    return buckets(spark, sf_dir, rules=UNANCHORED, anchored=True)


def q_route_null(spark, sf_dir):
    return buckets(spark, sf_dir, rules=BLANK_RULES)


def q_route_null_default(spark, sf_dir):
    return buckets(spark, sf_dir, rules=BLANK_RULES, null_field="default")


def q_route_many_rules(spark, sf_dir):
    """A rule per last two digits ahead of the usual ones: too many for one expression."""
    exact = [(rf"^\+7\d{{8}}{n:02d}$", f"ru{n:02d}") for n in range(100)]
    exact += [(rf"^\+380\d{{7}}{n:02d}$", f"ua{n:02d}") for n in range(100)]
    return buckets(spark, sf_dir, rules=[*exact, *fx.RULES])


def q_route_1000_rules(spark, sf_dir):
    """A thousand rules by the last three digits ahead of the usual ones."""
    exact = [(rf"^\+7\d{{7}}{n:03d}$", f"ru{n:03d}") for n in range(500)]
    exact += [(rf"^\+380\d{{6}}{n:03d}$", f"ua{n:03d}") for n in range(500)]
    return buckets(spark, sf_dir, rules=[*exact, *fx.RULES])


def q_no_route(spark, sf_dir):
    return routed(spark, sf_dir, WITHOUT_CATCH_ALL).select(event_id(), "error")


def stored_rules(spark, path, rules):
    fx.rules_table(spark, rules).write.mode("overwrite").parquet(path)


def q_rules_table(spark, sf_dir):
    path = work_dir(spark, "rules")
    stored_rules(spark, path, fx.RULES)
    return routed(spark, sf_dir, rules_from_files(spark, path)).select(event_id(), "bucket")


# -- output ---------------------------------------------------------------------------


def errors(style):
    def query(spark, sf_dir):
        config = RouterConfig(default_schema=fx.SCHEMA_7, error_style=style)
        return routed(spark, sf_dir, config=config).select(event_id(), "error")

    return query


def branch(rows):
    return rows.select(
        event_id(),
        F.hex("key").alias("key_hex"),
        F.hex("value").alias("value_hex"),
        F.col("headers")[0]["key"].alias("header_key"),
        F.col("headers")[0]["value"].cast("string").alias("header_value"),
        "topic",
    )


def q_errors_out(spark, sf_dir):
    return branch(rejected_messages(routed(spark, sf_dir)))


def q_valid_out(spark, sf_dir):
    return branch(valid_messages(routed(spark, sf_dir)))


def q_routed_all(spark, sf_dir):
    return routed(spark, sf_dir).select(
        event_id(),
        F.hex("key").alias("key_hex"),
        F.hex("value").alias("value_hex"),
        "topic",
        "error",
    )


def q_value_unchanged(spark, sf_dir):
    return routed(spark, sf_dir).select(event_id(), F.hex("value").alias("value_hex"))


def q_split_counts(spark, sf_dir):
    return branch_counts(routed(spark, sf_dir))


def q_routing_summary(spark, sf_dir):
    return routing_summary(routed(spark, sf_dir))


def q_multi_topic(spark, sf_dir):
    there = messages(spark, sf_dir)
    other = there.withColumn("topic", F.lit("raw-c"))  # a topic that nobody subscribed to
    chosen = from_topics(there.unionByName(other), CONFIG.input_topics)
    rows = route(chosen, fx.schemas_table(spark), fx.RULES, CONFIG)
    return rows.select(event_id(), "source_topic", "topic")


def q_from_offsets(spark, sf_dir):
    """Archived messages from a start position per topic partition."""
    start = json.dumps({"raw-a": {"0": 400}, "raw-b": {"0": -2, "1": 7}})
    rows = from_offsets(messages(spark, sf_dir), start)
    return rows.select(event_id(), F.col("topic").alias("source_topic"))


def q_from_timestamps(spark, sf_dir):
    """The same by time: each topic from its first message at or after a moment, here the middle."""
    there = messages(spark, sf_dir)
    [span] = there.agg(F.min(F.unix_millis("timestamp")).alias("a"), F.max(F.unix_millis("timestamp")).alias("b")).collect()
    start = json.dumps({"raw-a": {"0": (span.a + span.b) // 2}})
    rows = from_timestamps(there, start)
    return rows.select(event_id(), F.col("topic").alias("source_topic"))


def q_offset_gaps(spark, sf_dir):
    """Lost offsets of an archive, in blocks smaller than some of the gaps."""
    kept = messages(spark, sf_dir).where("(offset div 50) % 7 <> 3 and offset % 97 <> 5")
    return offset_gaps(kept, block=30).withColumnRenamed("topic", "source_topic")


def q_per_message_router(spark, sf_dir):
    """The per-message variant's settings together."""
    config = RouterConfig.per_message(default_schema=fx.SCHEMA_7)
    return routed(spark, sf_dir, config=config).select(event_id(), "topic", "error")


def q_one_schema_router(spark, sf_dir):
    """The reader-schema variant's settings together."""
    config = RouterConfig.one_schema(reader_schema=fx.SCHEMA_7)
    return routed(spark, sf_dir, config=config).select(event_id(), "topic", "error")


# -- streams --------------------------------------------------------------------------


def finish(query):
    """Wait for a bounded stream; a failure in it is raised here."""
    query.awaitTermination()
    return query


def q_stream_route(spark, sf_dir):
    base = work_dir(spark, "stream-route")
    rows = route(event_stream(spark, sf_dir), fx.schemas_table(spark), fx.RULES, CONFIG)
    finish(to_files(rows, f"{base}/out", f"{base}/checkpoint", once=True))
    return spark.read.parquet(f"{base}/out").select(event_id(), "topic")


def q_stream_resume(spark, sf_dir):
    """Two runs on one checkpoint; the second sees only what was added after the first."""
    base = work_dir(spark, "stream-resume")
    for topic in CONFIG.input_topics:
        added = from_topics(messages(spark, sf_dir), [topic])
        added.write.mode("append").parquet(f"{base}/in")
        stream = message_stream(spark, f"{base}/in")
        rows = route(stream, fx.schemas_table(spark), fx.RULES, CONFIG)
        finish(to_files(rows, f"{base}/out", f"{base}/checkpoint", once=True))
    return spark.read.parquet(f"{base}/out").select(event_id(), "topic")


def q_foreachbatch(spark, sf_dir):
    """Valid and rejected messages to two sinks from one stream, in one write per batch."""
    base = work_dir(spark, "foreachbatch")
    rows = route(event_stream(spark, sf_dir), fx.schemas_table(spark), fx.RULES, CONFIG)

    def step(batch, batch_id):
        write_sinks(batch, f"{base}/out", batch_id)

    finish(to_batches(rows, step, f"{base}/checkpoint", once=True))
    out = spark.read.parquet(f"{base}/out")
    valid, rejected = (out.where(F.col("sink") == sink) for sink in ("valid", "errors"))
    return valid.select(event_id(), "topic").unionAll(rejected.select(event_id(), "topic"))


def q_rules_refresh(spark, sf_dir):
    """Rules and schemas are read anew for each micro-batch, here with a change between."""
    base = work_dir(spark, "rules-refresh")
    fx.schemas_table(spark).write.parquet(f"{base}/schemas")
    for topic, rules in zip(CONFIG.input_topics, (fx.RULES, SWAPPED)):
        stored_rules(spark, f"{base}/rules", rules)
        added = from_topics(messages(spark, sf_dir), [topic])
        added.write.mode("append").parquet(f"{base}/in")
        finish(
            route_batches(
                message_stream(spark, f"{base}/in"),
                lambda: schemas_from_files(spark, f"{base}/schemas"),
                lambda: rules_from_files(spark, f"{base}/rules"),
                CONFIG,
                lambda rows, batch_id: write_batch(rows, f"{base}/out", batch_id),
                f"{base}/checkpoint",
                once=True,
            )
        )
    return spark.read.parquet(f"{base}/out").select(event_id(), "bucket")


class SinkDown(Exception):
    """A stand-in sink that fails after it has written."""


def until_done(start):
    """Run a bounded stream again after each failure of its stand-in sink, as a restarted job would."""
    while True:
        try:
            return finish(start())
        except StreamingQueryException as e:
            if SinkDown.__name__ not in str(e):
                raise


def q_rules_replay(spark, sf_dir):
    """A batch that fails after its write and is replayed after a change of rules goes where it went."""
    base, attempts = work_dir(spark, "rules-replay"), []
    fx.schemas_table(spark).write.parquet(f"{base}/schemas")

    def write(rows, batch_id):
        attempts.append(batch_id)
        write_batch(rows, f"{base}/out/attempt={len(attempts)}", batch_id)
        if len(attempts) == 1:
            stored_rules(spark, f"{base}/rules", SWAPPED)
            raise SinkDown

    def start():
        return route_batches(
            message_stream(spark, f"{base}/in"),
            lambda: schemas_from_files(spark, f"{base}/schemas"),
            lambda: rules_from_files(spark, f"{base}/rules"),
            CONFIG,
            write,
            f"{base}/checkpoint",
            once=True,
        )

    stored_rules(spark, f"{base}/rules", fx.RULES)
    for topic in CONFIG.input_topics:
        from_topics(messages(spark, sf_dir), [topic]).write.mode("append").parquet(f"{base}/in")
        until_done(start)
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy(event_id(), "bucket").agg(F.count("*").alias("attempts"))


def q_late_schema(spark, sf_dir):
    """Messages wait for their schema: one is registered before the second batch, one never."""
    base, times = work_dir(spark, "late-schema"), [0, 10, 1000, 5000]
    for turn, now in enumerate(times):
        fx.schemas_table(spark).where("schema_id = 7" if turn == 0 else "true").write.mode(
            "overwrite"
        ).parquet(f"{base}/schemas")
        some = messages(spark, sf_dir).where(F.col("offset") % len(times) == turn)
        some.write.mode("append").parquet(f"{base}/in")
        query = finish(
            route_batches(
                message_stream(spark, f"{base}/in"),
                lambda: schemas_from_files(spark, f"{base}/schemas"),
                lambda: fx.RULES,
                CONFIG,
                lambda rows, batch_id: write_batch(rows, f"{base}/out", batch_id),
                f"{base}/checkpoint",
                ledger=Ledger(f"{base}/checkpoint/ledger", clock=lambda: now),
                hold=100,
                once=True,
            )
        )
    left = spark.read.parquet(f"{base}/out").select(event_id(), "topic", "error", "batch_id")
    last = len(times) - 1
    waits = spark.read.parquet(f"{base}/checkpoint/waiting/run={query.id}/turn={last % 2}")
    none = F.lit(None)
    return left.unionAll(
        waits.select(event_id(), none.alias("topic"), none.alias("error"), none.alias("batch_id"))
    )


def q_matched_table(spark, sf_dir):
    base = work_dir(spark, "matched")
    rows = route(event_stream(spark, sf_dir), fx.schemas_table(spark), fx.RULES, CONFIG)

    def step(batch, batch_id):
        write_batch(matched_events(batch), f"{base}/matched", batch_id)

    finish(to_batches(rows, step, f"{base}/checkpoint", once=True))
    matched = spark.read.parquet(f"{base}/matched")
    return matched.select(
        event_id(), "source_topic", "key_hex", "schema_id", "route_value", "bucket", "topic"
    )


def q_matched_replay(spark, sf_dir):
    """A table that can only be appended to: the first attempt fails half way, the second adds the rest."""
    base = work_dir(spark, "matched-replay")
    rows = route(event_stream(spark, sf_dir), fx.schemas_table(spark), fx.RULES, CONFIG)
    ledger = Ledger(f"{base}/ledger")

    def step(batch, batch_id):
        begun = ledger.begun(spark, run_id(batch), batch_id, "matched")
        events_ = matched_events(batch)

        def append(new):
            new = new if begun else new.where(F.col("offset") % 3 > 0)
            new.write.mode("append").parquet(f"{base}/matched")

        def existing():
            return spark.read.schema(events_.schema).parquet(f"{base}/matched")

        append_once(events_, append, existing, begun)
        if not begun:
            raise SinkDown

    until_done(lambda: to_batches(rows, step, f"{base}/checkpoint", once=True))
    matched = spark.read.parquet(f"{base}/matched")
    names = ["source_topic", "key_hex", "schema_id", "route_value", "bucket", "topic"]
    return matched.groupBy(event_id(), *names).agg(F.count("*").alias("n"))


def q_fallback_files(spark, sf_dir):
    """Messages above the producer's size limit go to files, the others to the sink."""
    base = work_dir(spark, "fallback")
    config = RouterConfig(default_schema=fx.SCHEMA_7, max_request_size=SMALL_REQUEST)
    rows = route(event_stream(spark, sf_dir), fx.schemas_table(spark), fx.RULES, config)

    def step(batch, batch_id):
        def write(fitting):
            write_batch(fitting, f"{base}/out", batch_id, by=["topic"])

        write_staged(staged(batch, f"{base}/staged", config), write, f"{base}/fallback", batch_id)

    finish(to_batches(rows, step, f"{base}/checkpoint", once=True))
    parts = [
        spark.read.parquet(f"{base}/{sink}").select(event_id(), "topic", F.lit(sink).alias("sink"))
        for sink in ("out", "fallback")
    ]
    return parts[0].unionAll(parts[1])


def q_stream_counts(spark, sf_dir):
    """Counts observed by a running stream, from its progress reports."""
    base = work_dir(spark, "stream-counts")
    topics = [f"{CONFIG.topic_prefix}_{b}" for b in Rules.of(fx.RULES).buckets]
    topics.append(CONFIG.errors_topic)
    rows = route(event_stream(spark, sf_dir), fx.schemas_table(spark), fx.RULES, CONFIG)
    with RoutingMetrics(spark, topics) as metrics:
        observed = observe_routing(rows, topics)
        query = finish(to_files(observed, f"{base}/out", f"{base}/checkpoint", once=True))
        counts = metrics.totals(query)
    return spark.createDataFrame(list(counts.items()), "name string, n bigint")


def q_batch_counts(spark, sf_dir):
    """The same counts of a job that writes batches, added up over several of them."""
    base = work_dir(spark, "batch-counts")
    topics = [f"{CONFIG.topic_prefix}_{b}" for b in Rules.of(fx.RULES).buckets]
    topics.append(CONFIG.errors_topic)
    counts = BatchCounts(spark, topics)
    for topic in CONFIG.input_topics:
        from_topics(messages(spark, sf_dir), [topic]).write.mode("append").parquet(f"{base}/in")
        query = finish(
            route_batches(
                message_stream(spark, f"{base}/in"),
                lambda: fx.schemas_table(spark),
                lambda: fx.RULES,
                CONFIG,
                lambda rows, batch_id: write_sinks(rows, f"{base}/out", batch_id),
                f"{base}/checkpoint",
                counts=counts,
                once=True,
            )
        )
    found = counts.totals(query.id)
    return spark.createDataFrame(list(found.items()), "name string, n bigint")


QUERIES = {
    "q_wire_split": wire_split("strict"),
    "q_wire_split_lenient": wire_split("lenient"),
    "q_schema_latest": q_schema_latest,
    "q_schema_attach": q_schema_attach,
    "q_schema_file": q_schema_file,
    "q_schema_precedence": q_schema_precedence,
    "q_decode_phone": q_decode_phone,
    "q_decode_default": q_decode_default,
    "q_no_default_schema": q_no_default_schema,
    "q_decode_single_schema": q_decode_single_schema,
    "q_decode_full": q_decode_full,
    "q_decode_nested": q_decode_nested,
    "q_decode_missing_field": q_decode_missing_field,
    "q_decode_types": q_decode_types,
    "q_decode_large_registry": q_decode_large_registry,
    "q_decode_joined_registry": q_decode_joined_registry,
    "q_route_first": q_route_first,
    "q_route_last": q_route_last,
    "q_route_search": q_route_search,
    "q_route_anchored": q_route_anchored,
    "q_route_null": q_route_null,
    "q_route_null_default": q_route_null_default,
    "q_route_many_rules": q_route_many_rules,
    "q_route_1000_rules": q_route_1000_rules,
    "q_no_route": q_no_route,
    "q_rules_table": q_rules_table,
    "q_rules_refresh": q_rules_refresh,
    "q_error_reason": errors("code"),
    "q_error_reason_message": errors("message"),
    "q_error_reason_reader": errors("reader"),
    "q_errors_out": q_errors_out,
    "q_valid_out": q_valid_out,
    "q_routed_all": q_routed_all,
    "q_value_unchanged": q_value_unchanged,
    "q_split_counts": q_split_counts,
    "q_multi_topic": q_multi_topic,
    "q_from_offsets": q_from_offsets,
    "q_from_timestamps": q_from_timestamps,
    "q_offset_gaps": q_offset_gaps,
    "q_per_message_router": q_per_message_router,
    "q_one_schema_router": q_one_schema_router,
    "q_stream_route": q_stream_route,
    "q_stream_resume": q_stream_resume,
    "q_foreachbatch": q_foreachbatch,
    "q_rules_replay": q_rules_replay,
    "q_late_schema": q_late_schema,
    "q_matched_table": q_matched_table,
    "q_matched_replay": q_matched_replay,
    "q_fallback_files": q_fallback_files,
    "q_stream_counts": q_stream_counts,
    "q_batch_counts": q_batch_counts,
    "q_routing_summary": q_routing_summary,
}
