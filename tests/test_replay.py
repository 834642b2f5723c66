"""Replays, late schemas, appends that must not repeat, and sinks that share one read."""

import json

import pytest
from helpers import framed_text as framed
from helpers import messages, plan, record, schemas, texts
from pyspark.sql import functions as F

from sluicegate import Registry, RouterConfig, Rules, job, route
from sluicegate.plans import fixtures as fx
from sluicegate.sources.tables import message_stream
from sluicegate.streaming import once, sinks
from sluicegate.streaming.late import hold_unknown
from sluicegate.streaming.ledger import Ledger, table_digest
from sluicegate.streaming.metrics import BatchCounts, observed_batch
from sluicegate.streaming.run import route_batches
from sluicegate.streaming.together import run_together

CONFIG = RouterConfig(default_schema=fx.SCHEMA_7)


# Ledger ----------------------------------------------------------------------------------------


def test_a_replay_gets_what_the_first_attempt_had(spark, tmp_path):
    ledger = Ledger(str(tmp_path), clock=lambda: 5.0)
    first = ledger.settle(spark, "q", 0, lambda: fx.schemas_table(spark), lambda: fx.RULES, CONFIG)
    assert (first.replayed, first.started, first.rules.pairs) == (False, 5.0, fx.RULES)

    def never():
        raise AssertionError("a replay must not look at the present")

    for other in (ledger, Ledger(str(tmp_path), clock=never)):  # the same process, and a new one
        again = other.settle(spark, "q", 0, never, never, CONFIG)
        assert (again.replayed, again.started, again.rules) == (True, 5.0, first.rules)
        assert again.schemas.texts == first.schemas.texts
    later = ledger.settle(
        spark, "q", 1, lambda: fx.schemas_table(spark).limit(1), lambda: [(".*", "x")], CONFIG
    )
    assert later.rules.buckets == ("x",) and len(later.schemas.texts) == 1
    assert ledger.settle(spark, "q", 0, never, never, CONFIG).schemas.texts == first.schemas.texts
    assert ledger.settle(spark, "other", 0, lambda: fx.schemas_table(spark), lambda: fx.RULES, CONFIG).replayed is False


def test_versions_are_stored_and_loaded_once(spark, tmp_path, monkeypatch):
    loads, load = [], Registry.load.__func__
    monkeypatch.setattr(Registry, "load", classmethod(lambda cls, *a, **k: loads.append(1) or load(cls, *a, **k)))
    ledger = Ledger(str(tmp_path))
    for batch in range(3):
        found = ledger.settle(spark, "q", batch, lambda: fx.schemas_table(spark), lambda: fx.RULES, CONFIG)
    assert len(loads) == 1 and len(list((tmp_path / "schemas").iterdir())) == 1
    assert len(list((tmp_path / "rules").iterdir())) == 1 and set(found.schemas.texts) == {7, 8}


def test_reader_schema_of_a_batch_stays(spark, tmp_path):
    config = RouterConfig(schema_mode="reader", subject=fx.SUBJECT)
    ledger = Ledger(str(tmp_path))
    first = ledger.settle(spark, "q", 0, lambda: fx.schemas_table(spark), lambda: fx.RULES, config)
    assert first.config.reader_schema == fx.SCHEMA_8 and first.schemas is None
    again = ledger.settle(spark, "q", 0, None, None, config)
    assert again.config.reader_schema == fx.SCHEMA_8


def test_tables_have_different_digests(spark):
    frame = lambda *r: spark.createDataFrame(list(r), "a string, b bigint")
    rows = [("x", 1), ("y", 2), (None, 3), ("x", 1)]
    assert table_digest(frame(*rows)) == table_digest(frame(*rows[::-1]).repartition(3))
    others = [rows[:3], [*rows, rows[0]], [("y", 1), ("x", 2), *rows[2:]], [("x", 1), ("y", 2), ("", 3), ("x", 1)], []]
    digests = [table_digest(frame(*r)) for r in [rows, *others]]
    assert len(set(digests)) == len(digests)


def test_a_sink_is_begun_once(spark, tmp_path):
    ledger = Ledger(str(tmp_path))
    assert [ledger.begun(spark, "q", 0, "t"), ledger.begun(spark, "q", 0, "t")] == [False, True]
    assert not ledger.begun(spark, "q", 1, "t") and not ledger.begun(spark, "q", 0, "u")


# Late schemas ----------------------------------------------------------------------------------


def late(spark, tmp_path, ids, batch_id, started, values, hold=100):
    table = schemas(spark, *[(i, record(phone="string")) for i in ids])
    ready = hold_unknown(
        messages(spark, values), Registry.load(table), CONFIG, str(tmp_path / "waits"), batch_id, started, hold
    )
    return ready


@pytest.mark.parametrize("large", [False, True])
def test_messages_wait_for_their_schema(spark, tmp_path, large, monkeypatch):
    if large:
        load = Registry.load.__func__
        monkeypatch.setattr(Registry, "load", classmethod(lambda cls, t: load(cls, t, max_schemas=0)))
    known, unknown, bare = framed(1, "0261"), framed(2, "0262"), "0261"
    first = late(spark, tmp_path, [1], 0, 0.0, [known, unknown, None, bare, "0000"])
    assert sorted(texts(first, "offset")) == [0, 2, 3, 4]
    assert first.columns == messages(spark, []).columns
    # a replay after a failure decides the same
    assert sorted(texts(late(spark, tmp_path, [1], 0, 0.0, [known, unknown, None, bare, "0000"]), "offset")) == [0, 2, 3, 4]
    second = late(spark, tmp_path, [1, 2], 1, 50.0, [unknown])
    assert texts(second, "value") == [bytearray.fromhex(unknown)] * 2
    third = late(spark, tmp_path, [1, 2], 2, 60.0, [])
    assert third.count() == 0


def test_messages_do_not_wait_for_ever(spark, tmp_path):
    unknown = framed(2, "0262")
    assert late(spark, tmp_path, [1], 0, 0.0, [unknown]).count() == 0
    assert late(spark, tmp_path, [1], 1, 99.0, [unknown]).count() == 0
    assert late(spark, tmp_path, [1], 2, 100.0, []).count() == 1
    assert late(spark, tmp_path, [1], 3, 199.0, []).count() == 1
    assert late(spark, tmp_path, [1], 4, 500.0, []).count() == 0


# Append once -----------------------------------------------------------------------------------

ROWS = "source_topic string, partition int, offset bigint, text string"


def test_only_missing_rows_are_appended(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", p, o, f"{p}-{o}") for p in range(3) for o in range(20)] + [(None, 0, 5, "n")], ROWS)
    other = spark.createDataFrame([("a", 9, 3, "x"), ("b", 0, 3, "x"), (None, 1, 5, "x")], ROWS)
    other.unionByName(rows.where("offset % 2 = 0 or source_topic is null")).write.parquet(table)

    def append(new):
        new.write.mode("append").parquet(table)

    once.append_once(rows, append, lambda: spark.read.schema(ROWS).parquet(table), begun=True)
    found = spark.read.schema(ROWS).parquet(table)
    assert found.count() == 61 + 3 and found.distinct().count() == 64
    once.append_once(rows.limit(0), append, lambda: spark.read.schema(ROWS).parquet(table), begun=True)
    assert spark.read.schema(ROWS).parquet(table).count() == 64


def test_a_replay_reads_only_its_part_of_the_table(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", 0, 5, "x"), ("b", 1, 9, "x")], ROWS)
    rows.write.parquet(table)
    stored = spark.read.schema(ROWS).parquet(table)
    assert "GreaterThanOrEqual(offset" in plan(once.missing(rows, stored))
    monkeypatch.setattr(once, "MOST_SPANS", 1)
    found = plan(once.missing(rows, stored))
    assert "GreaterThanOrEqual(offset,5)" in found and "LessThanOrEqual(offset,9)" in found
    assert once.missing(rows, stored).count() == 0


# One read for all sinks ------------------------------------------------------------------------


def test_sinks_share_one_write(spark, events, tmp_path, monkeypatch):
    rows = route(fx.raw_messages(events), fx.schemas_table(spark), fx.RULES, CONFIG)
    config = RouterConfig(max_request_size=180)
    writes, write = [], sinks.write_batch
    monkeypatch.setattr(sinks, "write_batch", lambda r, *a, **k: writes.append(plan(r)) or write(r, *a, **k))
    sinks.write_sinks(rows, str(tmp_path / "out"), 0, config)
    assert len(writes) == 1 and writes[0].count("ArrowEvalPython") == 1 and writes[0].count("FileScan") == 1
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == 1000
    assert found.where("sink = 'errors'").count() == rows.where("error is not null").where(~sinks.oversized(config)).count()
    assert found.where("sink = 'fallback'").count() == rows.where(sinks.oversized(config)).count()
    # another attempt with other rows leaves nothing of the first
    sinks.write_sinks(rows.where("error is null"), str(tmp_path / "out"), 0)
    assert spark.read.parquet(str(tmp_path / "out")).select("sink").distinct().collect() == [("valid",)]


def test_staged_rows_are_decoded_once_and_whole(spark, events, tmp_path):
    rows = route(fx.raw_messages(events), fx.schemas_table(spark), fx.RULES, CONFIG)
    found = sinks.staged(rows, str(tmp_path / "staged"))
    assert "ArrowEvalPython" not in plan(found)
    assert found.drop("sink").exceptAll(rows).count() == 0 and found.count() == 1000
    assert "PartitionFilters: [isnotnull(sink" in plan(found.where("sink = 'valid'"))
    none = sinks.staged(rows.where("false"), str(tmp_path / "staged"))
    kept = []
    sinks.write_staged(none, lambda r: kept.append(r.count()), str(tmp_path / "fallback"), 0)
    assert kept == [0] and not (tmp_path / "fallback").exists()


# Counts ----------------------------------------------------------------------------------------


def test_counts_and_shapes_of_batches(spark, events):
    rows = route(fx.raw_messages(events), fx.schemas_table(spark), fx.RULES, CONFIG)
    topics = ["route_ru", "route_ua", "route_rest", "errors", "nobody"]
    counts = BatchCounts(spark, topics)
    for batch, part in enumerate(("offset < 400", "offset >= 400", "offset >= 400")):
        observed, done = observed_batch(rows.where(part), counts, "q", min(batch, 1))  # the last is a replay
        observed.write.format("noop").mode("overwrite").save()
        done()
    wanted = {r.topic: r for r in rows.groupBy("topic").agg(
        F.count("*").alias("n"), F.countDistinct("key").alias("keys"), F.max(F.octet_length("value")).alias("size")
    ).collect()}
    total = counts.totals("q")
    assert {t: total[t] for t in wanted} == {t: r.n for t, r in wanted.items()} and total["total"] == 1000
    shapes = {s[0]: s[1:] for s in counts.shapes("q", ranks=(0.0, 1.0))}
    assert set(shapes) == set(wanted)
    for topic, (keys, _, largest) in shapes.items():
        assert abs(keys - wanted[topic]["keys"]) <= 0.05 * wanted[topic]["keys"] + 1
        assert largest == wanted[topic]["size"]
    assert counts.totals("other") == {} and counts.shapes("other") == []


# Queries that end together ---------------------------------------------------------------------


def endless(spark, path, checkpoint, step):
    return message_stream(spark, path).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).start()


def test_a_failing_query_ends_the_others(spark, tmp_path):
    messages(spark, ["00"]).write.parquet(str(tmp_path / "in"))
    done = []

    def fail(rows, batch_id):
        raise RuntimeError("sink is down")

    queries = [
        endless(spark, str(tmp_path / "in"), str(tmp_path / "a"), lambda rows, i: done.append(rows.count())),
        endless(spark, str(tmp_path / "in"), str(tmp_path / "b"), fail),
    ]
    with pytest.raises(Exception, match="sink is down"):
        run_together(spark, queries, grace=60)
    assert not any(q.isActive for q in queries) and done == [1]


def test_queries_that_end_well(spark, tmp_path):
    messages(spark, ["00"]).write.parquet(str(tmp_path / "in"))
    out = [
        sinks.to_batches(message_stream(spark, str(tmp_path / "in")), lambda rows, i: None, str(tmp_path / n), once=True)
        for n in "ab"
    ]
    assert run_together(spark, out) == out


# The job ---------------------------------------------------------------------------------------


def job_env(spark, tmp_path, **more):
    fx.schemas_table(spark).write.mode("overwrite").parquet(str(tmp_path / "schemas"))
    return {
        "CHECKPOINT_LOCATION": str(tmp_path / "cp"), "SCHEMAS_PATH": str(tmp_path / "schemas"),
        "DEFAULT_SCHEMA_STR": fx.SCHEMA_7, **more,
    }


def test_the_job_s_table_has_each_event_once_after_a_replay(spark, events, tmp_path, monkeypatch):
    matched, out = str(tmp_path / "matched"), str(tmp_path / "out")
    fx.raw_messages(events).write.parquet(str(tmp_path / "in"))
    attempts = []

    def append_to_jdbc(rows, **connection):
        attempts.append(connection["table"])
        rows = rows.where("offset % 2 = 0") if len(attempts) == 1 else rows
        rows.write.mode("append").parquet(matched)
        if len(attempts) == 1:
            raise RuntimeError("database is down")

    monkeypatch.setattr(job, "append_to_jdbc", append_to_jdbc)
    monkeypatch.setattr(job, "table_from_jdbc", lambda spark, **_: spark.read.parquet(matched))
    writer = job.batch_writer
    monkeypatch.setattr(
        job, "batch_writer", lambda config, env: writer(config, env, sink=lambda rows, c: sinks.write_batch(rows, out, 0))
    )
    env = job_env(
        spark, tmp_path, MSSQL_JDBC_URL="jdbc:x", MSSQL_TARGET_TABLE="t", OTEL_ENABLE="true",
        MINIO_ENABLE="true", MINIO_BUCKET=str(tmp_path / "fallback"),
    )
    seen, add = [], BatchCounts.add
    monkeypatch.setattr(BatchCounts, "add", lambda self, run, batch, row: seen.append(row["total"]) or add(self, run, batch, row))
    with pytest.raises(Exception, match="database is down"):
        job.start(spark, env, message_stream(spark, str(tmp_path / "in"))).processAllAvailable()
    query = job.start(spark, env, message_stream(spark, str(tmp_path / "in")))
    query.processAllAvailable()
    query.stop()
    found = spark.read.parquet(matched)
    assert found.count() == 590 == found.select("source_topic", "partition", "offset").distinct().count()
    assert spark.read.parquet(out).count() == 1000 and seen == [1000] and len(attempts) == 2


def test_the_job_waits_for_schemas_when_asked(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    writer = job.batch_writer
    monkeypatch.setattr(
        job, "batch_writer", lambda config, env: writer(config, env, sink=lambda rows, c: rows.write.mode("append").parquet(out))
    )
    env = job_env(spark, tmp_path, HOLD_UNKNOWN_SECONDS="1000")
    schemas(spark, (7, fx.SCHEMA_7)).write.mode("overwrite").parquet(str(tmp_path / "schemas"))
    stream = lambda: message_stream(spark, str(tmp_path / "in"))
    for values, ids in (([framed(8, "02610261")], [7]), ([framed(7, "026100")], [7, 8])):
        schemas(spark, *[(i, {7: fx.SCHEMA_7, 8: fx.SCHEMA_8}[i]) for i in ids]).write.mode("overwrite").parquet(str(tmp_path / "schemas"))
        messages(spark, values).write.mode("append").parquet(str(tmp_path / "in"))
        query = job.start(spark, env, stream())
        query.processAllAvailable()
        query.stop()
    found = spark.read.parquet(out).collect()
    assert sorted((r.schema_id, r.error) for r in found) == [(7, None), (8, None)]


def test_the_job_broadcasts_the_schemas_in_use_of_a_large_registry(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(job, "batch_writer", lambda config, env: lambda rows, batch_id: seen.append((plan(rows), rows.count())))
    env = job_env(spark, tmp_path, MAX_BROADCAST_SCHEMAS="1")
    messages(spark, [framed(7, "026100"), framed(7, "026100")]).write.parquet(str(tmp_path / "in"))
    query = job.start(spark, env, message_stream(spark, str(tmp_path / "in")))
    query.processAllAvailable()
    query.stop()
    [(found, n)] = seen
    assert n == 2 and "SortMergeJoin" not in found and "Exchange hashpartitioning" not in found


# Refused messages ------------------------------------------------------------------------------


def refusing(taken, bad):
    """A sink that takes a part as a whole, or not at all if it holds one of the bad offsets."""

    def write(rows):
        offsets = texts(rows, "offset")
        if bad & set(offsets):
            raise RuntimeError("record too large")
        taken.extend(offsets)

    return write


@pytest.mark.parametrize("bad, budget", [({3, 77, 78}, 200), ({5}, 200), (set(), 200), ({1, 50, 90}, 4)])
def test_refused_messages_go_to_files_and_no_message_is_lost_or_twice(spark, tmp_path, bad, budget):
    rows = messages(spark, ["00"] * 100).withColumnRenamed("topic", "source_topic").cache()
    taken, path = [], str(tmp_path / "refused")
    sinks.write_isolating(rows, refusing(taken, bad), path, 0, budget)
    left = texts(spark.read.parquet(path), "offset") if bad else []
    assert sorted(taken + left) == list(range(100)) and bad <= set(left)
    assert budget < 200 or set(left) == bad
    if bad:  # a replay replaces its files
        again = []
        sinks.write_isolating(rows, refusing(again, bad), path, 0, budget)
        assert sorted(again + texts(spark.read.parquet(path), "offset")) == list(range(100))


def test_a_sink_that_takes_nothing_is_down(spark, tmp_path):
    rows = messages(spark, ["00"] * 9).withColumnRenamed("topic", "source_topic").cache()
    with pytest.raises(RuntimeError, match="too large"):
        sinks.write_isolating(rows, refusing([], set(range(9))), str(tmp_path / "refused"), 0)
    assert not (tmp_path / "refused").exists()


def test_a_large_registry_sends_its_text_once(spark):
    """Messages meet their schema in order: no text in their rows, the same answers."""
    from sluicegate.operators.decode import decode
    from sluicegate.operators.schemas import sorted_in
    from sluicegate.operators.wire import split_wire

    values = [framed(1, "0261"), framed(2, "0262"), framed(3, "01"), framed(1, "7E"), framed(9, "0261"), "0261", None, "0000", ""] * 30
    table = schemas(spark, (1, record(phone="string")), (2, record(phone="string", n="int")), (3, record(phone="boolean")), (4, "no schema"))
    split = split_wire(messages(spark, values))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = []
        for limit in (100, 0):
            for default in ("", record(phone="string")):
                rows = decode(split, {"phone": "phone"}, Registry.load(table, max_schemas=limit), default)
                assert rows.columns == [*split.columns, "phone", "decode_error"]
                found.append(sorted(map(str, rows.select("offset", "phone", "decode_error").collect())))
        assert found[0] == found[2] and found[1] == found[3] and len(found[0]) == len(values)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    large = Registry.load(table, max_schemas=0)
    both = sorted_in(split, large)
    assert both.where("schema_json is not null").count() == 4 * large.copies
    assert both.where("schema_json is not null and value is not null").count() == 0
    found = plan(decode(split, {"phone": "phone"}, large, ""))
    assert "SortMergeJoin" not in found and "Join" not in found
