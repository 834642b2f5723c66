"""Each stage on hand-written messages."""

import json
import random

import pytest
from avro_encode import long
from helpers import messages, plan, record, schemas, texts
from pyspark.sql import functions as F

from sluicegate import Registry, RouterConfig, Rules, route
from sluicegate.functions.rules import can_join
from sluicegate.operators import rules as rule_steps
from sluicegate.operators.decode import decode, decode_with, record_fields
from sluicegate.operators.rules import apply_rules
from sluicegate.operators import schemas as schemas_module
from sluicegate.operators.schemas import attach_schema, latest_schema, resolve_schema, sorted_in
from sluicegate.operators.wire import split_wire
from sluicegate.plans import fixtures as fx

# value, strict error, lenient error
WIRE_ROWS = [
    (None, "empty_value", "empty_value"),
    ("", "empty_value", "empty_value"),
    ("00", "bad_wire_header", None),
    ("0000", "bad_wire_header", None),
    ("00000000", "bad_wire_header", None),
    ("0000000007", None, None),
    ("00FFFFFFFE00", None, None),
    ("026100", None, None),
]


@pytest.mark.parametrize("policy,column", [("strict", 1), ("lenient", 2)])
def test_wire_errors(spark, policy, column):
    split = split_wire(messages(spark, [r[0] for r in WIRE_ROWS]), policy)
    assert texts(split, "wire_error") == [r[column] for r in WIRE_ROWS]


def test_wire_ids_and_payloads(spark):
    split = split_wire(messages(spark, [r[0] for r in WIRE_ROWS]), "lenient")
    assert texts(split, "schema_id") == [None, None, None, None, None, 7, 4294967294, None]
    assert texts(split, F.hex("payload")) == [None, None, "00", "0000", "00000000", "", "00", "026100"]


def test_wire_split_needs_no_python(spark, events):
    assert "Python" not in plan(split_wire(fx.raw_messages(events)))


# Rows of FIXTURES.md: value, config, error, route value
HAND_ROWS = [
    ("00", {}, "bad_wire_header", None),
    ("00", {"wire": "lenient"}, "decode_failed", None),
    ("0000", {"wire": "lenient"}, None, None),
    ("0000000007", {}, "decode_failed", None),
    ("000000000702610204", {}, "decode_failed", None),
    ("00FFFFFFFE00", {}, "unknown_schema", None),
    ("026100", {}, None, None),
    ("026100", {"default_schema": ""}, "no_default_schema", None),
    ("00000000070261020478797A", {}, None, "xy"),  # trailing bytes are ignored
]


@pytest.mark.parametrize("value,settings,error,found", HAND_ROWS)
def test_hand_written_rows(spark, value, settings, error, found):
    config = RouterConfig(**{"default_schema": fx.SCHEMA_7, **settings})
    row = route(messages(spark, [value]), fx.schemas_table(spark), fx.RULES, config).head()
    assert (row.error, row.route_value) == (error, found)
    assert row.topic == ("errors" if error else "route_rest")


def test_unframed_body_that_starts_with_a_zero_byte_reads_as_framed(spark):
    default = json.dumps({"type": "record", "name": "R", "fields": [
        {"name": "phone", "type": ["null", "string"]}, {"name": "event_type", "type": "string"}]})
    row = route(
        messages(spark, ["000A6572726F72"]), fx.schemas_table(spark), fx.RULES,
        RouterConfig(default_schema=default),
    ).head()
    assert (row.schema_id, row.error) == (0x0A657272, "unknown_schema")


# -- schemas ------------------------------------------------------------------------------


def test_latest_schema_per_subject(spark):
    table = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 3, 2, "y"), ("a", 2, 3, "z"), ("b", 1, 4, "w")],
        "subject string, version bigint, schema_id bigint, schema_json string",
    )
    found = {r.subject: (r.version, r.schema_id) for r in latest_schema(table).collect()}
    assert found == {"a": (3, 2), "b": (1, 4)}
    assert [r.schema_json for r in latest_schema(table, "b").collect()] == ["w"]


def test_schema_precedence(spark, tmp_path):
    table = fx.schemas_table(spark)
    file = tmp_path / "reader.avsc"
    file.write_text(record(f="int"))
    inline = RouterConfig(reader_schema=record(i="int"), reader_schema_file=str(file))
    assert resolve_schema(spark, table, inline) == ("inline", record(i="int"))
    from_file = RouterConfig(reader_schema_file=str(file))
    assert resolve_schema(spark, table, from_file) == ("file", record(f="int"))
    assert resolve_schema(spark, table, RouterConfig()) == ("registry", fx.SCHEMA_8)


def test_schemas_that_cannot_be_used_stop_the_start(spark, tmp_path):
    with pytest.raises(ValueError, match="default_schema is not JSON"):
        RouterConfig(default_schema="{oops")
    with pytest.raises(ValueError, match="reader_schema is not JSON"):
        RouterConfig(reader_schema="{oops")
    file = tmp_path / "bad.avsc"
    file.write_text("{oops")
    with pytest.raises(ValueError, match="not JSON"):
        resolve_schema(spark, None, RouterConfig(reader_schema_file=str(file)))
    with pytest.raises(ValueError, match="no schema registered"):
        resolve_schema(spark, fx.schemas_table(spark), RouterConfig(subject="other"))


def test_an_id_listed_twice_does_not_repeat_messages(spark):
    table = fx.schemas_table(spark).unionAll(fx.schemas_table(spark).withColumn("subject", F.lit("z")))
    for limit in (10, 0):
        registry = Registry.load(table, max_schemas=limit)
        split = split_wire(messages(spark, ["00000000070261020278", "000000000804787902"]))
        assert attach_schema(split, registry).count() == 2


def test_registry_size_decides_how_schemas_travel(spark, events):
    split = split_wire(fx.raw_messages(events))
    small = Registry.load(fx.schemas_table(spark))
    assert "BroadcastHashJoin" in plan(attach_schema(split, small))
    for large in (
        Registry.load(fx.schemas_table(spark), max_schemas=1),
        Registry.load(fx.schemas_table(spark), max_bytes=100),
    ):
        assert large.texts is None
        assert "SortMergeJoin" in plan(attach_schema(split, large))
        assert "Broadcast" not in plan(attach_schema(split, large))


def test_large_registry_gives_the_same_answers(spark, events):
    config = RouterConfig(default_schema=fx.SCHEMA_7)
    raw, table = fx.raw_messages(events), fx.schemas_table(spark)
    small = route(raw, table, fx.RULES, config)
    large = route(raw, Registry.load(table, max_schemas=0), fx.RULES, config)
    columns = [c for c in small.columns if c != "headers"]
    assert small.count() == large.count()
    assert small.select(columns).exceptAll(large.select(columns)).count() == 0


def test_copies_of_a_large_registry_follow_the_shuffle_up_to_a_bound(spark):
    table = fx.schemas_table(spark)
    assert Registry.load(table, max_schemas=0).copies == 8
    assert 1 <= Registry.load(table, max_schemas=0, max_copied_bytes=900).copies < 8
    one = Registry.load(table, max_schemas=0, max_copied_bytes=0)
    assert one.copies == 1
    split = split_wire(messages(spark, ["000000000702610200", "00FFFFFFFE00"]))
    assert texts(attach_schema(split, one), "known") == [True, False]


def test_large_registry_needs_no_message_coordinates(spark):
    bare = split_wire(messages(spark, ["026100", "000000000702610200"]).drop("partition", "offset"))
    large = Registry.load(fx.schemas_table(spark), max_schemas=0)
    rows = attach_schema(bare, large).select("schema_id", "known").collect()
    assert sorted(map(tuple, rows), key=str) == [(7, True), (None, None)]


def test_only_schemas_with_many_messages_are_copied(spark):
    entries = [("s", 1, k, fx.SCHEMA_7) for k in range(1, 500)]
    table = spark.createDataFrame(entries, "subject string, version long, schema_id long, schema_json string")
    ids = [*range(1, 101), 700, *[5] * 300]
    split = split_wire(messages(spark, [f"00{k:08x}02610200" for k in ids] + ["02610200"] * 50))
    registry = Registry.load(table, max_schemas=9)
    used = registry.in_use(split)
    assert used.texts is None and used.hot == (5,) and used.copies == registry.copies == 8
    both = sorted_in(split, used)
    assert both.where("schema_json is not null").count() == 99 + 8  # those in use, not 499 x 8
    rows = decode(split, {"phone": "phone"}, registry, fx.SCHEMA_7)
    whole = decode(split, {"phone": "phone"}, Registry.load(table), fx.SCHEMA_7)
    assert texts(rows.orderBy("offset"), "decode_error") == texts(whole.orderBy("offset"), "decode_error")
    assert rows.count() == len(ids) + 50 and rows.where("decode_error = 'unknown_schema'").count() == 1


def test_texts_of_schemas_that_no_message_uses_are_not_compared(spark, monkeypatch):
    entries = [(f"s{k % 3}", k // 3, k % 90 + 1, f'"text {k}"') for k in range(900)]
    table = spark.createDataFrame(entries, "subject string, version long, schema_id long, schema_json string")
    grouped, whole = [], schemas_module.texts_within

    def seen(table, *bounds):
        grouped.append(plan(table))
        return whole(table, *bounds)

    monkeypatch.setattr(schemas_module, "texts_within", seen)
    registry = Registry.load(table, max_schemas=20)
    assert registry.texts is None and grouped == []  # ids and sizes tell
    used = registry.in_use(split_wire(messages(spark, ["000000000702610200", "00FFFFFFFE00", "026100"])))
    assert used.texts == {7: '"text 816"'}
    [found] = grouped  # the other entries go before texts are compared
    assert found.index("max_by") < found.index("LeftSemi")
    assert {r.schema_id: r.schema_json for r in registry.table.collect()}[7] == '"text 816"'


def test_a_large_registry_is_narrowed_to_the_ids_in_use(spark):
    table = fx.schemas_table(spark)  # of ids 7 and 8
    split = split_wire(messages(spark, ["000000000702610200", "00FFFFFFFE00", "026100"]))
    used = Registry.load(table, max_schemas=1).in_use(split)
    assert list(used.texts) == [7]
    assert Registry.load(table, max_schemas=0).in_use(split).texts is None
    rows = decode(split, {"phone": "phone"}, Registry.load(table, max_schemas=1), fx.SCHEMA_7)
    assert "SortMergeJoin" not in plan(rows) and "Exchange hash" not in plan(rows)
    assert texts(rows, "decode_error") == [None, "unknown_schema", None]


def test_more_field_types_than_allowed_stop_the_job(spark):
    config = RouterConfig(max_field_types=0)
    with pytest.raises(ValueError, match="more than 0 types"):
        route(messages(spark, ["026100"]), fx.schemas_table(spark), fx.RULES, config)


def test_one_schema_file(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.avsc").write_text(fx.SCHEMA_7)
    with pytest.raises(ValueError, match="several"):
        resolve_schema(spark, None, RouterConfig(reader_schema_file=str(tmp_path)))


# -- decode -------------------------------------------------------------------------------


def framed(schema_id, body):
    return (b"\x00" + schema_id.to_bytes(4, "big") + body).hex()


def test_fields_of_different_types_become_text_the_way_spark_casts(spark):
    table = schemas(
        spark,
        (1, record(phone="string")),
        (2, record(phone="long")),
        (3, record(phone="boolean")),
        (4, record(phone="double")),
        (5, record(phone=["null", "string", "int"])),
        (6, record(other="string")),
        (7, record(phone="null")),
    )
    import struct

    values = [
        framed(1, b"\x02x"), framed(2, long(-12)), framed(3, b"\x01"),
        framed(4, struct.pack("<d", 1e10)), framed(5, long(1) + b"\x02y"), framed(5, long(2) + long(9)),
        framed(5, long(0)), framed(6, b"\x02z"), framed(7, b""),
    ]
    rows = decode(split_wire(messages(spark, values)), {"phone": "phone"}, Registry.load(table))
    assert texts(rows, "phone") == ["x", "-12", "true", "1.0E10", "y", "9", None, None, None]
    assert texts(rows, "decode_error") == [None] * 9
    large = Registry.load(table, max_schemas=0)
    again = decode(split_wire(messages(spark, values)), {"phone": "phone"}, large)
    assert texts(again, "phone") == texts(rows, "phone")


def test_asked_for_types_are_cast_softly(spark):
    table = schemas(spark, (1, record(n="string")), (2, record(n="int")))
    values = [framed(1, b"\x0412"), framed(1, b"\x02x"), framed(2, long(7))]
    rows = decode(split_wire(messages(spark, values)), {"n": ("n", "bigint")}, Registry.load(table))
    assert texts(rows, "n") == [12, None, 7]


def test_path_into_maps_arrays_and_nested_records(spark):
    item = {"type": "record", "name": "I", "fields": [{"name": "q", "type": "string"}]}
    table = schemas(
        spark,
        (1, record(m={"type": "map", "values": "string"}, a={"type": "array", "items": item})),
    )
    body = long(1) + b"\x02k" + b"\x02v" + long(0) + long(2) + b"\x02x\x02y" + long(0)
    fields = {"at_k": "m.k", "at_z": "m.z", "qs": ("a.q", "array<string>"), "deep": "a.q"}
    rows = decode(split_wire(messages(spark, [framed(1, body)])), fields, Registry.load(table))
    row = rows.head()
    assert (row.at_k, row.at_z, row.qs, row.deep) == ("v", None, ["x", "y"], "[x, y]")


def test_fields_that_cannot_be_reached_or_cast_are_null(spark):
    texts_ = {"type": "array", "items": "string"}
    table = schemas(
        spark,
        (1, record(a=texts_, n=texts_)),
        (2, record(a={"type": "map", "values": "long"}, n="boolean")),
        (3, record(a="string", n="long")),
    )
    values = [
        framed(1, long(1) + b"\x02x" + long(0) + long(0)),
        framed(2, long(1) + b"\x02q" + long(5) + long(0) + b"\x01"),
        framed(3, b"\x02x" + long(8)),
    ]
    fields = {"at_q": "a.q", "n": ("n", "date"), "m": ("n", "bigint")}
    for limit in (10, 0):
        registry = Registry.load(table, max_schemas=limit)
        rows = decode(split_wire(messages(spark, values)), fields, registry)
        assert texts(rows, "at_q") == [None, "5", None]
        assert texts(rows, "m") == [None, 1, 8]
        assert texts(rows, "n") == [None, None, None]
        assert texts(rows, "decode_error") == [None, None, None]


def test_schema_without_text_fails_its_messages_only(spark):
    table = schemas(spark, (1, None), (2, record(phone="string")))
    values = [framed(1, b"\x02a"), framed(2, b"\x02a"), "0261"]
    for limit in (10, 0):
        registry = Registry.load(table, max_schemas=limit)
        split = split_wire(messages(spark, values))
        rows = decode(split, {"phone": "phone"}, registry, record(phone="string"))
        assert texts(rows, "phone") == [None, "a", "a"]
        assert texts(rows, "decode_error") == ["decode_failed", None, None]


def test_writer_schema_that_is_no_record_fails(spark):
    table = schemas(spark, (1, '"string"'), (2, "{oops"), (3, '{"type":"nosuch"}'), (4, "[]"))
    values = [framed(i, b"\x02a") for i in (1, 2, 3, 4)]
    rows = decode(split_wire(messages(spark, values)), {"phone": "phone"}, Registry.load(table))
    assert texts(rows, "decode_error") == ["decode_failed"] * 4


def test_whole_record_with_the_reader_schema(spark):
    rows = decode_with(
        split_wire(messages(spark, ["00000000070261020278", "026100"])),
        record_fields(fx.SCHEMA_7),
        fx.SCHEMA_7,
    )
    assert texts(rows, "event_type") == ["a", "a"]
    assert texts(rows, "phone") == ["x", None]


def test_decode_is_one_python_node_under_a_filter(spark, events):
    routed = route(
        fx.raw_messages(events), fx.schemas_table(spark), fx.RULES,
        RouterConfig(default_schema=fx.SCHEMA_7),
    )
    for frame in (routed, routed.where("error is null"), routed.where("error is not null")):
        text = plan(frame)
        assert text.count("ArrowEvalPython") == 1
        assert text.replace("BroadcastExchange", "").count("Exchange") == 0
        assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


# -- rules --------------------------------------------------------------------------------


def test_rules_keep_the_order_of_their_json():
    rules = Rules.of('{"^\\\\+7\\\\d{10}$":"ru", "b":"2", "a":"1", ".*":"rest"}')
    assert rules.pairs == ((r"^\+7\d{10}$", "ru"), ("b", "2"), ("a", "1"), (".*", "rest"))
    assert rules.buckets == ("ru", "2", "1", "rest")


def test_rules_that_cannot_be_used(spark):
    with pytest.raises(ValueError, match="not JSON"):
        Rules.of('{"^\\+7":"ru"}')
    with pytest.raises(ValueError, match="JSON object"):
        Rules.of("[1]")
    with pytest.raises(ValueError, match=r"\['\('\]"):
        Rules.of([("a", "x"), ("(", "y")]).check(spark)
    table = fx.rules_table(spark)
    with pytest.raises(ValueError, match="empty"):
        Rules.of(table.limit(0))
    with pytest.raises(ValueError, match="same ord"):
        Rules.of(table.withColumn("ord", F.lit(1)))
    with pytest.raises(ValueError, match="nulls"):
        Rules.of(table.withColumn("bucket", F.lit(None).cast("string")))


def test_table_rules_are_ordered_by_ord(spark):
    table = spark.createDataFrame([(2, "b", "B"), (1, "a", "A")], "ord int, pattern string, bucket string")
    assert Rules.of(table).pairs == (("a", "A"), ("b", "B"))


CASES = ["+7123", "x+7123", "+380", "", None, "+7123\n"]


@pytest.mark.parametrize("few", [8, 2, 1])
def test_matching_modes(spark, monkeypatch, few):
    """However many expressions the rules take, and also with joined patterns."""
    monkeypatch.setattr(rule_steps, "FEW_RULES", few)
    monkeypatch.setattr(rule_steps, "COLUMN_PATTERNS", few)
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(CASES)], "route_value string, offset int")
    rules = Rules.of([(r"\+7|\+38", "plus"), (r"\d", "digit"), (r"^$", "blank")])

    def found(**settings):
        return texts(apply_rules(frame, rules, RouterConfig(**settings)), "bucket")

    assert found() == ["plus", "plus", "plus", "blank", "blank", "plus"]
    assert found(match="last") == ["digit", "digit", "digit", "blank", "blank", "digit"]
    assert found(anchored=True) == ["plus", None, "plus", "blank", "blank", "plus"]
    assert found(null_field="default") == ["plus", "plus", "plus", "blank", None, "plus"]


TRICKY = [
    "b+", "^a", "^a|c$", r"\Aab", "^?b", "(a)(b)?", "(?i)AB", r"(a|b)\1", r"\Qa.\E", "(?<x>c)c",
    "a(?=c)", "(?<!a)b", "[(?]", r"\(\?", "a{2}", "", "$^", r"\.", "(?:a|ab)(?:c|bcd)", "ж", "\n",
]
SUBJECTS = [None, "", "a", "ab", "abcd", "bb", "aa", "AB", "a.", "cc", "ac", "cb", "(?", "xж", "a\nb", "z"]


@pytest.mark.parametrize("match", ["first", "last"])
@pytest.mark.parametrize("anchored", [False, True])
def test_joined_patterns_match_as_the_rules_one_by_one(spark, monkeypatch, match, anchored):
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(SUBJECTS)], "route_value string, offset int")
    config = RouterConfig(match=match, anchored=anchored)
    for seed in range(6):
        chosen = random.Random(seed).sample(TRICKY, 14)
        rules = Rules.of([(p, f"b{i % 9}") for i, p in enumerate(chosen)]).check(spark)
        found = {}
        for few in (0, 8, 100):
            monkeypatch.setattr(rule_steps, "FEW_RULES", max(few, 1))
            monkeypatch.setattr(rule_steps, "JOINED_RULES", 5 if few == 8 else 64)
            found[few] = texts(apply_rules(frame, rules, config), "bucket")
        assert found[0] == found[8] == found[100]


def test_patterns_joined_only_where_they_keep_their_meaning():
    apart = {"(?i)AB", r"(a|b)\1", r"\Qa.\E", "(?<x>c)c", "[(?]"}
    assert {p for p in TRICKY if not can_join(p)} == apart


def test_many_rules_make_few_searches(spark):
    frame = spark.createDataFrame([("+71", 0)], "route_value string, offset int")
    for many in (1000, 5000):
        rules = Rules.of([(rf"^\+7{n}$", f"b{n}") for n in range(many)])
        found = apply_rules(frame, rules, RouterConfig())
        assert texts(found, "bucket") == ["b1"]
        assert found._jdf.queryExecution().analyzed().toString().count("RLIKE") <= many / 4


def test_absent_field_and_the_catch_all_rule(spark):
    values = ["026100", "0261020A2B3337", "02610200"]
    base = {"default_schema": fx.SCHEMA_7}
    rules = [("^$", "blank"), (r"^\+7", "ru"), (".*", "rest")]

    def found(rules, **settings):
        config = RouterConfig(**base, **settings)
        return texts(route(messages(spark, values), fx.schemas_table(spark), rules, config), "bucket")

    assert found(rules) == ["blank", None, "blank"]  # the second body is cut off
    assert found(rules, null_field="default") == ["rest", None, "blank"]
    assert found(rules[:2], null_field="default") == [None, None, "blank"]
    assert found([]) == [None, None, None]


# -- output -------------------------------------------------------------------------------


def test_error_texts_of_the_variants(spark):
    values = [None, "", "0000", "00FFFFFFFE00", "026100", "0000000007"]
    table = fx.schemas_table(spark)

    def found(style, **settings):
        config = RouterConfig(error_style=style, **settings)
        return texts(route(messages(spark, values), table, [("x", "y")], config), "error")

    assert found("message") == [
        "Empty value", "Empty payload", "Bad wire header (no schema id)", "unknown_schema",
        "DEFAULT_SCHEMA_STR is empty", "decode_failed",
    ]
    assert found("reader", default_schema=fx.SCHEMA_7) == [
        "wire_error: empty_value", "wire_error: empty_value", "wire_error: bad_wire_header",
        "unknown_schema", "no_route_matched", "from_avro_failed",
    ]


def test_headers_bytes_and_topics(spark):
    config = RouterConfig(default_schema=fx.SCHEMA_7, topic_prefix="out", errors_topic="bad")
    values = ["00000000070261020278", "0000"]
    rows = route(messages(spark, values), fx.schemas_table(spark), fx.RULES, config)
    good, bad = rows.orderBy("offset").collect()
    assert (good.topic, good.source_topic, bytes(good.key)) == ("out_rest", "raw-a", b"k")
    assert [(h.key, bytes(h.value)) for h in good.headers] == [("trace", b"1")]
    assert (bad.topic, bad.bucket, bytes(bad.value)) == ("bad", None, b"\x00\x00")
    assert [(h.key, bytes(h.value)) for h in bad.headers] == [("error", b"bad_wire_header")]


def test_messages_without_headers_or_with_text_keys(spark):
    raw = messages(spark, ["026100"]).drop("headers").withColumn("key", F.lit("text"))
    row = route(raw, fx.schemas_table(spark), fx.RULES, RouterConfig(default_schema=fx.SCHEMA_7)).head()
    assert (row.headers, bytes(row.key), row.topic) == (None, b"text", "route_rest")


def test_invalid_settings():
    for setting in ("wire", "match", "schema_mode", "null_field", "error_style"):
        with pytest.raises(ValueError, match=setting):
            RouterConfig(**{setting: "no"})


def test_settings_from_the_environment():
    env = {
        "KAFKA_BOOTSTRAP": "b1:9092,b2:9092", "INPUT_TOPICS": "a,b", "ERRORS_TOPIC": "e",
        "ROUTE_TOPIC_PREFIX": "p", "PHONE_FIELD": "c.phone", "CHECKPOINT_LOCATION": "/c",
        "STARTING_OFFSETS": "earliest", "OUTPUT_KAFKA_ACKS": "1", "SCHEMA_SUBJECT": "",
    }
    config = RouterConfig.from_env(RouterConfig.one_schema(), env)
    assert (config.bootstrap, config.input_topics) == ("b1:9092,b2:9092", ("a", "b"))
    assert (config.errors_topic, config.topic_prefix, config.route_field) == ("e", "p", "c.phone")
    assert (config.checkpoint, config.starting_offsets, config.acks) == ("/c", "earliest", "1")
    assert (config.subject, config.match, config.wire) == ("raw-input-value", "last", "lenient")
