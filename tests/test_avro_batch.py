import json
import uuid

import numpy as np
import pyarrow as pa
import pytest
from avro_encode import encode, long, plain, records, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluicegate.functions import avro_batch, avro_udf
from sluicegate.functions.avro_batch import Batch, value_end
from sluicegate.functions.avro_types import Slot, parse, shape, slots_for, spark_type
from sluicegate.functions.avro_udf import Schemas, decode_batch

SLOW = settings(max_examples=150, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


def unique_names(schema, seen=None):
    """Random named types may collide; give each its own name."""
    if isinstance(schema, list):
        return [unique_names(s) for s in schema]
    if isinstance(schema, dict):
        out = {k: unique_names(v) if k in ("type", "items", "values") else v for k, v in schema.items()}
        if "name" in schema and "type" in schema and schema["type"] in ("record", "enum", "fixed"):
            out["name"] = "N" + uuid.uuid4().hex
        if "fields" in schema:
            out["fields"] = [dict(f, type=unique_names(f["type"])) for f in schema["fields"]]
        return out
    return schema


def read_all(schema, bodies):
    batch = Batch(pa.array(bodies, pa.binary()))
    array, pos = batch.own(parse(json.dumps(schema)), True, *batch.spans)
    array.validate(full=True)
    return array.to_pylist(), pos == batch.fail, pos


def one_schema(schema):
    return Schemas(lambda _: json.dumps(schema))


def decode(schema, bodies, *paths):
    root = parse(json.dumps(schema))
    slots = [s for p in paths for s in slots_for(root, tuple(p.split(".")))]
    keys = pa.nulls(len(bodies), pa.int64())
    payload = pa.array(bodies, pa.binary())
    arrays, failed = decode_batch(payload, keys, one_schema(schema), slots)
    return [a.to_pylist() for a in arrays], failed.tolist()


@st.composite
def cases(draw):
    schema = unique_names(draw(records()))
    return schema, draw(st.lists(values(schema), min_size=1, max_size=5))


@pytest.fixture(params=[0, 16, 10**9], ids=["step", "mixed", "scan"], autouse=True)
def few_rows(request, monkeypatch):
    """Every test with array elements found step by step, by scan, and by either."""
    monkeypatch.setattr(avro_batch, "FEW_ROWS", request.param)


@SLOW
@given(cases(), st.lists(st.binary(max_size=30), max_size=8), st.booleans())
def test_one_row_ends_where_many_do(case, garbage, sized):
    schema, rows = case
    node = parse(json.dumps(schema))
    bodies = [encode(schema, r, sized) for r in rows]
    bodies += garbage + [b[: len(b) * 2 // 3] + g for b, g in zip(bodies, garbage)]
    batch = Batch(pa.array(bodies, pa.binary()))
    _, after = batch.own(node, False, *batch.spans)
    view = memoryview(batch.bytes)
    alone = [value_end(node, view, int(a), int(b), 0) for a, b in zip(*batch.spans)]
    assert alone == [-1 if a == batch.fail else a for a in after.tolist()]


@SLOW
@given(cases(), st.booleans())
def test_roundtrip(case, sized):
    schema, rows = case
    found, failed, pos = read_all(schema, [encode(schema, r, sized) for r in rows])
    assert found == [plain(schema, r) for r in rows]
    assert not failed.any()


@SLOW
@given(cases(), st.booleans())
def test_skipping_ends_where_reading_ends(case, sized):
    schema, rows = case
    bodies = [encode(schema, r, sized) + b"tail" for r in rows]
    batch = Batch(pa.array(bodies, pa.binary()))
    _, after = batch.own(parse(json.dumps(schema)), False, *batch.spans)
    assert (batch.spans[1] - after).tolist() == [4] * len(rows)


@SLOW
@given(cases())
def test_every_strict_prefix_fails(case):
    schema, rows = case
    bodies = [encode(schema, r) for r in rows]
    cut = [b[:n] for b in bodies for n in range(len(b))]
    if cut:
        _, failed, _ = read_all(schema, cut)
        assert failed.all()
        batch = Batch(pa.array(cut, pa.binary()))
        _, after = batch.own(parse(json.dumps(schema)), False, *batch.spans)
        assert (after == batch.fail).all()


@SLOW
@given(cases(), st.lists(st.binary(max_size=40), min_size=1, max_size=20))
def test_garbage_fails_alone(case, garbage):
    """Broken rows neither raise nor change the rows around them."""
    schema, rows = case
    bodies = []
    for i, junk in enumerate(garbage):
        bodies += [encode(schema, rows[i % len(rows)]), junk]
    found, failed, _ = read_all(schema, bodies)
    assert not failed[::2].any()
    assert found[::2] == [plain(schema, rows[i % len(rows)]) for i in range(len(garbage))]
    batch = Batch(pa.array(bodies, pa.binary()))
    batch.own(parse(json.dumps(schema)), False, *batch.spans)


@SLOW
@given(cases())
def test_picked_fields_equal_the_whole_record(case):
    schema, rows = case
    root = parse(json.dumps(schema))
    slots = {}
    for name, child in root.fields:
        slots[name] = Slot((name,), spark_type(child))
    shapes = [f["type"] for f in schema["fields"]]
    bodies = [encode(schema, r) for r in rows]
    keys = pa.nulls(len(bodies), pa.int64())
    arrays, failed = decode_batch(
        pa.array(bodies, pa.binary()), keys, one_schema(schema), list(slots.values())
    )
    assert not failed.any()
    for (name, _), array, shape in zip(slots.items(), arrays, shapes):
        if isinstance(shape, list):
            continue  # a picked union is split by member type
        assert array.to_pylist() == [plain(shape, r[name]) for r in rows]


@pytest.mark.parametrize("number", [0, -1, 1, 63, 64, -64, -65, 2**31 - 1, -(2**31), 2**63 - 1, -(2**63)])
def test_varint(number):
    schema = {"type": "record", "name": "R", "fields": [{"name": "n", "type": "long"}]}
    assert decode(schema, [long(number)], "n") == ([[number]], [False])


def test_int_out_of_range_and_overlong_varint_fail():
    schema = {"type": "record", "name": "R", "fields": [{"name": "n", "type": "int"}]}
    assert decode(schema, [long(2**31), b"\xff" * 11 + b"\x01", long(5)], "n")[1] == [True, True, False]


def test_hostile_lengths_fail_without_allocating():
    text = {"type": "record", "name": "R", "fields": [{"name": "s", "type": "string"}]}
    items = {"type": "record", "name": "R", "fields": [{"name": "a", "type": {"type": "array", "items": "null"}}]}
    longs = {"type": "record", "name": "R", "fields": [{"name": "a", "type": {"type": "array", "items": "long"}}]}
    doubles = {"type": "record", "name": "R", "fields": [{"name": "a", "type": {"type": "array", "items": "double"}}]}
    for huge in (2**62, 2**63 - 1, -1, -(2**63), 2**40):
        assert decode(text, [long(huge) + b"abc"], "s")[1] == [True]
        for schema in (items, longs, doubles):
            if huge == -1:
                continue  # a legal block of one element
            assert decode(schema, [long(huge) + b"abc\x00"], "a")[1] == [True]


def test_recursive_schema_can_be_skipped_and_is_bounded():
    schema = {
        "type": "record",
        "name": "List",
        "fields": [{"name": "phone", "type": "string"}, {"name": "next", "type": ["null", "List"]}],
    }
    def chain(n):
        return (long(1) + b"a" + long(1)) * n + long(1) + b"z" + long(0)

    values_, failed = decode(schema, [chain(0), chain(1500), chain(5000), chain(50)[:-1]], "phone")
    assert values_[0][:2] == ["z", "a"]
    assert failed == [False, False, True, True]
    many = [chain(150)] * 20 + [chain(150)[:-1]]
    assert decode(schema, many, "phone")[1] == [False] * 20 + [True]


def test_long_arrays_of_nothing_are_skipped():
    nothing = {"type": "array", "items": "null"}
    schema = {"type": "record", "name": "R", "fields": [{"name": "a", "type": nothing}, {"name": "n", "type": "long"}]}
    bodies = [long(n) + long(0) + long(7) for n in (1_000_001, 2**62)]
    for repeat in (1, 20):
        assert decode(schema, bodies * repeat, "n") == ([[7, 7] * repeat], [False, False] * repeat)


def test_paths_through_nullable_records_and_mixed_unions():
    inner = {"type": "record", "name": "C", "fields": [{"name": "phone", "type": ["null", "string", "long"]}]}
    schema = {"type": "record", "name": "R", "fields": [{"name": "c", "type": ["null", inner]}, {"name": "z", "type": "int"}]}
    bodies = [
        encode(schema, {"c": (0, None), "z": 1}),
        encode(schema, {"c": (1, {"phone": (1, "+7")}), "z": 1}),
        encode(schema, {"c": (1, {"phone": (2, 7)}), "z": 1}),
        encode(schema, {"c": (1, {"phone": (0, None)}), "z": 1}),
    ]
    found, failed = decode(schema, bodies, "c.phone")
    assert found == [[None, "+7", None, None], [None, None, 7, None]]
    assert failed == [False] * 4


def test_invalid_utf8_fails_one_row():
    schema = {"type": "record", "name": "R", "fields": [{"name": "s", "type": "string"}]}
    found, failed = decode(schema, [long(1) + b"a", long(2) + b"\xff\xfe", long(1) + b"b"], "s")
    assert failed == [False, True, False]
    assert [found[0][0], found[0][2]] == ["a", "b"]


def test_rows_of_several_schemas_and_null_payloads():
    a = json.dumps({"type": "record", "name": "R", "fields": [{"name": "x", "type": "string"}]})
    b = json.dumps({"type": "record", "name": "R", "fields": [{"name": "n", "type": "int"}, {"name": "x", "type": "string"}]})
    texts = {1: a, 2: b, 3: "not a schema", None: a}
    slot = slots_for(parse(a), ("x",))
    payload = pa.array([b"\x02p", None, b"\x02\x02q", b"\x02r", b"\x02s", b""], pa.binary())
    keys = pa.array([1, 99, 2, None, 3, 2], pa.int64())  # 99 is unknown, but has no payload
    arrays, failed = decode_batch(payload, keys, Schemas(texts.__getitem__), slot)
    assert failed.tolist() == [False, False, False, False, True, True]
    assert arrays[0].to_pylist()[:4] == ["p", None, "q", "r"]


def test_large_batches_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(avro_udf, "PIECE_BYTES", 10)
    schema = {"type": "record", "name": "R", "fields": [{"name": "s", "type": "string"}]}
    texts = ["x" * (i % 30) for i in range(200)]
    assert decode(schema, [long(len(t)) + t.encode() for t in texts], "s") == ([texts], [False] * 200)


def test_sliced_batches():
    schema = {"type": "record", "name": "R", "fields": [{"name": "s", "type": "string"}]}
    payload = pa.array([b"\x02a", b"\x02b", None, b"\x02c"], pa.binary()).slice(1)
    slot = slots_for(parse(json.dumps(schema)), ("s",))
    arrays, failed = decode_batch(payload, pa.nulls(3, pa.int64()), one_schema(schema), slot)
    assert arrays[0].to_pylist() == ["b", None, "c"]
    assert not np.any(failed)


def test_schemas_of_one_shape_share_a_tree():
    def text(name, field="x", kind="string"):
        return json.dumps({"type": "record", "name": name, "doc": name, "fields": [
            {"name": field, "type": kind, "default": None}, {"name": "e", "type": {"type": "enum", "name": "E" + name, "symbols": ["A"]}}]})

    texts = {1: text("P"), 2: text("Q"), 3: text("R", field="y"), 4: text("S", kind="bytes"), 5: "{"}
    schemas = Schemas(texts.__getitem__)
    assert schemas.tree(1) is schemas.tree(2)
    assert len({id(schemas.tree(k)) for k in (1, 3, 4)}) == 3
    assert schemas.tree(5) is None


@SLOW
@given(cases(), cases())
def test_shape_tells_schemas_apart(one, other):
    same = plain_names(one[0]) == plain_names(other[0])
    assert same == (shape(parse(json.dumps(one[0]))) == shape(parse(json.dumps(other[0]))))


def plain_names(schema):
    """The schema without the names of its types."""
    if isinstance(schema, list):
        return [plain_names(s) for s in schema]
    if isinstance(schema, dict):
        kept = {k: plain_names(v) for k, v in schema.items() if k != "name" or "type" not in schema}
        if schema.get("type") == "record":
            kept["fields"] = [(f["name"], plain_names(f["type"])) for f in schema["fields"]]
        return kept
    return schema


LOGICAL = {
    "type": "record",
    "name": "L",
    "fields": [
        {"name": "d", "type": {"type": "int", "logicalType": "date"}},
        {"name": "ms", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "us", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "lms", "type": {"type": "long", "logicalType": "local-timestamp-millis"}},
        {"name": "lus", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
        {"name": "dec", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
        {"name": "fdec", "type": {"type": "fixed", "name": "D", "size": 5, "logicalType": "decimal", "precision": 10, "scale": 0}},
        {"name": "u", "type": {"type": "string", "logicalType": "uuid"}},
        {"name": "odd", "type": {"type": "int", "logicalType": "no-such-type"}},
    ],
}


def test_logical_types():
    row = {
        "d": 19723, "ms": 1704067200123, "us": 1704067200123456, "lms": -1, "lus": -1,
        "dec": (-12345).to_bytes(3, "big", signed=True), "fdec": (7).to_bytes(5, "big"),
        "u": "6f0c", "odd": 3,
    }
    found, failed, _ = read_all(LOGICAL, [encode(LOGICAL, row)])
    assert not failed.any()
    got = found[0]
    assert str(got["d"]) == "2024-01-01"
    assert str(got["ms"]).startswith("2024-01-01 00:00:00.123")
    assert str(got["us"]).startswith("2024-01-01 00:00:00.123456")
    assert str(got["lms"]) == "1969-12-31 23:59:59.999000"
    assert str(got["lus"]) == "1969-12-31 23:59:59.999999"
    assert str(got["dec"]) == "-123.45" and str(got["fdec"]) == "7"
    assert got["u"] == "6f0c" and got["odd"] == 3


def test_decimal_beyond_its_precision_fails():
    schema = {"type": "record", "name": "R", "fields": [
        {"name": "d", "type": {"type": "bytes", "logicalType": "decimal", "precision": 2, "scale": 0}}]}
    assert decode(schema, [long(1) + b"\x63", long(1) + b"\x64"], "d")[1] == [False, True]


@SLOW
@given(
    st.lists(st.tuples(st.integers(-(10**40), 10**40), st.integers(0, 3)), min_size=1, max_size=20),
    st.integers(1, 38),
    st.booleans(),
)
def test_decimals(numbers, precision, fixed):
    """Numbers of every width, padded with sign bytes or not."""
    kind = {"type": "bytes", "logicalType": "decimal", "precision": precision, "scale": 0}
    if fixed:
        kind |= {"type": "fixed", "name": "F", "size": 20}
    schema = {"type": "record", "name": "R", "fields": [{"name": "d", "type": kind}]}
    bodies = []
    for number, padding in numbers:
        size = 20 if fixed else (number.bit_length() + 8) // 8 + padding * 6
        raw = number.to_bytes(size, "big", signed=True)
        bodies.append(raw if fixed else long(size) + raw)
    found, failed = decode(schema, bodies, "d")
    fits = [abs(n) < 10**precision for n, _ in numbers]
    assert failed == [not f for f in fits]
    assert [int(v) for v, f in zip(found[0], fits) if f] == [n for (n, _), f in zip(numbers, fits) if f]


def test_decimal_of_no_bytes_is_zero():
    kind = {"type": "bytes", "logicalType": "decimal", "precision": 5, "scale": 2}
    schema = {"type": "record", "name": "R", "fields": [{"name": "d", "type": kind}]}
    found, failed = decode(schema, [long(0)], "d")
    assert (str(found[0][0]), failed) == ("0.00", [False])
