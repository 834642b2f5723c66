"""Avro encoder and random schemas for tests only."""

import struct

from hypothesis import strategies as st


def long(n):
    z = (n << 1) ^ (n >> 63)
    out = bytearray()
    while z > 0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    out.append(z)
    return bytes(out)


def encode(schema, value, sized=False):
    """Bytes of a value; a union value is ``(branch, value)``.  ``sized`` writes arrays and
    maps as blocks of one element with a negative count and a byte size."""
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, list):
        branch, inner = value
        return long(branch) + encode(kind[branch], inner, sized)
    if isinstance(kind, dict):
        return encode(kind, value, sized)
    if kind == "null":
        return b""
    if kind == "boolean":
        return bytes([value])
    if kind in ("int", "long"):
        return long(value)
    if kind == "float":
        return struct.pack("<f", value)
    if kind == "double":
        return struct.pack("<d", value)
    if kind == "bytes":
        return long(len(value)) + value
    if kind == "string":
        return encode("bytes", value.encode())
    if kind == "fixed":
        return value
    if kind == "enum":
        return long(schema["symbols"].index(value))
    if kind == "record":
        return b"".join(encode(f["type"], value[f["name"]], sized) for f in schema["fields"])
    if kind == "array":
        items = [encode(schema["items"], v, sized) for v in value]
    else:
        items = [encode("string", k) + encode(schema["values"], v, sized) for k, v in value.items()]
    if sized:
        return b"".join(long(-1) + long(len(i)) + i for i in items) + long(0)
    return (long(len(items)) if items else b"") + b"".join(items) + long(0)


def plain(schema, value):
    """The value as Arrow's ``to_pylist`` shows it."""
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, list):
        branch, inner = value
        inner = plain(kind[branch], inner)
        members = [m for m in kind if m != "null"]
        if kind[branch] == "null":
            return None
        kinds = {m if isinstance(m, str) else m["type"] for m in members}
        if len(members) == 1 or kinds in ({"int", "long"}, {"float", "double"}):
            return inner
        at = members.index(kind[branch])
        return {f"member{i}": inner if i == at else None for i in range(len(members))}
    if isinstance(kind, dict):
        return plain(kind, value)
    if kind == "record":
        return {f["name"]: plain(f["type"], value[f["name"]]) for f in schema["fields"]}
    if kind == "array":
        return [plain(schema["items"], v) for v in value]
    if kind == "map":
        return [(k, plain(schema["values"], v)) for k, v in value.items()]
    return value


NAMES = st.integers(0, 10**9)
TEXTS = st.text(max_size=12)

PRIMITIVE_VALUES = {
    "null": st.none(),
    "boolean": st.booleans(),
    "int": st.integers(-(2**31), 2**31 - 1),
    "long": st.integers(-(2**63), 2**63 - 1),
    "float": st.floats(width=32, allow_nan=False),
    "double": st.floats(allow_nan=False),
    "bytes": st.binary(max_size=12),
    "string": TEXTS,
}


@st.composite
def schemas(draw, depth=2):
    kinds = list(PRIMITIVE_VALUES) + ["fixed", "enum"]
    if depth:
        kinds += ["record", "array", "map", "union"] * 2
    kind = draw(st.sampled_from(kinds))
    if kind == "fixed":
        return {"type": "fixed", "name": f"F{draw(NAMES)}x{id(draw)}", "size": draw(st.integers(1, 9))}
    if kind == "enum":
        return {"type": "enum", "name": f"E{draw(NAMES)}x{id(draw)}", "symbols": ["A", "B", "C"]}
    if kind == "array":
        return {"type": "array", "items": draw(schemas(depth=depth - 1))}
    if kind == "map":
        return {"type": "map", "values": draw(schemas(depth=depth - 1))}
    if kind == "record":
        return draw(records(depth=depth - 1))
    if kind == "union":
        members = draw(
            st.lists(st.sampled_from(list(PRIMITIVE_VALUES)), min_size=1, max_size=4, unique=True)
        )
        return members
    return kind


@st.composite
def records(draw, depth=2):
    children = draw(st.lists(schemas(depth=depth), min_size=1, max_size=4))
    fields = [{"name": f"f{i}", "type": c} for i, c in enumerate(children)]
    return {"type": "record", "name": f"R{draw(NAMES)}x{id(draw)}", "fields": fields}


def values(schema):
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, list):
        return st.integers(0, len(kind) - 1).flatmap(
            lambda b: values(kind[b]).map(lambda v: (b, v))
        )
    if isinstance(kind, dict):
        return values(kind)
    if kind in PRIMITIVE_VALUES:
        return PRIMITIVE_VALUES[kind]
    if kind == "fixed":
        return st.binary(min_size=schema["size"], max_size=schema["size"])
    if kind == "enum":
        return st.sampled_from(schema["symbols"])
    if kind == "array":
        return st.lists(values(schema["items"]), max_size=4)
    if kind == "map":
        return st.dictionaries(TEXTS, values(schema["values"]), max_size=3)
    return st.fixed_dictionaries({f["name"]: values(f["type"]) for f in schema["fields"]})
