"""Avro schemas as Spark types.

An Avro schema (JSON text) becomes a tree of :class:`Node`.  The tree answers two
plan-time questions: which Spark type a value has, and where in the record a dotted
path ends.  Reading bytes is the job of :mod:`sluicegate.functions.avro_batch`.
"""

import json
from dataclasses import dataclass, field

from pyspark.sql import types as T

# The Avro primitive types and the Spark type of each.
PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}

# Logical types that change the Spark type, by (Avro type, logical type).
LOGICAL = {
    ("int", "date"): T.DateType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("long", "local-timestamp-millis"): T.TimestampNTZType(),
    ("long", "local-timestamp-micros"): T.TimestampNTZType(),
}

# Encoded size in bytes where it does not depend on the value.
FIXED_SIZES = {"null": 0, "boolean": 1, "float": 4, "double": 8}


@dataclass(eq=False)
class Node:
    """One type of an Avro schema; recursive schemas make the tree a graph."""

    kind: str
    name: str = ""
    logical: str = ""
    fields: list = field(default_factory=list)  # record: (name, Node)
    members: list = field(default_factory=list)  # union
    item: "Node | None" = None  # array, map
    symbols: list = field(default_factory=list)  # enum
    size: int = 0  # fixed
    precision: int = 0  # decimal
    scale: int = 0

    @property
    def is_decimal(self):
        return self.logical == "decimal"


def parse(text):
    """Avro JSON text -> root :class:`Node`; raises ``ValueError`` if it is not a schema."""
    return _node(json.loads(text), "", {})


def parse_or_none(text):
    """The same, with ``None`` for text that is not a schema."""
    try:
        return parse(text)
    except (ValueError, KeyError, TypeError, AttributeError, RecursionError):
        return None


def _fullname(name, namespace):
    return name if "." in name or not namespace else f"{namespace}.{name}"


def _node(spec, namespace, named):
    if isinstance(spec, str):
        if spec in PRIMITIVES:
            return Node(spec)
        full = _fullname(spec, namespace)
        if full not in named:
            raise ValueError(f"unknown Avro type: {spec}")
        return named[full]
    if isinstance(spec, list):
        return Node("union", members=[_node(s, namespace, named) for s in spec])
    if not isinstance(spec, dict) or "type" not in spec:
        raise ValueError(f"not an Avro schema: {spec!r}")

    kind = spec["type"]
    if kind in ("record", "error", "enum", "fixed"):
        full = _fullname(spec["name"], spec.get("namespace", namespace))
        inner = full.rpartition(".")[0]
        node = named[full] = Node("record" if kind == "error" else kind, name=full)
        if kind == "enum":
            node.symbols = list(spec["symbols"])
        elif kind == "fixed":
            node.size = int(spec["size"])
            _set_logical(node, spec)
        else:
            node.fields = [(f["name"], _node(f["type"], inner, named)) for f in spec["fields"]]
        return node
    if kind == "array":
        return Node("array", item=_node(spec["items"], namespace, named))
    if kind == "map":
        return Node("map", item=_node(spec["values"], namespace, named))
    if isinstance(kind, str) and kind in PRIMITIVES:
        return _set_logical(Node(kind), spec)
    return _node(kind, namespace, named)


def _set_logical(node, spec):
    logical = spec.get("logicalType", "")
    if (node.kind, logical) in LOGICAL:
        node.logical = logical
    elif logical == "decimal" and node.kind in ("bytes", "fixed"):
        precision, scale = int(spec.get("precision", 0)), int(spec.get("scale", 0))
        if 0 < precision <= 38 and 0 <= scale <= precision:
            node.logical, node.precision, node.scale = logical, precision, scale
    return node


def shape(node, seen=None):
    """Text equal for schemas that read alike, whatever their types are called."""
    seen = {} if seen is None else seen
    if node in seen:
        return f"#{seen[node]}"
    if node.kind == "record":
        seen[node] = len(seen)
        parts = [f"{name}:{shape(child, seen)}" for name, child in node.fields]
    elif node.item:
        parts = [shape(node.item, seen)]
    else:
        parts = [shape(m, seen) for m in node.members] or node.symbols
    extra = (node.logical, node.precision, node.scale, node.size)
    return f"{node.kind}{extra if any(extra) else ''}({','.join(parts)})"


def fixed_size(node, inside=()):
    """Encoded size in bytes if every value has the same one, else ``None``.

    A type without a fixed size always takes at least one byte."""
    if node.kind in FIXED_SIZES:
        return FIXED_SIZES[node.kind]
    if node.kind == "fixed":
        return node.size
    if node.kind != "record" or node in inside:
        return None
    sizes = [fixed_size(child, inside + (node,)) for _, child in node.fields]
    return None if None in sizes else sum(sizes)


def union_shape(node):
    """``(kind, members)`` of a union: null, one type, a widened number, or a struct."""
    members = [m for m in node.members if m.kind != "null"]
    kinds = {m.kind for m in members}
    if not members:
        return "null", members
    if len(members) == 1:
        return "single", members
    if len(members) == 2 and not any(m.logical for m in members):
        if kinds == {"int", "long"}:
            return "long", members
        if kinds == {"float", "double"}:
            return "double", members
    return "struct", members


def spark_type(node, inside=()):
    """Spark type of a value of this schema; a recursive schema has none."""
    if node in inside:
        raise ValueError(f"recursive Avro type: {node.name}")
    deeper = inside + (node,)
    if node.is_decimal:
        return T.DecimalType(node.precision, node.scale)
    if node.logical:
        return LOGICAL[node.kind, node.logical]
    if node.kind in PRIMITIVES:
        return PRIMITIVES[node.kind]
    if node.kind == "enum":
        return T.StringType()
    if node.kind == "fixed":
        return T.BinaryType()
    if node.kind == "array":
        return T.ArrayType(spark_type(node.item, deeper))
    if node.kind == "map":
        return T.MapType(T.StringType(), spark_type(node.item, deeper))
    if node.kind == "record":
        return T.StructType([T.StructField(n, spark_type(c, deeper)) for n, c in node.fields])
    shape, members = union_shape(node)
    if shape == "single":
        return spark_type(members[0], deeper)
    if shape == "struct":
        return T.StructType(
            [T.StructField(f"member{i}", spark_type(m, deeper)) for i, m in enumerate(members)]
        )
    return {"null": T.NullType(), "long": T.LongType(), "double": T.DoubleType()}[shape]


def type_or_none(node):
    try:
        return spark_type(node)
    except ValueError:
        return None


@dataclass(frozen=True)
class Slot:
    """One value to take from a record: the record fields to walk, the Spark type found
    there, and the rest of the path, which Spark itself applies to that value."""

    walk: tuple
    type: T.DataType
    rest: tuple = ()

    def to_json(self):
        return json.dumps([self.walk, self.type.jsonValue(), self.rest])

    @classmethod
    def from_json(cls, text):
        walk, found, rest = json.loads(text)
        wrapped = T.StructType.fromJson({"fields": [_as_field(found)]})
        return cls(tuple(walk), wrapped[0].dataType, tuple(rest))


def _as_field(found):
    return {"name": "v", "type": found, "nullable": True, "metadata": {}}


def slots_for(node, path, wanted=None, walked=()):
    """Every :class:`Slot` at which ``path`` can end in this schema.

    A union contributes one slot per member type, so a field that is text in one schema
    and a number in another keeps both types until Spark casts them; only where its own
    struct type is the ``wanted`` one is it taken whole."""
    if node.kind == "union":
        if not path and wanted is not None and wanted == struct_of_union(node):
            return [Slot(walked, wanted)]
        found = []
        for member in node.members:
            found += [s for s in slots_for(member, path, wanted, walked) if s not in found]
        return found
    if path and node.kind == "record":
        child = dict(node.fields).get(path[0])
        return slots_for(child, path[1:], wanted, walked + (path[0],)) if child else []
    if node.kind == "null" or (path and node.kind not in ("map", "array")):
        return []
    found = type_or_none(node)
    return [Slot(walked, found, tuple(path))] if behind(found, path) else []


def behind(found, path):
    """The type Spark finds by applying a path to a value of a type, ``None`` if it cannot."""
    for step in path:
        inside = found.elementType if isinstance(found, T.ArrayType) else found
        if isinstance(inside, T.StructType) and step in inside.names:
            field = inside[step].dataType
            found = T.ArrayType(field) if inside is not found else field
        elif isinstance(found, T.MapType):
            found = found.valueType
        else:
            return None
    return found


def struct_of_union(node):
    """The struct type of a union that has one, else ``None``."""
    return type_or_none(node) if union_shape(node)[0] == "struct" else None
