"""Types and bytes against the Avro library that ships with Spark."""

import json

import pytest
from avro_encode import encode, records, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from test_avro_batch import LOGICAL, unique_names

from sluicegate.functions.avro_types import parse, spark_type

WIDE = {
    "type": "record", "name": "W", "namespace": "a.b",
    "fields": [
        {"name": "z", "type": "null"},
        {"name": "b", "type": "boolean"}, {"name": "i", "type": "int"}, {"name": "l", "type": "long"},
        {"name": "f", "type": "float"}, {"name": "d", "type": "double"},
        {"name": "y", "type": "bytes"}, {"name": "s", "type": "string"},
        {"name": "x", "type": {"type": "fixed", "name": "X", "size": 3}},
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}},
        {"name": "arr", "type": {"type": "array", "items": ["null", "long"]}},
        {"name": "m", "type": {"type": "map", "values": "X"}},
        {"name": "il", "type": ["int", "long"]}, {"name": "fd", "type": ["null", "float", "double"]},
        {"name": "u", "type": ["null", "string", "a.b.E", {"type": "record", "name": "In", "fields": [{"name": "q", "type": "E"}]}]},
        {"name": "again", "type": "In"},
    ],
}


def nullable(found):
    """A type with every field and element nullable, as ours are."""
    if isinstance(found, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in found])
    if isinstance(found, T.ArrayType):
        return T.ArrayType(nullable(found.elementType))
    if isinstance(found, T.MapType):
        return T.MapType(T.StringType(), nullable(found.valueType))
    return found


@pytest.mark.parametrize("schema", [WIDE, LOGICAL], ids=["wide", "logical"])
def test_spark_types_are_sparks_own(spark, schema):
    jvm = spark._jvm
    java = jvm.org.apache.avro.Schema.Parser().parse(json.dumps(schema))
    converted = jvm.org.apache.spark.sql.avro.SchemaConverters.toSqlType(java)
    expected = T.StructType.fromJson(json.loads(converted.dataType().json()))
    assert spark_type(parse(json.dumps(schema))) == nullable(expected)


def recoded(jvm, schema, body):
    """Read with the Avro library, write again with it."""
    java = jvm.org.apache.avro.Schema.Parser().parse(json.dumps(schema))
    decoder = jvm.org.apache.avro.io.DecoderFactory.get().binaryDecoder(bytearray(body), None)
    record = jvm.org.apache.avro.generic.GenericDatumReader(java).read(None, decoder)
    assert decoder.isEnd()
    out = jvm.java.io.ByteArrayOutputStream()
    encoder = jvm.org.apache.avro.io.EncoderFactory.get().binaryEncoder(out, None)
    jvm.org.apache.avro.generic.GenericDatumWriter(java).write(record, encoder)
    encoder.flush()
    return bytes(out.toByteArray())


def has_map(schema):
    return '"map"' in json.dumps(schema)


@settings(max_examples=40, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_test_encoder_writes_what_the_avro_library_writes(spark, data):
    schema = unique_names(data.draw(records()))
    body = encode(schema, data.draw(values(schema)))
    again = recoded(spark._jvm, schema, body)
    assert len(again) == len(body) if has_map(schema) else again == body
