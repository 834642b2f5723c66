"""Avro decoding as a step on messages: one Arrow UDF, typed columns out."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.avro_types import (
    Slot,
    behind,
    parse,
    parse_or_none,
    slots_for,
    spark_type,
)
from sluicegate.functions.avro_udf import make_decoder, make_sorted_decoder, slot_describer
from sluicegate.functions.errors import (
    DECODE_FAILED,
    NO_DEFAULT_SCHEMA,
    UNKNOWN_SCHEMA,
)
from sluicegate.functions.wire import payload
from sluicegate.operators.schemas import attach_schema, sorted_in

MAX_TYPES = 1000  # distinct (field, type) pairs; each is a column of the decoder's result


def decode(messages, fields, registry, default_schema="", max_types=MAX_TYPES):
    """Decode split messages with the schema each one names.

    ``fields`` maps an output column to a dotted path, or to ``(path, type)``; the default
    type is string.  Un-framed messages use ``default_schema``.  Adds the output columns
    and ``decode_error``; a field the message's schema does not have is null.  Fields of more
    than ``max_types`` different types in all stop the job before any message is read."""
    registry = registry.in_use(messages)
    if registry.texts is None and not messages.isStreaming:
        return _decode_sorted(messages, fields, registry, default_schema, max_types)
    attached = attach_schema(messages, registry)
    framed = F.col("schema_id").isNotNull()
    error = F.when(framed & ~F.col("known"), UNKNOWN_SCHEMA)
    if not default_schema.strip():
        unframed = F.col("schema_id").isNull() & F.col("wire_error").isNull()
        error = error.when(unframed, NO_DEFAULT_SCHEMA)
    attached = attached.withColumn("schema_error", error)

    paths = _paths(fields)
    if registry.texts is None:
        key, schemas = F.col("schema_json"), None
        slots = _slots_of_table(registry.table, default_schema, paths, max_types)
    else:
        key, schemas = F.col("schema_id"), registry.texts
        slots = _slots([*registry.texts.values(), default_schema], paths, max_types)
    decoder = make_decoder([s for found in slots for s in found], schemas, default_schema)
    # Rows already in error take no bytes to Python.
    body = F.when(F.col("schema_error").isNull(), _body())
    return _with_fields(messages, attached, decoder(body, key), fields, slots)


def _decode_sorted(messages, fields, registry, default_schema, max_types):
    """Decode with a registry too large to broadcast: messages meet their schema in order, see
    ``sorted_in``, so no message carries the text.  A stream can't be put together with a table."""
    slots = _slots_of_table(registry.table, default_schema, _paths(fields), max_types)
    decoder = make_sorted_decoder([s for found in slots for s in found], default_schema)
    missing = F.lit(not default_schema.strip())
    unframed = F.col("schema_id").isNull() & F.col("wire_error").isNull()
    body = F.when(~(missing & unframed), _body())
    rows = sorted_in(messages, registry)
    decoded = rows.withColumn("decoded", decoder(body, "schema_id", "schema_json"))
    decoded = decoded.where(~F.col("decoded.schema")).drop("schema_json")
    error = F.when(~F.col("decoded.known"), UNKNOWN_SCHEMA)
    error = error.when(missing & unframed, NO_DEFAULT_SCHEMA)
    return _with_fields(messages, decoded.withColumn("schema_error", error), None, fields, slots)


def decode_with(messages, fields, schema):
    """Decode every split message with one reader schema, whatever schema id it names."""
    slots = _slots([schema], _paths(fields))
    decoder = make_decoder([s for found in slots for s in found], {}, schema)
    ready = messages.withColumn("schema_error", F.lit(None).cast("string"))
    call = decoder(_body(), F.lit(None).cast("bigint"))
    return _with_fields(messages, ready, call, fields, slots)


def record_fields(schema):
    """The fields of a record schema as a ``fields`` argument, each with its own type."""
    found = spark_type(parse(schema))
    if not isinstance(found, T.StructType):
        raise ValueError("the schema is not a record")
    return {f.name: (f.name, f.dataType) for f in found}


def as_record(fields):
    """Decoded fields together as one struct, null where nothing could be decoded."""
    readable = F.col("wire_error").isNull() & F.col("decode_error").isNull()
    return F.when(readable, F.struct(*fields))


def _body():
    """The payload, cut from the value only on its way to Python: as a column it would be
    a second copy of every message in the rows that wait for the decoder."""
    return payload(F.col("value"), F.col("schema_id"), F.col("wire_error"))


def _typed(fields):
    """``{alias: (path, Spark type)}`` of a ``fields`` argument."""
    pairs = {a: (p, "string") if isinstance(p, str) else p for a, p in fields.items()}
    return {
        a: (p, T.DataType.fromDDL(t) if isinstance(t, str) else t) for a, (p, t) in pairs.items()
    }


def _paths(fields):
    return [(tuple(path.split(".")), wanted) for path, wanted in _typed(fields).values()]


def _slots(texts, paths, max_types=MAX_TYPES):
    """The distinct slots of each path over all schemas; unreadable schemas have none."""
    roots = [root for root in map(parse_or_none, texts) if root]
    found = [
        dict.fromkeys(s for root in roots for s in slots_for(root, path, wanted))
        for path, wanted in paths
    ]
    return _bounded([sorted(slots, key=str) for slots in found], max_types)


def _bounded(found, max_types):
    if sum(map(len, found)) > max_types:
        raise ValueError(f"more than {max_types} types for the fields asked for")
    return found


def _slots_of_table(table, default_schema, paths, max_types):
    """The same for a schema table too large for the driver: executors describe their
    schemas and only the distinct slots come back, few however many schemas there are."""
    rows = (
        table.select("schema_json")
        .mapInArrow(slot_describer(paths), "path int, slot string")
        .distinct()
        .limit(max_types + 1)
        .collect()
    )
    found = [dict.fromkeys(slots) for slots in _slots([default_schema], paths, max_types)]
    for row in rows:
        found[row.path].setdefault(Slot.from_json(row.slot))
    return _bounded([sorted(slots, key=str) for slots in found], max_types)


def _castable(spark, found, wanted):
    """Whether Spark can try the cast at all; a field of a type that cannot is null."""
    try:
        spark.sql("select null as v").select(F.col("v").cast(found).try_cast(wanted))
    except AnalysisException:
        return False
    return True


def _with_fields(messages, ready, call, fields, slots):
    """Turn the decoder's result into the output columns and ``decode_error``."""
    if call is not None:
        ready = ready.withColumn("decoded", call)
    ok = ~F.col("decoded.failed")
    numbers = iter(range(sum(map(len, slots))))
    columns = []
    for (alias, (_, wanted)), found in zip(_typed(fields).items(), slots):
        values = []
        for slot in found:
            value = F.col(f"decoded.v{next(numbers)}")
            for step in slot.rest:
                value = value[step]
            reached = behind(slot.type, slot.rest)
            if reached == wanted:
                values.append(value)
            elif _castable(ready.sparkSession, reached, wanted):
                values.append(value.try_cast(wanted))
        value = F.coalesce(*values) if values else F.lit(None).cast(wanted)
        columns.append(F.when(ok, value).alias(alias))
    error = F.coalesce("schema_error", F.when(F.col("decoded.failed"), DECODE_FAILED))
    return ready.select(*messages.columns, *columns, error.alias("decode_error"))
