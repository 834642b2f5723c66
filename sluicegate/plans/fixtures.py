"""Kafka-shaped messages computed from the ``events`` table (see FIXTURES.md)."""

import json

import pandas as pd
from pyspark.sql import functions as F

from sluicegate.operators.schemas import SCHEMA_COLUMNS

SCHEMA_NAMES = ["subject", "version", "schema_id", "schema_json"]

SUBJECT = "raw-input-value"
UNKNOWN_ID = 4294967294

# The fixture's schemas and rules, as listed in FIXTURES.md.
SCHEMA_7 = json.dumps(
    {
        "type": "record",
        "name": "Event",
        "fields": [
            {"name": "event_type", "type": "string"},
            {"name": "phone", "type": ["null", "string"]},
        ],
    },
    separators=(",", ":"),
)
SCHEMA_8 = json.dumps(
    {
        "type": "record",
        "name": "Event",
        "fields": [
            {"name": "phone", "type": "string"},
            {"name": "event_type", "type": "string"},
        ],
    },
    separators=(",", ":"),
)
RULES = (
    (r"^\+7\d{10}$", "ru"),
    (r"^\+380\d{9}$", "ua"),
    (r".*", "rest"),
)


def schemas_table(spark):
    rows = [(SUBJECT, 1, 7, SCHEMA_7), (SUBJECT, 2, 8, SCHEMA_8)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=SCHEMA_NAMES), SCHEMA_COLUMNS)


def rules_table(spark, rules=RULES):
    rows = [(i + 1, p, b) for i, (p, b) in enumerate(rules)]
    return spark.createDataFrame(rows, "ord int, pattern string, bucket string")


def avro_text(text):
    """Avro encoding of an ASCII text shorter than 64 bytes: its length fits one byte."""
    size = F.unhex(F.lpad(F.hex(2 * F.length(text)), 2, "0"))
    return F.concat(size, F.encode(text, "UTF-8"))


# The messages, step by step: digits that pick phone and shape, the phone, the Avro
# encodings of both texts, the two bodies, and the value with or without a frame.
MESSAGE_STEPS = (
    """*, cast(user_id as string) as user, event_id % 10 as k,
    (event_id div 10) % 10 as s, (event_id div 100) % 10 as t""",
    """*, case k
        when 2 then concat('+380', lpad(user, 9, '0'))
        when 3 then concat('8', lpad(user, 10, '0'))
        when 4 then ''
        when 5 then null
        when 6 then concat('+7', lpad(user, 9, '0'))
        when 7 then concat('x+7', lpad(user, 10, '0'))
        when 8 then concat('+7', lpad(user, 10, '0'), ' ')
        else concat('+7', lpad(user, 10, '0')) end as phone""",
    "* except (phone), if(s = 3, coalesce(phone, ''), phone) as phone",
    """*, concat(unhex(lpad(hex(2 * length(event_type)), 2, '0')), encode(event_type, 'UTF-8'))
        as av_type,
    concat(unhex(lpad(hex(2 * length(phone)), 2, '0')), encode(phone, 'UTF-8')) as av_phone""",
    """*, if(phone is null, concat(av_type, X'00'), concat(av_type, X'02', av_phone)) as body7,
    concat(av_phone, av_type) as body8""",
    """encode(user, 'UTF-8') as key,
    case when s in (0, 1, 2) then concat(X'0000000007', body7)
        when s = 3 then concat(X'0000000008', body8)
        when s = 4 and t = 9 then X'000000000710616263'
        when s = 4 then concat(X'0000000007', body7)
        when s = 5 then body7
        when s = 6 then null
        when s = 7 then X''
        when s = 8 then X'0000'
        else concat(X'00FFFFFFFE', body7) end as value,
    array(struct('trace' as key, encode(cast(event_id as string), 'UTF-8') as value)) as headers,
    if(event_id % 2 = 0, 'raw-a', 'raw-b') as topic,
    0 as partition,
    event_id as offset,
    cast(ts as timestamp) as timestamp,
    0 as timestampType""",
)


def raw_messages(events):
    """One message per event, batch or streaming: a projection, nothing else."""
    query = "{events}"
    for step in MESSAGE_STEPS:
        query = f"(select {step} from {query})"
    return events.sparkSession.sql(f"select * from {query}", events=events)


def varint(number, size):
    """Avro encoding of a non-negative whole number in exactly ``size`` bytes (7 bits each)."""
    zigzag = F.shiftleft(number.cast("bigint"), 1)
    digits = F.lit(0).cast("bigint")
    for i in range(size):
        byte = F.shiftright(zigzag, 7 * i).bitwiseAND(F.lit(0x7F))
        byte = byte.bitwiseOR(F.lit(0x80)) if i < size - 1 else byte
        digits = digits.bitwiseOR(F.shiftleft(byte.cast("bigint"), 8 * (size - 1 - i)))
    return F.unhex(F.lpad(F.hex(digits), 2 * size, "0"))


def framed(schema_id, body):
    return F.concat(F.lit(b"\x00"), F.unhex(F.lpad(F.hex(schema_id), 8, "0")), body)


def as_messages(events, value):
    """Messages without headers around a value column."""
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
        F.lit("typed").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )


# One record with every kind of Avro type.
TYPED_ID = 9
COLOURS = ("red", "green", "blue")
TYPED_SCHEMA = json.dumps(
    {
        "type": "record",
        "name": "Typed",
        "fields": [
            {"name": "nothing", "type": "null"},
            {"name": "user", "type": "int"},
            {"name": "flag", "type": "boolean"},
            {"name": "ratio", "type": "float"},
            {
                "name": "amount",
                "type": {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 2},
            },
            {"name": "ts", "type": {"type": "long", "logicalType": "timestamp-micros"}},
            {"name": "day", "type": {"type": "int", "logicalType": "date"}},
            {"name": "tags", "type": {"type": "array", "items": "string"}},
            {"name": "numbers", "type": {"type": "array", "items": "long"}},
            {"name": "attrs", "type": {"type": "map", "values": "long"}},
            {
                "name": "inner",
                "type": [
                    "null",
                    {
                        "type": "record",
                        "name": "Inner",
                        "fields": [{"name": "name", "type": "string"}],
                    },
                ],
            },
            {"name": "colour", "type": {"type": "enum", "name": "Colour", "symbols": COLOURS}},
            {"name": "mark", "type": {"type": "fixed", "name": "Mark", "size": 2}},
            {"name": "blob", "type": "bytes"},
            {"name": "either", "type": ["null", "string", "boolean"]},
        ],
    }
)


def typed_schemas(spark):
    rows = [("typed-value", 1, TYPED_ID, TYPED_SCHEMA)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=SCHEMA_NAMES), SCHEMA_COLUMNS)


def typed_messages(events):
    """One message of the typed record per event."""
    event, user = F.col("event_id"), F.col("user_id")
    text, digit = avro_text(F.col("event_type")), event % 10
    cents = F.round(F.col("value") * 100).cast("bigint")
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    pair_size = F.unhex(F.lpad(F.hex(4 * (1 + F.length("event_type"))), 2, "0"))
    tags = (
        F.when(event % 3 == 0, F.lit(b"\x00"))
        .when(event % 3 == 1, F.concat(F.lit(b"\x02"), text, F.lit(b"\x00")))
        .otherwise(F.concat(F.lit(b"\x03"), pair_size, text, text, F.lit(b"\x00")))
    )
    body = F.concat(
        varint(user, 5),
        F.when(event % 2 == 1, F.lit(b"\x01")).otherwise(F.lit(b"\x00")),
        F.when(event % 2 == 1, F.lit(b"\x00\x00\xc0\x3f")).otherwise(F.lit(b"\x00\x00\x20\xc0")),
        F.lit(b"\x10"),
        F.unhex(F.lpad(F.hex(cents), 16, "0")),
        varint(micros, 8),
        varint(F.unix_date(F.col("ts").cast("date")), 3),
        tags,
        F.lit(b"\x04"),
        varint(user, 5),
        varint(digit, 1),
        F.lit(b"\x00"),
        F.lit(b"\x04\x02k"),
        varint(digit, 2),
        F.lit(b"\x02u"),
        varint(user, 5),
        F.lit(b"\x00"),
        F.when(digit == 0, F.lit(b"\x00")).otherwise(F.concat(F.lit(b"\x02"), text)),
        varint(event % 3, 1),
        F.lit(b"\xab\xcd"),
        text,
        F.when(digit == 1, F.lit(b"\x00"))
        .when(event % 2 == 0, F.concat(F.lit(b"\x02"), text))
        .otherwise(F.lit(b"\x04\x01")),
    )
    return as_messages(events, framed(F.lit(TYPED_ID), body))


def user_schemas(events):
    """A schema per user: the phone is text for even users and a boolean for odd ones."""
    field = F.when(F.col("user_id") % 2 == 0, "string").otherwise("boolean")
    head = (
        '{"type":"record","name":"Event","fields":'
        '[{"name":"event_type","type":"string"},{"name":"phone","type":"'
    )
    return (
        events.select("user_id")
        .distinct()
        .select(
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("subject"),
            F.lit(1).alias("version"),
            (F.col("user_id") + 1000).alias("schema_id"),
            F.concat(F.lit(head), field, F.lit('"}]}')).alias("schema_json"),
        )
    )


def user_messages(events):
    """One message per event, framed with the schema of its user."""
    user = F.col("user_id")
    phone = F.when(user % 2 == 0, avro_text(user.cast("string"))).otherwise(F.lit(b"\x01"))
    body = F.concat(avro_text(F.col("event_type")), phone)
    return as_messages(events, framed(user + 1000, body))
