"""Settings of a router job."""

import json
import os
from dataclasses import dataclass, fields, replace

WIRE = ("strict", "lenient")
MATCH = ("first", "last")
SCHEMA_MODE = ("message", "reader")
NULL_FIELD = ("empty", "default")
ERROR_STYLE = ("code", "message", "reader")

CATCH_ALL = ".*"

# The rules a router starts with if none are given.
DEFAULT_RULES = ((r"^\+7\d{10}$", "ru"), (CATCH_ALL, "rest"))


@dataclass(frozen=True)
class RouterConfig:
    """How messages are split, decoded, matched and labelled.

    ``wire``         a zero byte followed by fewer than four more is an error (strict) or
                     the start of an un-framed body (lenient)
    ``schema_mode``  decode with the schema each message names, or all with one reader schema
    ``match``        the first or the last matching rule wins
    ``anchored``     rules match at the start of the text instead of anywhere in it
    ``null_field``   an absent routing field is matched as empty text, or goes straight to
                     the bucket of the catch-all rule
    ``error_style``  error codes, or the texts of the per-message or reader-schema router

    ``max_broadcast_bytes``, ``max_broadcast_schemas``: schemas up to this size are broadcast.
    ``max_copied_bytes``: larger ones are copied for salted joins up to this size in all.
    ``max_field_types``: the job stops if the routing field has more types than this in all schemas.
    ``hold_seconds``: how long messages with an unknown schema id wait for it; 0: they are errors at once.
    ``keep_batches``: keep a micro-batch for its second sink instead of reading it again.
    """

    route_field: str = "phone"
    topic_prefix: str = "route"
    errors_topic: str = "errors"
    input_topics: tuple = ("raw-input",)
    wire: str = "strict"
    schema_mode: str = "message"
    match: str = "first"
    anchored: bool = False
    null_field: str = "empty"
    error_style: str = "code"
    default_schema: str = ""
    reader_schema: str = ""
    reader_schema_file: str = ""
    subject: str = "raw-input-value"
    bootstrap: str = "kafka:9092"
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False  # whether offsets that are gone stop the query
    acks: str = "all"
    max_request_size: int = 10485760
    min_partitions: int = 0
    max_records_per_partition: int = 0
    max_offsets_per_trigger: int = 0
    checkpoint: str = ""
    max_broadcast_bytes: int = 16 << 20
    max_broadcast_schemas: int = 20_000
    max_copied_bytes: int = 8 << 30
    max_field_types: int = 1000
    keep_batches: bool = False
    hold_seconds: int = 0

    def __post_init__(self):
        for name, allowed in (
            ("wire", WIRE),
            ("schema_mode", SCHEMA_MODE),
            ("match", MATCH),
            ("null_field", NULL_FIELD),
            ("error_style", ERROR_STYLE),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")
        if not self.route_field:
            raise ValueError("route_field is empty")
        for name in ("default_schema", "reader_schema"):
            check_json(name, getattr(self, name))

    @classmethod
    def per_message(cls, **settings):
        """The router that looks up a schema per message, as that variant behaves."""
        return replace(
            cls(anchored=True, null_field="default", error_style="message"), **settings
        )

    @classmethod
    def one_schema(cls, **settings):
        """The router with one reader schema, as that variant behaves: its last rule wins."""
        return replace(
            cls(wire="lenient", schema_mode="reader", match="last", error_style="reader"),
            **settings,
        )

    @classmethod
    def from_env(cls, base=None, env=os.environ):
        """``base`` with the environment variables that are set and not empty."""
        base = base or cls()
        types = {f.name: f.type for f in fields(cls)}
        given = {}
        for variable, name in ENVIRONMENT.items():
            if env.get(variable):
                text = env[variable]
                given[name] = READ[types[name]](text)
        return replace(base, **given)


# The environment variables of the router scripts and the setting of each.
ENVIRONMENT = {
    "KAFKA_BOOTSTRAP": "bootstrap",
    "INPUT_TOPICS": "input_topics",
    "ERRORS_TOPIC": "errors_topic",
    "ROUTE_TOPIC_PREFIX": "topic_prefix",
    "DEFAULT_SCHEMA_STR": "default_schema",
    "SCHEMA_SUBJECT": "subject",
    "READER_SCHEMA_STR": "reader_schema",
    "READER_SCHEMA_FILE": "reader_schema_file",
    "PHONE_FIELD": "route_field",
    "CHECKPOINT_LOCATION": "checkpoint",
    "STARTING_OFFSETS": "starting_offsets",
    "OUTPUT_KAFKA_ACKS": "acks",
}

# Environment variables for the size of reads, which the scripts leave to Spark's defaults.
ENVIRONMENT |= {
    "MIN_PARTITIONS": "min_partitions",
    "MAX_RECORDS_PER_PARTITION": "max_records_per_partition",
    "MAX_OFFSETS_PER_TRIGGER": "max_offsets_per_trigger",
    "FAIL_ON_DATA_LOSS": "fail_on_data_loss",
    "MAX_BROADCAST_BYTES": "max_broadcast_bytes",
    "MAX_BROADCAST_SCHEMAS": "max_broadcast_schemas",
    "MAX_COPIED_BYTES": "max_copied_bytes",
    "MAX_FIELD_TYPES": "max_field_types",
    "KEEP_BATCHES": "keep_batches",
    "HOLD_UNKNOWN_SECONDS": "hold_seconds",
}

# How a setting of each type is read from a text.
READ = {
    str: str,
    int: int,
    tuple: lambda text: tuple(text.split(",")),
    bool: lambda text: text.strip().lower() == "true",
}


def check_json(name, text):
    """A schema given as text must be JSON before the job starts."""
    if text and text.strip():
        try:
            json.loads(text)
        except ValueError as e:
            raise ValueError(f"{name} is not JSON: {e}") from None
