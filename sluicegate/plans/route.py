"""The whole path of a message, as one DataFrame for batch and streaming alike."""

from sluicegate.config import RouterConfig
from sluicegate.operators.classify import classify, to_output
from sluicegate.operators.decode import decode, decode_with
from sluicegate.operators.rules import Rules, apply_rules
from sluicegate.operators.schemas import Registry, resolve_schema
from sluicegate.operators.wire import split_wire

CONTENT = ("key", "value", "headers")


def route(messages, schemas, rules, config=RouterConfig()):
    """Decide the topic of every message: exactly one output row per input row.

    ``messages`` has the Kafka source columns, ``schemas`` the schema table (or a loaded
    :class:`Registry`) and ``rules`` anything :meth:`Rules.of` takes.  Each message is
    decoded once, and nothing is shuffled unless the schemas in use are too large to
    broadcast.  Input columns are kept, the input's topic as ``source_topic``."""
    rules = Rules.of(rules).check(messages.sparkSession)
    split = split_wire(messages, config.wire)
    fields = {"route_value": config.route_field}
    if config.schema_mode == "reader":
        _, schema = resolve_schema(messages.sparkSession, schemas, config)
        decoded = decode_with(split, fields, schema)
    else:
        limits = config.max_broadcast_bytes, config.max_broadcast_schemas, config.max_copied_bytes
        registry = Registry.load(schemas, *limits)
        decoded = decode(split, fields, registry, config.default_schema, config.max_field_types)
    keep = [c for c in messages.columns if c not in CONTENT]
    classified = classify(apply_rules(decoded, rules, config), config)
    return to_output(classified, config, [*keep, "schema_id", "route_value"])
