"""The schema-registry frame of a message value: ``00``, a 4-byte schema id, the body.

A value is framed iff it starts with a zero byte and holds a whole header.  Other values
are all payload, except that under the strict policy a zero byte without a whole header is
an error."""

from pyspark.sql import functions as F

from sluicegate.functions.errors import BAD_WIRE_HEADER, EMPTY_VALUE

HEADER = 5


def _zero_first(value):
    return F.substr(value, F.lit(1), F.lit(1)) == F.lit(b"\x00")


def wire_error(value, policy="strict"):
    """Why a value has no payload, else null."""
    error = F.when(value.isNull() | (F.length(value) == 0), EMPTY_VALUE)
    if policy == "strict":
        error = error.when(_zero_first(value) & (F.length(value) < HEADER), BAD_WIRE_HEADER)
    return error


def schema_id(value):
    """Schema id of a framed value, else null; it is unsigned, hence a bigint."""
    number = F.conv(F.hex(F.substr(value, F.lit(2), F.lit(4))), 16, 10).cast("bigint")
    return F.when(_zero_first(value) & (F.length(value) >= HEADER), number)


def payload(value, found_id, error):
    """The Avro body of a value whose schema id and wire error are known."""
    body = F.substr(value, F.lit(HEADER + 1))
    return F.when(found_id.isNotNull(), body).when(error.isNull(), value)


def wire_info(value, policy="strict"):
    """All three as a struct ``schema_id, payload, wire_error``."""
    value = F.col(value) if isinstance(value, str) else value
    found_id, error = schema_id(value), wire_error(value, policy)
    return F.struct(
        found_id.alias("schema_id"),
        payload(value, found_id, error).alias("payload"),
        error.alias("wire_error"),
    )
