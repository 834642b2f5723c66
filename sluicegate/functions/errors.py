"""Error codes, in order of precedence, and the texts the router variants use for them."""

from pyspark.sql import functions as F

EMPTY_VALUE = "empty_value"
BAD_WIRE_HEADER = "bad_wire_header"
UNKNOWN_SCHEMA = "unknown_schema"
NO_DEFAULT_SCHEMA = "no_default_schema"
DECODE_FAILED = "decode_failed"
NO_ROUTE_MATCHED = "no_route_matched"

CODES = (
    EMPTY_VALUE,
    BAD_WIRE_HEADER,
    UNKNOWN_SCHEMA,
    NO_DEFAULT_SCHEMA,
    DECODE_FAILED,
    NO_ROUTE_MATCHED,
)

# Error texts that must read as those of the router scripts.
EMPTY_VALUE_TEXT = "Empty value"
EMPTY_PAYLOAD_TEXT = "Empty payload"
BAD_WIRE_HEADER_TEXT = "Bad wire header (no schema id)"
NO_DEFAULT_SCHEMA_TEXT = "DEFAULT_SCHEMA_STR is empty"
WIRE_ERROR_PREFIX = "wire_error: "
DECODE_FAILED_TEXT = "from_avro_failed"


def error_text(code, value, style="code"):
    """Text of an error code column; ``value`` tells an empty message from a null one."""
    if style == "message":
        empty = F.when(value.isNull(), EMPTY_VALUE_TEXT).otherwise(EMPTY_PAYLOAD_TEXT)
        return (
            F.when(code == EMPTY_VALUE, empty)
            .when(code == BAD_WIRE_HEADER, BAD_WIRE_HEADER_TEXT)
            .when(code == NO_DEFAULT_SCHEMA, NO_DEFAULT_SCHEMA_TEXT)
            .otherwise(code)
        )
    if style == "reader":
        wire = code.isin(EMPTY_VALUE, BAD_WIRE_HEADER)
        return (
            F.when(wire, F.concat(F.lit(WIRE_ERROR_PREFIX), code))
            .when(code == DECODE_FAILED, DECODE_FAILED_TEXT)
            .otherwise(code)
        )
    return code


def error_headers(error):
    """Headers of a rejected message: the reason, in place of what came in."""
    return F.array(
        F.struct(F.lit("error").alias("key"), error.cast("binary").alias("value"))
    )
