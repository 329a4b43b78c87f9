"""Reading provider payloads of uncertain shape."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelmill.functions.text import first_truthy, strip

# Only the two fields whose JSON type matters are variants. The transcript is
# read into plain strings, which have no size ceiling.
BODY_TYPE = (
    "transcript array<struct<text string>>, language string, "
    "length_seconds variant, detail variant, _corrupt_record string"
)


def parse_body(body: Column) -> Column:
    """One pass over the body; a body that is no JSON object has no fields."""
    return F.from_json(
        F.when(body.rlike(r"^\s*\{"), body), BODY_TYPE, {"mode": "PERMISSIVE"}
    )


def json_kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, ... of a variant; null when absent."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def wrapped_payload(body: Column) -> Column:
    """S4 as a document: ``{detail: text}`` for text, ``{data: ..}`` for non-objects."""
    parsed = F.try_parse_json(body)
    return (
        F.when(parsed.isNull(), F.to_json(F.struct(strip(body).alias("detail"))))
        .when(json_kind(parsed) == "OBJECT", F.to_json(parsed))
        .otherwise(F.to_json(F.struct(parsed.alias("data"))))
    )


def detail_message(body: Column, payload: Column) -> Column:
    """Nested message, else the detail itself, else the raw non-JSON text."""
    detail = payload["detail"]
    kind = json_kind(detail)
    no_fields = (
        detail.isNull()
        & payload["transcript"].isNull()
        & payload["language"].isNull()
        & payload["length_seconds"].isNull()
    )
    not_json = (payload.isNull() | payload["_corrupt_record"].isNotNull()) & no_fields
    return (
        F.when(not_json & F.try_parse_json(body).isNull(), strip(F.coalesce(body, F.lit(""))))
        .when(detail.isNull() | (kind == "VOID"), F.lit(""))
        .when(
            kind == "OBJECT",
            first_truthy(F.try_variant_get(detail, "$.message", "string"), F.to_json(detail)),
        )
        .when(kind == "ARRAY", F.to_json(detail))
        .otherwise(F.try_variant_get(detail, "$", "string"))
    )


def whole_seconds(value: Column) -> Column:
    """A JSON integer as INT; booleans, fractions and strings are null."""
    return F.when(json_kind(value) == "BIGINT", F.try_variant_get(value, "$", "int"))
