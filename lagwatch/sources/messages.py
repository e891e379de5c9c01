"""Message payloads: dispatch by topic, framed JSON, schema checks, open-schema events.

A required-field table maps a member's name to its JSON type. ``[{...}]`` in place of a type means an
array whose elements are objects with required members of their own, to any depth.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagwatch import schemas
from lagwatch.functions.expr import parse_iso

# Registry framing is one zero byte and a four-byte schema id before the JSON text.
FRAME_BYTES = 5

# Variant type names that satisfy each JSON Schema type.
_JSON_TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DOUBLE", "FLOAT", "DECIMAL"],
    "boolean": ["BOOLEAN"],
}

Required = Mapping[str, "str | list[Required]"]


def dispatch(messages: DataFrame, topic: str, schema: T.StructType) -> DataFrame:
    """Typed rows of one topic, with topic, partition, offset and key kept.

    Values that are no JSON object give no row; ``check`` names them.
    """
    parsed = F.from_json("value", schema)
    return messages.where((F.col("topic") == topic) & _members(F.try_parse_json("value")).isNotNull()).select(
        F.col("topic").alias("_topic"),
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
        F.col("key").alias("_key"),
        parsed.alias("_value"),
    ).select("_topic", "_partition", "_offset", "_key", "_value.*")


def _text_behind_frame(frame: Column) -> Column:
    """JSON text of a framed value; null where the frame is short or does not begin with a zero byte."""
    framed = (F.length(frame) >= FRAME_BYTES) & (F.hex(F.substring(frame, 1, 1)) == "00")
    length = F.greatest(F.length(frame) - FRAME_BYTES, F.lit(0))
    return F.when(framed, frame.substr(F.lit(FRAME_BYTES + 1), length).cast("string"))


def unframe(df: DataFrame, value: str = "value") -> DataFrame:
    """Replace a framed value by its text and add ``schema_id``; both are null without a valid frame."""
    text = _text_behind_frame(F.col(value))
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    return df.withColumns({"schema_id": F.when(text.isNotNull(), schema_id), value: text})


def decode_framed(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Strip the frame of a binary value and parse the JSON behind it.

    A value without a valid frame gives a row whose ``schema_id`` and members are null.
    """
    others = [c for c in df.columns if c != value]
    return unframe(df, value).select(
        *others, "schema_id", F.from_json(value, schema).alias("_value")
    ).select(*others, "schema_id", "_value.*")


def encode_framed(json_text: Column, schema_id: int) -> Column:
    frame = F.unhex(F.lit(f"00{schema_id:08x}"))
    return F.concat(frame, json_text.cast("binary"))


def _members(value: Column) -> Column:
    """Members of a variant object; null for any other value."""
    return F.try_variant_get(value, "$", "map<string, variant>")


def _elements(value: Column) -> Column:
    """Elements of a variant array; null for any other value."""
    return F.try_variant_get(value, "$", "array<variant>")


def _first(checked: Column) -> Column:
    return F.get(F.filter(checked, lambda reason: reason.isNotNull()), F.lit(0))


def _problem(members: Column, required: Required, path: str) -> Column:
    """First thing wrong with the members of an object, or null; ``members`` is null if it is no object.

    Members are looked at in the order of the table; those of array elements come after them, in
    the order of the elements. Only the required members are looked at.
    """
    own, nested = [], []
    for name, kind in required.items():
        value = members[name]
        if isinstance(kind, list) or kind == "array":
            fits = _elements(value).isNotNull()
        else:
            fits = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0).isin(_JSON_TYPES[kind])
        own.append(
            F.when(value.isNull(), F.lit(f"missing:{path}{name}")).when(~fits, F.lit(f"type:{path}{name}"))
        )
        if isinstance(kind, list):
            inside = F.transform(_elements(value), _members)
            nested.append(_first(F.transform(inside, _checker(kind[0], f"{path}{name}[]."))))
    unlike = F.lit(f"type:{path.removesuffix('.')}" if path else "malformed")
    return F.when(members.isNull(), unlike).otherwise(F.coalesce(*own, *nested))


def _checker(required: Required, path: str) -> Callable[[Column], Column]:
    return lambda members: _problem(members, required, path)


def check(df: DataFrame, required: Required, value: str = "value", framed: bool = False) -> DataFrame:
    """Add ``reason``: null for a valid record, else the first thing wrong with it.

    Reasons: ``frame`` (a binary value, if ``framed``, without a valid frame), ``malformed`` (no JSON
    object, or null), ``missing:<member>`` and ``type:<member>``; members of array elements are named
    ``array[].member``, and an element that is no object is ``type:array[]``. The text is parsed once.
    """
    text = _text_behind_frame(F.col(value)) if framed else F.col(value)
    # an array of one, so that the members are parsed once, wherever the optimizer moves the reason
    parsed = F.array(_members(F.try_parse_json(text)))
    reason = F.get(F.transform(parsed, _checker(required, "")), F.lit(0))
    return df.withColumn("reason", F.when(text.isNull(), "frame").otherwise(reason) if framed else reason)


def typed(checked: DataFrame, schema: T.StructType, value: str = "value", framed: bool = False) -> DataFrame:
    """Records without a ``reason``, parsed."""
    others = [c for c in checked.columns if c not in (value, "reason")]
    text = _text_behind_frame(F.col(value)) if framed else F.col(value)
    return (
        checked.where(F.col("reason").isNull())
        .select(*others, F.from_json(text, schema).alias("_value"))
        .select(*others, "_value.*")
    )


def validate(
    df: DataFrame, schema: T.StructType, required: Required, value: str = "value", framed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split records into typed rows and a quarantine; a bad record never fails the job."""
    checked = check(df, required, value, framed)
    return typed(checked, schema, value, framed), checked.where(F.col("reason").isNotNull())


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def with_event_time(source: DataFrame) -> DataFrame:
    """Computed event time of raw metrics."""
    return source.withColumn("event_time", parse_iso(F.col("timestamp")))


def parse_event(df: DataFrame, value: str = "value") -> DataFrame:
    """Open-schema events: the declared fields typed, every other member in a string map."""
    declared = schemas.SIMULATOR_EVENT.fieldNames()
    members = F.from_json(value, T.MapType(T.StringType(), T.StringType()))
    extra = F.map_filter(members, lambda k, _: ~k.isin(*declared))
    others = [c for c in df.columns if c != value]
    return df.select(
        *others, F.from_json(value, schemas.SIMULATOR_EVENT).alias("_event"), extra.alias("extra")
    ).select(*others, "_event.*", "extra")


def event_type(scenario_name: Column) -> Column:
    """An empty or missing scenario name makes a baseline event."""
    return F.when(F.length(scenario_name) > 0, "anomaly_injection").otherwise("baseline_event")
