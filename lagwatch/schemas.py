"""Explicit schemas; nothing is inferred."""

from pyspark.sql import types as T

_S, _L, _I, _D, _B, _TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


CONSUMER_LAG = _struct(
    ("cluster_id", _S),
    ("consumer_group", _S),
    ("topic", _S),
    ("partition_id", _I),
    ("current_offset", _L),
    ("log_end_offset", _L),
    ("lag", _L),
    ("poll_time", _TS),
)

PARTITION_DETAIL = _struct(
    ("partition_id", _I),
    ("topic", _S),
    ("lag", _L),
    ("consumed_offset", _L),
    ("log_end_offset", _L),
)

_MEASURES = [
    ("cluster_id", _S),
    ("consumer_group", _S),
    ("topic", _S),
    ("current_lag", _L),
    ("read_speed", _D),
    ("write_speed", _D),
    ("time_to_catchup_seconds", _D),
    ("partition_skew_score", _D),
    ("lag_24h_avg", _D),
    ("lag_percentile_95_24h", _D),
    ("partition_count", _I),
]

METRICS_SOURCE = _struct(
    ("timestamp", _S), *_MEASURES, ("partitions", T.ArrayType(PARTITION_DETAIL))
)

METRICS_FLATTENED = _struct(
    ("event_time", _TS),
    *_MEASURES,
    ("lag_velocity", _D),
    ("speed_ratio", _D),
    ("is_falling_behind", _B),
)

ALERTS = _struct(
    ("alert_id", _S),
    ("alert_time", _TS),
    ("detection_type", _S),
    ("severity", _S),
    ("cluster_id", _S),
    ("consumer_group", _S),
    ("topic", _S),
    ("current_lag", _L),
    ("read_speed", _D),
    ("write_speed", _D),
    ("time_to_catchup_seconds", _D),
    ("partition_skew_score", _D),
    ("anomaly_score", _D),
    ("context", _S),
)

ENRICHED_ALERTS = _struct(
    ("alert_id", _S),
    ("diagnosis", _S),
    ("severity", _S),
    ("recommended_action", _S),
    ("metric_details", _S),
    ("timestamp", _TS),
)

ALERT_FEEDBACK = _struct(("alert_id", _S), ("feedback", _S), ("timestamp", _S))

AGENT_MEMORY = _struct(("key", _S), ("value", _S), ("partition", _I), ("offset", _L))

SIMULATOR_EVENT = _struct(
    ("timestamp", _S),
    ("consumer_group", _S),
    ("topic", _S),
    ("message_count", _I),
    ("event_type", _S),
    ("scenario_name", _S),
    ("scenario_id", _S),
)

TELEMETRY = _struct(("metric", _S), ("topic", _S), ("ts", _TS), ("value", _D))

RAW_MESSAGES = _struct(
    ("topic", _S), ("partition", _I), ("offset", _L), ("key", _S), ("value", _S)
)

# Fields a published record must carry, with their JSON types; in brackets: those of array elements.
PARTITION_DETAIL_REQUIRED = {
    f.name: "string" if f.dataType == _S else "integer" for f in PARTITION_DETAIL
}

METRICS_SOURCE_REQUIRED = {
    "timestamp": "string",
    "cluster_id": "string",
    "consumer_group": "string",
    "topic": "string",
    "current_lag": "integer",
    "read_speed": "number",
    "write_speed": "number",
    "time_to_catchup_seconds": "number",
    "partition_skew_score": "number",
    "lag_24h_avg": "number",
    "lag_percentile_95_24h": "number",
    "partition_count": "integer",
    "partitions": [PARTITION_DETAIL_REQUIRED],
}

METRICS_FLATTENED_REQUIRED = {
    "event_time": "string",
    **{k: v for k, v in METRICS_SOURCE_REQUIRED.items() if k not in ("timestamp", "partitions")},
    "lag_velocity": "number",
    "speed_ratio": "number",
    "is_falling_behind": "boolean",
}
