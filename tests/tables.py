"""Small hand-written tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from lagwatch import schemas

START = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def metric_rows(spark, rows):
    """Metric rows from dictionaries with ``t`` in seconds; the rest has quiet defaults."""
    full = []
    for row in rows:
        values = {
            "event_time": at(row["t"]),
            "cluster_id": "c",
            "consumer_group": "g",
            "topic": "t",
            "current_lag": 500,
            "read_speed": 10.0,
            "write_speed": 10.0,
            "time_to_catchup_seconds": 50.0,
            "partition_skew_score": 1.0,
            "lag_24h_avg": 500.0,
            "lag_percentile_95_24h": 500.0,
            "partition_count": 3,
            "lag_velocity": 0.0,
            "speed_ratio": 1.0,
            "is_falling_behind": False,
        }
        values.update({k: v for k, v in row.items() if k != "t"})
        full.append(tuple(values[name] for name in schemas.METRICS_FLATTENED.fieldNames()))
    return spark.createDataFrame(full, schemas.METRICS_FLATTENED)


def poll_rows(spark, rows):
    """(group, seconds, consumed, end) tuples as group polls."""
    return spark.createDataFrame(
        [
            ("c", group, at(t), "t", end - consumed, consumed, end, 1, 0.0, 0)
            for group, t, consumed, end in rows
        ],
        "cluster_id string, consumer_group string, event_time timestamp, topic string, "
        "current_lag bigint, total_current_offset bigint, total_log_end_offset bigint, "
        "partition_count int, partition_skew_score double, partition_skew bigint",
    )


def same(left, right) -> bool:
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
