"""Read side: latest rows, newest-first feeds, event rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwatch.operators.alerts import upsert_latest


def latest_per_group(
    metrics: DataFrame, key: str = "consumer_group", order: Sequence[str] = ("event_time",)
) -> DataFrame:
    """Newest row of every group; a missing group name counts as 'unknown'."""
    named = metrics.withColumn(key, F.coalesce(F.nullif(F.col(key), F.lit("")), F.lit("unknown")))
    rest = [c for c in metrics.columns if c != key and c not in order]
    return upsert_latest(named, [key], [*order, *rest])


def recent(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The newest ``n`` rows under a total order: per-partition top-n, then one merge of n rows."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def trend_points(metrics: DataFrame, n: int = 50) -> DataFrame:
    """The last ``n`` chart points, oldest first, with missing values as 0."""
    points = metrics.select(
        "event_time",
        "consumer_group",
        *[
            F.coalesce(F.col(source), F.lit(0)).alias(name)
            for source, name in (
                ("current_lag", "lag"),
                ("read_speed", "read_speed"),
                ("write_speed", "write_speed"),
            )
        ],
    )
    return recent(points, n, ["event_time", "consumer_group"]).orderBy(
        "event_time", "consumer_group"
    )


def event_feed_stats(events: DataFrame) -> DataFrame:
    """Number of events and time of the last one; works on streams in complete mode."""
    return events.agg(
        F.count(F.lit(1)).alias("total_events"), F.max("event_time").alias("last_event_time")
    )


def scenario_rollup(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", "scenario_name", "consumer_group").agg(
        F.count(F.lit(1)).alias("events"), F.sum("message_count").alias("messages")
    )


def retain(df: DataFrame, time: str, days: int = 7) -> DataFrame:
    """Rows no older than ``days`` before the newest one.

    The bound is a scalar subquery. On a table that ``write_by_date`` made, the same bound on its
    partition column prunes files.
    """
    bound = df.agg((F.max(time) - F.expr(f"INTERVAL {days} DAYS")).alias("bound")).scalar()
    kept = df.where(F.col(time) >= bound)
    if "event_date" in df.columns and time != "event_date":
        kept = kept.where(F.col("event_date") >= F.to_date(bound))
    return kept
