"""Alert rows: building, fan-in, upsert, enrichment, feedback, routing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwatch import schemas
from lagwatch.functions import texts
from lagwatch.functions.expr import bucket, severity_class
from lagwatch.operators import timeline as tl
from lagwatch.session import stage_table

def as_alerts(df: DataFrame) -> DataFrame:
    """Project and cast to the alert table's schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.ALERTS])


def all_alerts(*branches: DataFrame) -> DataFrame:
    """Fan-in of every rule into one alert table."""
    return reduce(DataFrame.unionByName, [as_alerts(b) for b in branches])


def upsert_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Last row per key. ``max_by`` combines before the shuffle, so a hot key costs one row
    per input partition; no sort of the key's history."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


def compact(log: DataFrame) -> DataFrame:
    """Compacted table: last value per key by (partition, offset); a null value deletes."""
    return upsert_latest(log, ["key"], ["partition", "offset"]).where(F.col("value").isNotNull())


def feedback_latest(feedback: DataFrame) -> DataFrame:
    return upsert_latest(feedback, ["alert_id"], ["timestamp", "feedback"])


def enrich(alerts: DataFrame, enriched: DataFrame) -> DataFrame:
    """Alerts with the newest enrichment; fields of the enrichment win.

    The right side is reduced to one row per alert before the join, so the join cannot multiply.
    """
    shared = [c for c in enriched.columns if c in alerts.columns and c != "alert_id"]
    added = [c for c in enriched.columns if c not in alerts.columns]
    newest = upsert_latest(enriched, ["alert_id"], ["timestamp", "diagnosis"])
    newest = newest.withColumnsRenamed({c: f"_e_{c}" for c in shared})
    merged = alerts.join(newest, "alert_id", "left")
    chosen = {c: F.coalesce(F.col(f"_e_{c}"), F.col(c)) for c in shared}
    return merged.withColumns(chosen).select(*alerts.columns, *added)


def feedback_by_type(alerts: DataFrame, feedback: DataFrame) -> DataFrame:
    """Votes per detection type; votes are counted per alert before the join."""
    votes = feedback.groupBy("alert_id").agg(
        F.count_if(F.col("feedback") == "up").alias("up"),
        F.count_if(F.col("feedback") == "down").alias("down"),
    )
    return (
        alerts.select("alert_id", "detection_type")
        .join(votes, "alert_id")
        .groupBy("detection_type")
        .agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    )


def first_in_bucket(
    alerts: DataFrame, seconds: int, keys: Sequence[str] = ("detection_type", "consumer_group")
) -> DataFrame:
    """First alert per key and time bucket: rate gating that no cadence jitter defeats."""
    slot = bucket(F.unix_seconds("alert_time"), seconds)
    rest = [c for c in alerts.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct("alert_time", "alert_id")).alias("_first")
    grouped = alerts.withColumn("_slot", slot).groupBy(*keys, "_slot").agg(first)
    return grouped.select(*keys, "_first.*").select(*alerts.columns)


def route_severe(alerts: DataFrame, severities: Sequence[str] = ("critical", "high")) -> DataFrame:
    return alerts.where(F.lower("severity").isin(*severities))


def with_severity_class(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("severity_class", severity_class(F.col("severity")))


def _presence(groups: DataFrame, lookback: float, chunk_seconds: int) -> DataFrame:
    """(topic, consumer_group, _from, _to): when a group has an alert in the trailing window, in microseconds.

    Alerts no further apart than the window make one interval. Intervals end at the chunk, so that a group
    of any length is spread; those of neighbouring chunks may overlap.
    """
    reach = int(lookback * tl.SECOND)
    timed = groups.where(F.col("consumer_group").isNotNull()).withColumn(tl.US, F.unix_micros("alert_time"))
    chunked = timed.withColumn(tl.CHUNK, bucket(F.col(tl.US), chunk_seconds * tl.SECOND))
    window = tl.over(["topic", "consumer_group"])
    before = F.lag(tl.US).over(window)
    opened = chunked.withColumn("_opens", (before.isNull() | (F.col(tl.US) - before > reach)).cast("int"))
    island = F.sum("_opens").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        opened.withColumn("_island", island)
        .groupBy("topic", "consumer_group", tl.CHUNK, "_island")
        .agg(F.min(tl.US).alias("_from"), (F.max(tl.US) + reach).alias("_to"))
        .drop(tl.CHUNK, "_island")
    )


def correlate_alerts(
    alerts: DataFrame, lookback: float = 300, n: int = 3, chunk_seconds: int = 3600
) -> DataFrame:
    """Topics with at least ``n`` alerts in the trailing window, one row per (topic, time).

    The finding depends on topic and time only, so it is not repeated for each alert: alerts join
    it on those two columns. Alerts are first reduced to one row per (topic, time, group), written once.
    Moments are counted on their chunks; those that qualify meet the groups' presence intervals on
    (topic, slice of one window's length), so the rows are the moments times their groups.
    """
    groups = stage_table(
        alerts.groupBy("topic", "alert_time", "consumer_group").agg(F.count(F.lit(1)).alias("_n")), "alert_groups"
    )
    moments = groups.groupBy("topic", "alert_time").agg(F.sum("_n").alias("_n"))
    spread = tl.spread_time(moments, "alert_time", chunk_seconds, before=lookback)
    count = tl.trailing_sum(F.col("_n"), tl.over(["topic"]), lookback)
    counted = spread.withColumn("recent_alerts", count).where(F.col("recent_alerts") >= n)

    width = max(int(lookback * tl.SECOND), 1)
    asked = counted.where(tl.OWN).select(
        "topic", "alert_time", "recent_alerts", tl.US, bucket(F.col(tl.US), width).alias("_slice")
    )
    present = _presence(groups, lookback, chunk_seconds).select(
        F.col("topic").alias("_topic"),
        "consumer_group",
        "_from",
        "_to",
        F.explode(F.sequence(bucket(F.col("_from"), width), bucket(F.col("_to"), width))).alias("_part"),
    )
    met = asked.join(
        present,
        F.col("topic").eqNullSafe(F.col("_topic"))
        & (F.col("_slice") == F.col("_part"))
        & F.col(tl.US).between(F.col("_from"), F.col("_to")),
        "left",
    )
    return (
        met.groupBy("topic", "alert_time", "recent_alerts")
        .agg(F.array_sort(F.collect_set("consumer_group")).alias("correlated_groups"))
        .withColumns(
            {
                "correlation_type": F.lit(texts.SAME_TOPIC),
                "root_cause_probability": F.lit(texts.SAME_TOPIC_CAUSE),
                "recommended_action": F.concat(F.lit(texts.SAME_TOPIC_ADVICE), F.col("topic")),
            }
        )
    )


def merge_sources(
    left: DataFrame, right: DataFrame, seconds: int = 60, key: str = "consumer_group"
) -> DataFrame:
    """Two metric sources joined per group and time bucket; columns of the right one win.

    The right side keeps its last row per (group, bucket), so one left row stays one row.
    """
    slot = bucket(F.unix_seconds("event_time"), seconds)
    shared = [c for c in right.columns if c in left.columns and c not in (key, "event_time")]
    added = [c for c in right.columns if c not in left.columns]
    newest = upsert_latest(
        right.withColumn("_slot", slot), [key, "_slot"], ["event_time", *added, *shared]
    ).drop("event_time")
    newest = newest.withColumnsRenamed({c: f"_r_{c}" for c in shared})
    joined = left.withColumn("_slot", slot).join(newest, [key, "_slot"], "left")
    chosen = {c: F.coalesce(F.col(f"_r_{c}"), F.col(c)) for c in shared}
    return joined.withColumns(chosen).select(*left.columns, *added)
