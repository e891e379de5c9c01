"""Correlated degradation of several groups on one topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwatch import schemas
from lagwatch.functions import texts
from lagwatch.functions.expr import alert_id, json_object, least_strict
from lagwatch.operators import timeline as tl
from lagwatch.operators.rules import in_gate

CHUNK_SECONDS = 3600


def degraded() -> Column:
    """Falling behind, lag growing fast, or speed below half the 24-hour mean lag.

    The last comparison mixes messages per second with messages; it is kept as the rule has it.
    """
    return (
        F.col("is_falling_behind")
        | (F.col("lag_velocity") > 100)
        | (F.col("read_speed") < F.col("lag_24h_avg") * 0.5)
    )


GROUP_WINDOW = f"PARTITION BY topic, consumer_group, {tl.CHUNK} ORDER BY {tl.US}"


def presence_steps(at: str, width: int) -> Column:
    """+1 / -1 steps of "this group was present within the last ``width`` microseconds".

    ``at`` names a column holding the sample's time, null where the sample does not count. A
    sample opens an interval unless an earlier one still covers it, and closes one unless a later
    one extends it. Running sums of the steps over all groups count distinct groups, with no set
    of groups held anywhere.
    """
    us = F.col(at)
    before = F.expr(f"lag({at}) IGNORE NULLS OVER ({GROUP_WINDOW})")
    after = F.expr(f"lead({at}) IGNORE NULLS OVER ({GROUP_WINDOW})")
    opens = us.isNotNull() & (before.isNull() | (before < us - width))
    closes = us.isNotNull() & (after.isNull() | (after > us + width))
    return F.struct(opens.cast("int").alias("open"), closes.cast("int").alias("close"))


def correlation(
    metrics: DataFrame,
    lookback: float = 300,
    min_groups: int = 2,
    bucket: int = 300,
    gate: str = "mod",
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """At least ``min_groups`` distinct groups of a topic degraded in the trailing window.

    1. per (topic, group, chunk): presence steps of degraded and of all samples;
    2. steps and candidate rows are summed per (topic, chunk, time), combined before the shuffle;
    3. running sums per (topic, chunk) give both distinct counts at every time.

    ``affected_groups`` counts over the window, ``degrading_groups`` lists the groups at the time
    of the alert; the two may differ.
    """
    width = int(lookback * tl.SECOND)
    columns = [
        "event_time", "cluster_id", "consumer_group", "topic", "current_lag", "read_speed",
        "write_speed", "time_to_catchup_seconds", "partition_skew_score",
    ]
    rows = metrics.select(
        *columns,
        F.coalesce(degraded(), F.lit(False)).alias("_degraded"),
        (F.col("is_falling_behind") | (F.col("lag_velocity") > 100)).alias("_candidate"),
    )
    spread = tl.spread_time(rows, "event_time", chunk_seconds, before=lookback)
    degraded_at = F.when(F.col("_degraded"), F.col(tl.US))
    stepped = spread.withColumn("_degraded_us", degraded_at).withColumns(
        {
            "_affected": presence_steps("_degraded_us", width),
            "_total": presence_steps(tl.US, width),
        }
    )
    wanted = F.col(tl.OWN) & F.col("_candidate")
    if gate == "mod":
        wanted = wanted & in_gate(F.col("event_time"), bucket)

    def entry(at: Column, affected: Column, total: Column, row: Column) -> Column:
        return F.struct(
            at.alias("_at"), affected.alias("_da"), total.alias("_dt"), row.alias("_row")
        )

    no_row = F.lit(None).cast(spread.select(F.struct(*columns)).schema[0].dataType)
    opened = F.col("_affected.open") + F.col("_total.open") > 0
    us = F.col(tl.US)
    # steps behind the end of the chunk are the next chunk's own
    inside = us + width + 1 < (F.col(tl.CHUNK) + 1) * (chunk_seconds * tl.SECOND)
    closed = (F.col("_affected.close") + F.col("_total.close") > 0) & inside
    entries = F.array_compact(
        F.array(
            F.when(opened, entry(us, F.col("_affected.open"), F.col("_total.open"), no_row)),
            F.when(
                closed,
                entry(us + width + 1, -F.col("_affected.close"), -F.col("_total.close"), no_row),
            ),
            F.when(wanted, entry(us, F.lit(0), F.lit(0), F.struct(*columns))),
        )
    )
    row = F.col("_row")
    summed = (
        stepped.select("topic", tl.CHUNK, F.inline(entries))
        .groupBy("topic", tl.CHUNK, "_at", row["cluster_id"].alias("cluster_id"))
        .agg(
            F.sum("_da").alias("_da"),
            F.sum("_dt").alias("_dt"),
            F.min(row["event_time"]).alias("alert_time"),
            F.min(row["consumer_group"]).alias("consumer_group"),
            F.sum(row["current_lag"]).alias("current_lag"),
            F.avg(row["read_speed"]).alias("read_speed"),
            F.avg(row["write_speed"]).alias("write_speed"),
            F.max(row["time_to_catchup_seconds"]).alias("time_to_catchup_seconds"),
            F.avg(row["partition_skew_score"]).alias("partition_skew_score"),
            F.array_join(F.array_sort(F.collect_set(row["consumer_group"])), ", ").alias("_groups"),
        )
    )
    upto = (
        Window.partitionBy("topic", tl.CHUNK)
        .orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    affected = F.col("affected_groups")
    counted = (
        summed.withColumn("affected_groups", F.sum("_da").over(upto))
        .withColumn("total_groups", F.sum("_dt").over(upto))
        .where(F.col("alert_time").isNotNull() & (affected >= min_groups))
    )
    found = topic_alerts(counted)
    if gate == "first_in_bucket":
        from lagwatch.operators.alerts import first_in_bucket

        return first_in_bucket(found, bucket, ["detection_type", "cluster_id", "topic"])
    return found


def topic_alerts(counted: DataFrame) -> DataFrame:
    """Alerts of the moments at which enough groups of a topic were degraded."""
    affected, total = F.col("affected_groups"), F.col("total_groups")
    shared = affected >= total * 0.8
    cause = F.when(shared, texts.CAUSE_SHARED).otherwise(texts.CAUSE_MIXED)
    values = {
        "alert_id": alert_id("correlation_", F.col("topic"), F.col("alert_time")),
        "detection_type": F.lit("correlation_multi_group"),
        "severity": F.when(affected >= 3, "critical").when(affected == 2, "warning").otherwise("info"),
        "anomaly_score": least_strict(affected / 5.0, F.lit(1.0)),
        "context": json_object(
            affected_groups=affected,
            total_groups_on_topic=total,
            degrading_groups=F.col("_groups"),
            root_cause=cause,
            recommendation=F.lit(texts.CORRELATION_ADVICE),
        ),
    }
    return counted.select(
        *[
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schemas.ALERTS
        ]
    )
