"""Partition samples to one row per group and poll."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKEW_CAP = 5.0
POLL_KEYS = ("cluster_id", "consumer_group")


def skew_score(largest: Column, total: Column, count: Column) -> Column:
    """max / mean, at most 5; 0 for a single partition or an all-zero group."""
    return F.when((count > 1) & (total != 0), F.least(largest / (total / count), F.lit(SKEW_CAP))).otherwise(
        F.lit(0.0)
    )


def group_rollup(lag: DataFrame, partitions: bool = False, per_topic: bool = False) -> DataFrame:
    """Sum the partitions of each group and poll.

    The first step aggregates numbers per (group, topic, poll) by hashing, before and after its
    shuffle. A group's topic is the first by (topic, partition): the second step reduces the topics
    of a group, usually one; ``per_topic`` leaves it out. ``partitions`` adds the nested detail
    array, which cannot be combined before a shuffle, so it is off unless asked for.
    """
    time = F.col("poll_time").alias("event_time")
    details = [nested_partitions().alias("partitions")] if partitions else []
    rolled = lag.groupBy(*POLL_KEYS, "topic", time).agg(
        F.sum("lag").alias("current_lag"),
        F.sum("current_offset").alias("total_current_offset"),
        F.sum("log_end_offset").alias("total_log_end_offset"),
        F.count(F.lit(1)).cast("int").alias("partition_count"),
        F.max("lag").alias("_largest"),
        F.min("lag").alias("_smallest"),
        *details,
    )
    if not per_topic:
        if partitions:
            details = [F.sort_array(F.flatten(F.collect_list("partitions"))).alias("partitions")]
        rolled = rolled.groupBy(*POLL_KEYS, "event_time").agg(
            F.min("topic").alias("topic"),
            F.sum("current_lag").alias("current_lag"),
            F.sum("total_current_offset").alias("total_current_offset"),
            F.sum("total_log_end_offset").alias("total_log_end_offset"),
            F.sum("partition_count").cast("int").alias("partition_count"),
            F.max("_largest").alias("_largest"),
            F.min("_smallest").alias("_smallest"),
            *details,
        )
    return (
        rolled.withColumn(
            "partition_skew_score",
            skew_score(F.col("_largest"), F.col("current_lag"), F.col("partition_count")),
        )
        .withColumn("partition_skew", F.col("_largest") - F.col("_smallest"))
        .drop("_largest", "_smallest")
    )


def nested_partitions() -> Column:
    return F.sort_array(
        F.collect_list(
            F.struct(
                F.col("partition_id"),
                F.col("topic"),
                F.col("lag"),
                F.col("current_offset").alias("consumed_offset"),
                F.col("log_end_offset"),
            )
        )
    )


def explode_partitions(metrics: DataFrame) -> DataFrame:
    """Back from the nested array to one row per partition."""
    keep = [c for c in metrics.columns if c not in ("partitions", "topic")]
    return metrics.select(*keep, F.inline("partitions"))
