"""The stages of the topology: collector metrics, rules, forecasts, feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lagwatch import schemas
from lagwatch.operators import alerts, correlate, feeds, forecast, rules
from lagwatch.streaming.stages import Stage

#: What the rules read of a metric record.
FLAT_COLUMNS = tuple(c for c in schemas.METRICS_FLATTENED.fieldNames() if c != "lag_percentile_95_24h")


def _all_rules(metrics: DataFrame) -> DataFrame:
    by_group = rules.detect(
        metrics, [rules.lag_up_rule(), rules.inactive_rule(), rules.rebalance_rule()]
    )
    return alerts.all_alerts(by_group, correlate.correlation(metrics))


def rules_stage() -> Stage:
    """Metric rows to alerts: the longest frame is the five minutes of the correlation."""
    return Stage(
        name="rules",
        keys=("cluster_id", "consumer_group"),
        time="event_time",
        transform=_all_rules,
        history_keys=("cluster_id", "consumer_group"),
        history_time="event_time",
        out_time="alert_time",
        lookback=300,
    )


def forecast_stage(rule=forecast.forecast_lag_up, rows: int = 100) -> Stage:
    """One forecast rule as its own job; the model needs the last ``rows`` rows of a group."""
    trained_on = {
        forecast.forecast_lag_up: F.col("current_lag") > 0,
        forecast.forecast_speed_down: F.col("read_speed") > 0,
        forecast.forecast_hot_partition: (F.col("partition_count") > 1)
        & (F.col("partition_skew_score") > 0),
    }[rule]
    return Stage(
        name=rule.__name__,
        keys=("cluster_id", "consumer_group"),
        time="event_time",
        prepare=lambda df: df.where(trained_on),
        transform=rule,
        history_keys=("cluster_id", "consumer_group"),
        history_time="event_time",
        out_time="alert_time",
        tail=rows,
    )


def settled_stage(name: str) -> Stage:
    """Rows in event-time order without duplicates or late rows, and nothing more."""
    return Stage(
        name=name,
        keys=("cluster_id", "consumer_group"),
        time="event_time",
        transform=lambda df: df,
        history_keys=("cluster_id", "consumer_group"),
        history_time="event_time",
        out_time="event_time",
    )


def deduplicated(stream: DataFrame, key: str = "alert_id", time: str = "alert_time") -> DataFrame:
    """Alert stream with redelivered ids removed within the 10-second watermark."""
    return stream.withWatermark(time, "10 seconds").dropDuplicatesWithinWatermark([key])


def feed_stats(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Running event count and time of the last event, in complete mode."""
    def replace(df: DataFrame, _: int) -> None:
        df.write.mode("overwrite").parquet(path)

    return (
        feeds.event_feed_stats(events)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
        .trigger(availableNow=True)
        .start()
    )
