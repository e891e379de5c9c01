"""Registered queries: one per operator of the inventory, over the whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lagwatch import schemas
from lagwatch.functions.expr import iso_utc
from lagwatch.operators import (
    alerts,
    baseline,
    correlate,
    feeds,
    forecast,
    rollup,
    rules,
    telemetry,
    velocity,
)
from lagwatch.plans import inputs
from lagwatch.plans.present import open_context, present
from lagwatch.session import configure, scratch_path, stage_table
from lagwatch.sources import messages, tables
from lagwatch.streaming import jobs, keyed, sinks, stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Members of each rule's JSON context, as published.
LAG_UP_CONTEXT = (
    "lag_vs_avg_ratio double, actual_lag bigint, lag_24h_avg double, lag_velocity double, "
    "window_size_minutes int, model_type string"
)
INACTIVE_CONTEXT = (
    "inactive_duration_seconds bigint, last_active_time string, lag_growth bigint, "
    "recommendation string"
)
REBALANCE_CONTEXT = (
    "zero_speed_events bigint, window_minutes int, speed_variance double, avg_speed double, "
    "possible_cause string, recommendation string"
)
CORRELATION_CONTEXT = (
    "affected_groups bigint, total_groups_on_topic bigint, degrading_groups string, "
    "root_cause string, recommendation string"
)
FORECAST_LAG_CONTEXT = (
    "predicted_lag double, actual_lag bigint, deviation_percent double, lag_velocity double, "
    "window_size_minutes int, model_type string"
)
FORECAST_SPEED_CONTEXT = (
    "predicted_speed double, actual_speed double, deviation_percent double, speed_ratio double, "
    "is_falling_behind boolean, model_type string"
)
FORECAST_SKEW_CONTEXT = (
    "predicted_skew double, actual_skew double, deviation_percent double, partition_count int, "
    "recommendation string, model_type string"
)

# Parameters under which speeds and skews of the derived tables are found; all_alerts has the published ones.
SENSITIVE = {"training_window": 20, "threshold": 0.1}

CONFIGURED_RULES = [
    {"detector": "deep_backlog", "measure": "current_lag", "enabled": True,
     "critical": 7_500, "high": 3_200},
    {"detector": "fast_growth", "measure": "lag_velocity", "enabled": True,
     "critical": 2_000, "high": 1_000},
    {"detector": "skew", "measure": "partition_skew_score", "enabled": True,
     "critical": 2.5, "high": 2.0},
    {"detector": "speed", "measure": "write_speed", "enabled": False,
     "critical": 1, "high": 0},
]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- scans, sinks, messages -------------------------------------------------------------------


@query
def scan_metrics_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON records written to files and scanned with the declared schema."""
    source = inputs.metrics_source(spark, sf_dir)
    path = scratch_path(spark, "metrics_source")
    source.select(*schemas.METRICS_SOURCE.fieldNames()).write.json(path)
    scanned = tables.scan_table(spark, path, schemas.METRICS_SOURCE, "json")
    typed = messages.with_event_time(scanned)
    return present(
        typed.select(
            "timestamp", "event_time", "cluster_id", "consumer_group", "topic", "current_lag",
            "read_speed", "lag_24h_avg", "lag_percentile_95_24h", "partition_count",
            F.size("partitions").alias("nested"),
        )
    )


@query
def scan_multi_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = stage_table(inputs.raw_messages(spark, sf_dir), "raw_messages")
    return raw.select("topic", "partition", "offset", "key")


@query
def topic_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = stage_table(inputs.raw_messages(spark, sf_dir), "raw_messages")
    typed = messages.dispatch(raw, "velocity_anomaly_alerts", schemas.ALERTS)
    return present(
        typed.select(
            F.col("_partition").alias("partition"), F.col("_offset").alias("offset"), "alert_id",
            "alert_time", "severity", "consumer_group", "topic", "current_lag", "anomaly_score",
        )
    )


@query
def decode_framed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.simulator_events(spark, sf_dir)
    framed = records.select(
        F.col("consumer_group").alias("key"),
        messages.encode_framed(inputs.event_json(records), 7).alias("value"),
    )
    return messages.decode_framed(framed, schemas.SIMULATOR_EVENT)


@query
def schema_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = messages.validate(
        inputs.wire_records(spark, sf_dir), schemas.METRICS_SOURCE, schemas.METRICS_SOURCE_REQUIRED
    )
    return present(
        valid.select("key", "timestamp", "topic", "current_lag", "read_speed", "partition_count")
    )


@query
def schema_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = messages.validate(
        inputs.wire_records(spark, sf_dir), schemas.METRICS_SOURCE, schemas.METRICS_SOURCE_REQUIRED
    )
    return messages.quarantine_counts(bad)


@query
def partitions_nest(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = inputs.group_polls(spark, sf_dir, partitions=True)
    return present(
        nested.select(
            "consumer_group", "event_time", F.to_json("partitions").alias("partitions")
        )
    )


@query
def partitions_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = inputs.group_polls(spark, sf_dir, partitions=True)
    flat = rollup.explode_partitions(nested.select("consumer_group", "event_time", "partitions"))
    return present(flat)


@query
def scan_consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "consumer_lag")
    inputs.consumer_lag(spark, sf_dir).write.parquet(path)
    return present(tables.scan_table(spark, path, schemas.CONSUMER_LAG))


@query
def feedback_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.feedback_latest(inputs.alert_feedback(inputs.alerts(spark, sf_dir)))


@query
def compact_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.compact(inputs.agent_memory(spark, sf_dir))


@query
def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = feeds.retain(inputs.simulator_events(spark, sf_dir), "event_time", days=7)
    return present(kept.select("event_id", "event_time", "consumer_group"))


@query
def parse_sim_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.simulator_events(spark, sf_dir)
    text = records.select("event_id", inputs.event_json(records).alias("value"))
    parsed = messages.parse_event(text)
    open_keys = {k: F.try_element_at("extra", F.lit(k)) for k in ("phase", "sequence_number")}
    return parsed.withColumns(open_keys).drop("extra")


@query
def event_type_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.simulator_events(spark, sf_dir)
    return records.select(
        "event_id", messages.event_type(F.col("scenario_name")).alias("event_type")
    )


@query
def alerts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts with later revisions of some; the last one per alert_id remains."""
    found = inputs.alerts(spark, sf_dir)
    revised = F.when(inputs.epoch() % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    log = found.withColumn("revision", F.explode(revised)).withColumn(
        "severity", F.when(F.col("revision") == 1, "critical").otherwise(F.col("severity"))
    )
    latest = alerts.upsert_latest(log, ["alert_id"], ["alert_time", "revision"])
    return present(
        latest.select("alert_id", "alert_time", "severity", "revision", "current_lag")
    )


# --- collector --------------------------------------------------------------------------------


@query
def group_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(inputs.group_polls(spark, sf_dir))


@query
def partition_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls = inputs.group_polls(spark, sf_dir)
    return present(
        polls.select("consumer_group", "event_time", "partition_skew_score", "partition_skew")
    )


@query
def group_speeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = velocity.group_speeds(inputs.polled(spark, sf_dir))
    return present(measured.select("consumer_group", "event_time", "read_speed", "write_speed"))


@query
def group_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    collected = baseline.lag_percentile(inputs.metrics(spark, sf_dir))
    return present(
        collected.select(
            "event_time", "cluster_id", "consumer_group", "topic", "current_lag", "read_speed",
            "write_speed", "time_to_catchup_seconds", "partition_skew_score", "lag_24h_avg",
            "lag_percentile_95_24h", "partition_count", "lag_velocity", "speed_ratio",
            "is_falling_behind",
        )
    )


@query
def lag_24h_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    averaged = baseline.lag_average(inputs.group_polls(spark, sf_dir))
    return present(averaged.select("consumer_group", "event_time", "lag_24h_avg"))


@query
def lag_24h_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls = inputs.group_polls(spark, sf_dir).select(*velocity.GROUP, "event_time", "current_lag")
    return present(baseline.lag_percentile(polls).drop("cluster_id", "current_lag"))


def _source_with_invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw topic as a written table; every 23rd poll carries a negative lag."""
    source = inputs.metrics_source(spark, sf_dir, partitions=False)
    tick = F.call_function("div", inputs.epoch("event_time"), F.lit(10))
    spoilt = F.when(tick % 23 == 0, F.lit(-1)).otherwise(F.col("current_lag"))
    return stage_table(source.withColumn("current_lag", spoilt), "metrics_source")


@query
def format_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(velocity.format_metrics(_source_with_invalid_rows(spark, sf_dir)))


@query
def lag_velocity_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = velocity.format_metrics(_source_with_invalid_rows(spark, sf_dir), velocity="rate")
    return present(rated.select("consumer_group", "event_time", "lag_velocity"))


# --- rules ------------------------------------------------------------------------------------


@query
def threshold_lag_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_context(inputs.alerts(spark, sf_dir), LAG_UP_CONTEXT)


@query
def threshold_lag_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(rules.threshold_lag_spike(inputs.metrics(spark, sf_dir)))


@query
def threshold_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_context(
        rules.threshold_inactive(inputs.metrics(spark, sf_dir)), INACTIVE_CONTEXT
    )


@query
def rebalance_storm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_context(rules.rebalance_storm(inputs.metrics(spark, sf_dir)), REBALANCE_CONTEXT)


@query
def correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_context(correlate.correlation(inputs.metrics(spark, sf_dir)), CORRELATION_CONTEXT)


@query
def moving_avg_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    spikes = rules.moving_avg_spike(inputs.metrics(spark, sf_dir), "read_speed")
    return present(spikes.drop("cluster_id", "metric_value"), decimals=7)


@query
def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(rules.rule_table(inputs.metrics(spark, sf_dir), CONFIGURED_RULES))


@query
def zscore_lag_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.forecast_lag_up(inputs.metrics(spark, sf_dir), algorithm="ZSCORE")
    return open_context(found, FORECAST_LAG_CONTEXT)


@query
def zscore_speed_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.forecast_speed_down(inputs.metrics(spark, sf_dir), "ZSCORE", **SENSITIVE)
    return open_context(found, FORECAST_SPEED_CONTEXT)


@query
def zscore_hot_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.forecast_hot_partition(inputs.metrics(spark, sf_dir), "ZSCORE", **SENSITIVE)
    return open_context(found, FORECAST_SKEW_CONTEXT)


@query
def forecast_lag_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_context(
        forecast.forecast_lag_up(inputs.metrics(spark, sf_dir)), FORECAST_LAG_CONTEXT
    )


@query
def forecast_speed_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_context(
        forecast.forecast_speed_down(inputs.metrics(spark, sf_dir)), FORECAST_SPEED_CONTEXT
    )


@query
def forecast_hot_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_context(
        forecast.forecast_hot_partition(inputs.metrics(spark, sf_dir)), FORECAST_SKEW_CONTEXT
    )


@query
def ar_lag_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.forecast_lag_up(inputs.metrics(spark, sf_dir), "AR")
    return open_context(found, FORECAST_LAG_CONTEXT)


@query
def ar_speed_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.forecast_speed_down(inputs.metrics(spark, sf_dir), "AR", **SENSITIVE)
    return open_context(found, FORECAST_SPEED_CONTEXT)


@query
def ar_hot_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.forecast_hot_partition(inputs.metrics(spark, sf_dir), "AR")
    return open_context(found, FORECAST_SKEW_CONTEXT)


@query
def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group rules in one pass, the topic rule and the forecast rules, over one written metrics table.

    The forecasts run with the algorithm that SQL can state.
    """
    table = stage_table(inputs.metrics(spark, sf_dir), "metrics_flattened")
    by_group = rules.detect(
        table,
        [rules.lag_up_rule(), rules.lag_spike_rule(), rules.inactive_rule(), rules.rebalance_rule()],
    )
    merged = alerts.all_alerts(
        by_group, correlate.correlation(table), *forecast.forecast_alerts(table, algorithm="ZSCORE")
    )
    return present(merged.drop("context"))


# --- alert views ------------------------------------------------------------------------------


@query
def alerts_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage_table(inputs.alerts(spark, sf_dir), "alerts")
    return open_context(alerts.enrich(found, inputs.enriched_alerts(found)), LAG_UP_CONTEXT)


@query
def alerts_correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.correlate_alerts(inputs.alerts(spark, sf_dir))
    return present(
        found.withColumn("correlated_groups", F.array_join("correlated_groups", ", "))
    )


@query
def alerts_first_in_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = alerts.first_in_bucket(inputs.alerts(spark, sf_dir), 300)
    return open_context(first, LAG_UP_CONTEXT)


@query
def feedback_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage_table(inputs.alerts(spark, sf_dir), "alerts")
    return alerts.feedback_by_type(found, inputs.alert_feedback(found))


@query
def route_severe(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = alerts.route_severe(inputs.alerts(spark, sf_dir))
    return present(routed.select("alert_id", "alert_time", "severity", "consumer_group"))


@query
def severity_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    classed = alerts.with_severity_class(inputs.alerts(spark, sf_dir))
    return classed.select("alert_id", "severity", "severity_class")


@query
def merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls merged with a second, sparser source that also overrides the topic."""
    polls = inputs.polled(spark, sf_dir).select(
        "consumer_group", "event_time", "topic", "current_lag", "total_log_end_offset"
    )
    at = inputs.epoch("event_time")
    second = polls.where(at % 30 == 0).select(
        "consumer_group",
        F.timestamp_seconds(at + 3).alias("event_time"),
        F.concat(F.lit("runtime_"), F.col("topic")).alias("topic"),
        (F.col("total_log_end_offset") % 4096).alias("heap_used_mb"),
    )
    merged = alerts.merge_sources(polls.drop("total_log_end_offset"), second)
    return present(merged)


# --- feeds ------------------------------------------------------------------------------------


@query
def latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = inputs.metrics(spark, sf_dir).select(
        "consumer_group", "event_time", "topic", "current_lag", "read_speed", "write_speed",
        "time_to_catchup_seconds", "lag_velocity",
    )
    return present(feeds.latest_per_group(metrics))


@query
def recent_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = inputs.metrics(spark, sf_dir).select(
        "event_time", "consumer_group", "topic", "current_lag", "read_speed", "write_speed"
    )
    return present(feeds.recent(metrics, 100, ["event_time", "consumer_group"]))


@query
def recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inputs.alerts(spark, sf_dir).select(
        "alert_id", "alert_time", "severity", "consumer_group", "topic", "current_lag"
    )
    return present(feeds.recent(found, 50, ["alert_time", "alert_id"]))


@query
def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.simulator_events(spark, sf_dir).select(
        "event_time", "event_id", "consumer_group", "topic", "message_count", "event_type",
        "scenario_name",
    )
    return present(feeds.recent(records, 100, ["event_time", "event_id"]))


@query
def trend_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(feeds.trend_points(inputs.metrics(spark, sf_dir)))


@query
def event_feed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(feeds.event_feed_stats(inputs.simulator_events(spark, sf_dir)))


@query
def scenario_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.scenario_rollup(inputs.simulator_events(spark, sf_dir))


# --- telemetry --------------------------------------------------------------------------------


@query
def telemetry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = inputs.telemetry_samples(spark, sf_dir)
    return present(
        telemetry.query(samples, "received_bytes", {"topic": "topic_1"}, interval="7 days")
    )


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.topic_telemetry(inputs.telemetry_samples(spark, sf_dir), "PT1H")


@query
def telemetry_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_hourly(spark, sf_dir))


@query
def telemetry_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = inputs.telemetry_samples(spark, sf_dir)
    return present(telemetry.cluster_telemetry(samples, "P1D"))


@query
def telemetry_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(telemetry.latest_values(inputs.telemetry_samples(spark, sf_dir)))


@query
def telemetry_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = telemetry.series(_hourly(spark, sf_dir), "received_bytes")

    def point(p: Column) -> Column:
        return F.concat(iso_utc(p["timestamp"]), F.lit("="), p["value"].cast("long"))

    joined = F.array_join(F.transform("received_bytes", point), ",")
    return series.withColumn("received_bytes", joined)


@query
def telemetry_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(telemetry.normalised(_hourly(spark, sf_dir), "received_bytes"))


@query
def telemetry_last15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(telemetry.last_points(_hourly(spark, sf_dir)))


@query
def telemetry_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = telemetry.topic_telemetry(inputs.telemetry_samples(spark, sf_dir), "P1D")
    newest = alerts.upsert_latest(daily, ["topic"], ["bucket"])
    return present(telemetry.compare(newest))


# --- streaming --------------------------------------------------------------------------------

#: Rows that arrive in one part of a table. Keyed state works its part off in Python, one task a key.
KEYED_ROWS, JVM_ROWS = 1_000_000, 10_000_000
ONE_PART = {"maxFilesPerTrigger": "1"}


def _arrivals(found: list[tuple[DataFrame, str, str]], late: int, rows: int) -> tuple[int, list[DataFrame]]:
    """Number of parts, and the tables with the part each row arrives in, up to ``late`` seconds after its time.

    All tables are cut at the same moments, into parts of about ``rows`` rows of them together.
    """
    spark = found[0][0].sparkSession
    timed = []
    for table, time, _ in found:
        arrives = F.unix_micros(time) + F.pmod(F.xxhash64(*table.columns), F.lit(late * 1_000_000))
        timed.append(table.withColumn("_arrives", F.coalesce(arrives.cast("double"), F.lit(0.0))))
    moments = timed[0].select("_arrives")
    for other in timed[1:]:
        moments = moments.unionByName(other.select("_arrives"))
    parts = max(2, -(-moments.count() // rows))
    cuts = sorted(set(moments.approxQuantile("_arrives", [i / parts for i in range(1, parts)], 0.1 / parts))) or [0.0]
    cutter = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_arrives", outputCol="_part")
    made = []
    for rows_in in timed:
        path = scratch_path(spark, "arrivals")
        dealt = cutter.transform(rows_in).withColumn("_part", F.col("_part").cast("int")).drop("_arrives")
        dealt.repartition("_part").write.partitionBy("_part").parquet(path)
        schema = T.StructType([*rows_in.drop("_arrives").schema.fields, T.StructField("_part", T.IntegerType())])
        made.append(spark.read.schema(schema).parquet(path))
    return len(cuts) + 1, made


def _feed(
    found: list[tuple[DataFrame, str, str]],
    begin: Callable[[], StreamingQuery],
    late: int = 20,
    rows: int = KEYED_ROWS,
    restart: bool = True,
    close: bool = False,
) -> None:
    """Give a query its input in the order of arrival, one file a part; half-way it ends and is resumed.

    Rows are out of order by up to ``late`` seconds. Rows of the last watermark delay stay in the state, as they
    would on a stream that goes on; with ``close`` it does go on: one later row follows, which stays there itself.
    """
    parts, tables_in = _arrivals(found, late, rows)
    for part in range(parts):
        if restart and part == parts // 2:
            begin().awaitTermination()
        for table, (_, _, source) in zip(tables_in, found, strict=True):
            table.where(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(source)
    if close:
        for table, time, source in found:
            newest = table.agg(F.max(time)).first()[0]
            if newest is not None:
                later = table.limit(1).withColumn(time, F.lit(newest) + F.expr("INTERVAL 1 HOUR"))
                later.coalesce(1).write.mode("append").parquet(source)
    begin().awaitTermination()


def _metric_records(spark: SparkSession, sf_dir: str, **feeding: bool) -> DataFrame:
    samples = stage_table(inputs.consumer_lag(spark, sf_dir), "consumer_lag")
    source, root = scratch_path(spark, "metrics_in"), scratch_path(spark, "metrics")

    def begin() -> StreamingQuery:
        stream = tables.stream_table(spark, source, samples.schema, options=ONE_PART)
        return keyed.start(keyed.metric_records(stream), "event_time", root)

    _feed([(samples, "poll_time", source)], begin, **feeding)
    return present(stages.output(spark, root, schemas.METRICS_FLATTENED))


@query
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition samples as a stream to complete metric records, with a restart in between."""
    return _metric_records(spark, sf_dir)


@query
def stream_metric_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records where the whole input is there at the start, down to the last poll."""
    return _metric_records(spark, sf_dir, restart=False, close=True)


@query
def stream_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows as a stream to the alerts of the window and correlation rules, down to the last row."""
    table = stage_table(inputs.metrics(spark, sf_dir).select(*jobs.FLAT_COLUMNS), "metrics")
    source, root = scratch_path(spark, "rules_in"), scratch_path(spark, "rules")
    _feed(
        [(table, "event_time", source)],
        lambda: stages.start(jobs.rules_stage(), tables.stream_table(spark, source, table.schema, options=ONE_PART), root),
        rows=JVM_ROWS,
        close=True,
    )
    return present(stages.output(spark, root, schemas.ALERTS).drop("context"))


@query
def stream_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows as a stream to the alerts of the correlation rule, counted in keyed state."""
    table = stage_table(inputs.metrics(spark, sf_dir).select(*jobs.FLAT_COLUMNS), "metrics")
    source, root = scratch_path(spark, "correlation_in"), scratch_path(spark, "correlation")

    def begin() -> StreamingQuery:
        stream = tables.stream_table(spark, source, table.schema, options=ONE_PART)
        return keyed.start(keyed.correlation(stream), "alert_time", root)

    _feed([(table, "event_time", source)], begin)
    return open_context(stages.output(spark, root, schemas.ALERTS), CORRELATION_CONTEXT)


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth poll sent again seven times: kept apart, unless still within the delay."""
    polls = inputs.polled(spark, sf_dir)
    source, root = scratch_path(spark, "late_in"), scratch_path(spark, "late")
    again = polls.where(inputs.epoch("event_time") % 500 == 0)
    for part in (polls, again.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(7)))).drop("_copy")):
        part.write.mode("append").parquet(source)
        keyed.split_late(tables.stream_table(spark, source, polls.schema), "event_time", root).awaitTermination()
    settled = stages.output(spark, root, polls.schema).agg(F.count(F.lit(1)).alias("settled"))
    late = stages.output(spark, root, polls.schema, "late").agg(F.count(F.lit(1)).alias("dropped"))
    return settled.select("settled", late.scalar().alias("dropped"))


@query
def stream_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts and enrichments as streams: each alert once, with its newest enrichment of ten minutes."""
    found = stage_table(inputs.alerts(spark, sf_dir), "alerts")
    enriched = stage_table(inputs.enriched_alerts(found), "enriched_alerts")
    left, right, root = (scratch_path(spark, n) for n in ("alerts_in", "enriched_in", "enriched"))

    def begin() -> StreamingQuery:
        rows = keyed.newest_enrichment(
            tables.stream_table(spark, left, found.schema, options=ONE_PART),
            tables.stream_table(spark, right, enriched.schema, options=ONE_PART),
        )
        return keyed.start(rows, "alert_time", root)

    _feed([(found, "alert_time", left), (enriched, "timestamp", right)], begin, late=8)
    return open_context(stages.output(spark, root, keyed.ENRICHED), LAG_UP_CONTEXT)


@query
def stream_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compacted table as its stream of changes leaves it."""
    log = stage_table(inputs.agent_memory(spark, sf_dir, time=True), "agent_memory")
    source, root = scratch_path(spark, "memory_in"), scratch_path(spark, "memory")

    def begin() -> StreamingQuery:
        return keyed.start(keyed.compacted(tables.stream_table(spark, source, log.schema, options=ONE_PART), "time"), "time", root)

    _feed([(log, "time", source)], begin)
    return alerts.compact(stages.output(spark, root, keyed.CHANGES).drop("time"))


@query
def sink_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows as a stream into the dated metrics table, with a restart in between."""
    table = stage_table(inputs.metrics(spark, sf_dir).select(*jobs.FLAT_COLUMNS), "metrics")
    source, root = scratch_path(spark, "metrics_in"), scratch_path(spark, "metrics_sink")

    def begin() -> StreamingQuery:
        stream = tables.stream_table(spark, source, table.schema, options=ONE_PART)
        return sinks.start(stream, "event_time", root, spread=["consumer_group"])

    _feed([(table, "event_time", source)], begin, rows=JVM_ROWS)
    return present(sinks.scan(spark, f"{root}/table", table.schema, "event_time"))


@query
def sink_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows as a stream through the threshold rule into the dated alert table, ids once."""
    table = stage_table(inputs.metrics(spark, sf_dir).select(*jobs.FLAT_COLUMNS), "metrics")
    twice = table.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("_copy")
    source, root = scratch_path(spark, "alerts_in"), scratch_path(spark, "alerts_sink")

    def begin() -> StreamingQuery:
        stream = tables.stream_table(spark, source, table.schema, options=ONE_PART)
        found = jobs.deduplicated(rules.threshold_lag_up(stream))
        return sinks.start(found, "alert_time", root)

    _feed([(twice, "event_time", source)], begin, late=8, rows=JVM_ROWS)
    return open_context(sinks.scan(spark, f"{root}/table", schemas.ALERTS, "alert_time"), LAG_UP_CONTEXT)


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed records as a stream, split into typed rows and a quarantine; records by reason."""
    records = stage_table(inputs.framed_records(spark, sf_dir), "framed")
    source, root = scratch_path(spark, "framed_in"), scratch_path(spark, "checked")

    def begin() -> StreamingQuery:
        stream = tables.stream_table(spark, source, records.schema, options=ONE_PART)
        return sinks.start_checked(
            stream, schemas.METRICS_SOURCE, schemas.METRICS_SOURCE_REQUIRED, "event_time", root, framed=True
        )

    _feed([(records, "event_time", source)], begin, rows=JVM_ROWS)
    kept = T.StructType([f for f in records.schema if f.name != "value"] + schemas.METRICS_SOURCE.fields)
    valid = sinks.scan(spark, f"{root}/table", kept, "event_time")
    reasoned = T.StructType([*records.schema.fields, T.StructField("reason", T.StringType())])
    bad = sinks.scan(spark, f"{root}/quarantine", reasoned, "event_time")
    nested = F.size("partitions").cast("long")
    return messages.quarantine_counts(bad).unionByName(
        valid.agg(F.lit("valid").alias("reason"), F.count(F.lit(1)).alias("records"))
    ).unionByName(valid.agg(F.lit("valid partitions").alias("reason"), F.sum(nested).alias("records")))


@query
def retention_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in a dated table, after the dates that ended more than seven days before its newest one were deleted."""
    events = inputs.simulator_events(spark, sf_dir).select("event_id", "event_time", "consumer_group")
    path = scratch_path(spark, "events_dated")
    sinks.write_batch(events, "event_time", path, 0, spread=["consumer_group"])
    sinks.drop_expired(spark, path)
    return present(sinks.scan(spark, path, events.schema, "event_time"))
