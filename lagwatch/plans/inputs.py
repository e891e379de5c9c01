"""Input tables of the queries, derived by Spark from ``events.parquet``.

Events become polls on a 10-second grid per group, three partitions each (see FIXTURES.md). The
numbering and the running offsets use :func:`lagwatch.operators.timeline.running`, so the twelve
groups do not become twelve tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagwatch.functions.expr import iso_utc
from lagwatch.operators import baseline, rollup, rules
from lagwatch.operators import timeline as tl
from lagwatch.session import configure, stage_table
from lagwatch.sources import messages

CLUSTER = "cluster_1"
POLL_SECONDS = 10
START = "2024-01-01 00:00:00"
CHUNK_ROWS = 100_000

_lengths: dict[str, int] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def chunk_seconds(spark: SparkSession, sf_dir: str) -> int:
    """Chunk length for raw events, from the measured density of the table."""
    if sf_dir not in _lengths:
        _lengths[sf_dir] = tl.measured_seconds(events(spark, sf_dir), "ts", CHUNK_ROWS)
    return _lengths[sf_dir]


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk = tl.time_chunk(F.col("ts"), chunk_seconds(spark, sf_dir))
    return events(spark, sf_dir).withColumn(tl.CHUNK, chunk)


def _group(g: Column) -> Column:
    return F.concat(F.lit("group_"), g.cast("string"))


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition samples: steady, stalled (phase 3), spiking (5) and hot-partition (1) blocks."""
    source = _chunked(spark, sf_dir).select(
        (F.col("user_id") % 12).alias("g"), "ts", "event_id", "value", tl.CHUNK
    )
    volume = F.floor("value")
    polls = tl.running(source, ["g"], ["ts", "event_id"], number="n", sums={"volume": volume})
    block = F.call_function("div", F.col("n"), F.lit(10))
    now = F.struct("n", "value", "volume")
    polls = polls.select("g", block.alias("blk"), "n", now.alias("now"))
    opening = F.first("now").over(Window.partitionBy("g", "blk").orderBy("n"))
    polls = polls.withColumn("opening", opening)
    samples = polls.select(
        "g",
        ((F.col("blk") + F.col("g")) % 7).alias("ph"),
        "now",
        "opening",
        F.explode(F.sequence(F.lit(0), F.lit(2))).alias("p"),
    )

    def end_offset(at: str) -> Column:
        p1 = F.col("p") + 1
        return 1000 * p1 + F.col(f"{at}.volume") * p1 + 20 * F.col(f"{at}.n")

    def committed(at: str) -> Column:
        behind = (
            F.floor(F.col(f"{at}.value") * 3) * (F.col("p") + 1)
            + F.when(F.col("ph") == 5, 6000).otherwise(0)
            + F.when((F.col("ph") == 1) & (F.col("p") == 0), 9000).otherwise(0)
        )
        return F.greatest(end_offset(at) - behind, F.lit(0).cast("long"))

    start = F.unix_micros(F.to_timestamp(F.lit(START)))
    current = F.when(F.col("ph") == 3, committed("opening")).otherwise(committed("now"))
    return samples.select(
        F.lit(CLUSTER).alias("cluster_id"),
        _group(F.col("g")).alias("consumer_group"),
        F.concat(F.lit("topic_"), (F.col("g") % 3).cast("string")).alias("topic"),
        F.col("p").alias("partition_id"),
        current.alias("current_offset"),
        end_offset("now").alias("log_end_offset"),
        (end_offset("now") - current).alias("lag"),
        F.timestamp_micros(start + F.col("now.n") * POLL_SECONDS * tl.SECOND).alias("poll_time"),
    )


def group_polls(spark: SparkSession, sf_dir: str, partitions: bool = False) -> DataFrame:
    return rollup.group_rollup(consumer_lag(spark, sf_dir), partitions)


def polled(spark: SparkSession, sf_dir: str, partitions: bool = False) -> DataFrame:
    """Group polls as a written table.

    The rollup is the one step that reads every partition sample. The steps after it read its
    result more than once (the chunks and their carry), so it is kept instead of run again.
    """
    return stage_table(group_polls(spark, sf_dir, partitions), "group_polls")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collector output with derived columns; the percentile no rule reads is left out."""
    return baseline.collect_metrics(polled(spark, sf_dir))


def metrics_source(spark: SparkSession, sf_dir: str, partitions: bool = True) -> DataFrame:
    """Complete raw records: every baseline, nested partitions, ISO time text."""
    collected = baseline.collect_metrics(polled(spark, sf_dir, partitions))
    full = baseline.lag_percentile(collected)
    return full.withColumn("timestamp", iso_utc(F.col("event_time")))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.threshold_lag_up(metrics(spark, sf_dir))


def epoch(time: str = "alert_time") -> Column:
    return F.unix_seconds(time)


def enriched_alerts(found: DataFrame) -> DataFrame:
    """Enrichment of alerts at even epochs; a second, newer version where epoch / 10 is even."""
    base = found.where(epoch() % 2 == 0)
    versions = F.when(epoch() % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    numbered = base.withColumn("_v", F.explode(versions))
    return numbered.select(
        "alert_id",
        F.concat(F.lit("diagnosis "), F.col("_v").cast("string")).alias("diagnosis"),
        F.when(F.col("_v") == 2, "HIGH").alias("severity"),
        F.concat(F.lit("Scale "), F.col("consumer_group")).alias("recommended_action"),
        F.to_json(F.struct(F.col("current_lag"))).alias("metric_details"),
        F.timestamp_seconds(epoch() + F.col("_v")).alias("timestamp"),
    )


def alert_feedback(found: DataFrame) -> DataFrame:
    """'up' unless epoch / 10 divides by 3; a later opposite vote where it divides by 5."""
    tick = F.call_function("div", epoch(), F.lit(10))
    first = F.when(tick % 3 > 0, "up").otherwise("down")
    second = F.when(tick % 3 > 0, "down").otherwise("up")
    votes = F.array_compact(
        F.array(
            F.struct(first.alias("feedback"), F.lit(1).alias("delay")),
            F.when(tick % 5 == 0, F.struct(second.alias("feedback"), F.lit(60).alias("delay"))),
        )
    )
    return found.select("alert_id", epoch().alias("_at"), F.inline(votes)).select(
        "alert_id",
        "feedback",
        iso_utc(F.timestamp_seconds(F.col("_at") + F.col("delay"))).alias("timestamp"),
    )


def agent_memory(spark: SparkSession, sf_dir: str, time: bool = False) -> DataFrame:
    """Keyed log; every seventeenth record is a delete. ``time`` adds when it was written."""
    g = F.col("user_id") % 12
    return events(spark, sf_dir).select(
        _group(g).alias("key"),
        F.when(F.col("event_id") % 17 != 0, F.col("props")).alias("value"),
        (g % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        *([F.col("ts").alias("time")] if time else []),
    )


def simulator_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulator records, with the open keys ``phase`` and ``sequence_number``."""
    scenario = F.when(F.col("event_type") == "error", "rebalance_storm").when(
        F.col("event_type") == "purchase", "lag_spike"
    )
    g = F.col("user_id") % 12
    return events(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("event_time"),
        _group(g).alias("consumer_group"),
        F.concat(F.lit("topic_"), (g % 3).cast("string")).alias("topic"),
        F.floor("value").cast("int").alias("message_count"),
        messages.event_type(scenario).alias("event_type"),
        scenario.alias("scenario_name"),
        F.when(scenario.isNotNull(), F.concat(F.lit("run_"), F.col("user_id").cast("string"))).alias(
            "scenario_id"
        ),
        F.when(scenario == "lag_spike", "burst").alias("phase"),
        F.col("event_id").alias("sequence_number"),
    )


def event_json(records: DataFrame) -> Column:
    """JSON text of a simulator record; absent members are left out."""
    names = [c for c in records.columns if c not in ("event_id", "event_time")]
    return F.to_json(F.struct(iso_utc(F.col("event_time")).alias("timestamp"), *names))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three topics as key and JSON value, with offsets per (topic, partition)."""
    simulated = simulator_events(spark, sf_dir)
    table = polled(spark, sf_dir)
    found = stage_table(rules.threshold_lag_up(baseline.collect_metrics(table)), "alerts")

    def third(number: Column) -> Column:
        return (number % 3).cast("int").alias("partition")

    def tick(time: str) -> Column:
        return F.call_function("div", epoch(time), F.lit(10))

    published = simulated.select(
        F.lit("simulator_events").alias("topic"),
        third(F.col("event_id")),
        F.col("event_time").alias("time"),
        F.col("consumer_group").alias("key"),
        event_json(simulated).alias("value"),
    )
    published = published.unionByName(
        found.select(
            F.lit("velocity_anomaly_alerts").alias("topic"),
            third(tick("alert_time")),
            F.col("alert_time").alias("time"),
            F.col("alert_id").alias("key"),
            F.to_json(F.struct(*found.columns)).alias("value"),
        )
    ).unionByName(
        table.select(
            F.lit("metrics_source").alias("topic"),
            third(tick("event_time")),
            F.col("event_time").alias("time"),
            F.col("consumer_group").alias("key"),
            F.to_json(F.struct(*table.columns)).alias("value"),
        )
    )
    length = min(chunk_seconds(spark, sf_dir), tl.DAY)
    chunked = published.withColumn(tl.CHUNK, tl.time_chunk(F.col("time"), length))
    numbered = tl.running(chunked, ["topic", "partition"], ["time", "key"], number="_n")
    return numbered.select(
        "topic", "partition", (F.col("_n") - 1).alias("offset"), "key", "value"
    )


def wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON of raw metrics in which every 11th, 13th and 17th poll of a group is spoilt."""
    source = baseline.lag_percentile(baseline.collect_metrics(polled(spark, sf_dir, partitions=True)))
    tick = F.call_function("div", epoch("event_time"), F.lit(10))
    as_text = F.when(tick % 13 == 0, F.concat(F.lit("lag "), F.col("current_lag").cast("string")))
    record = F.struct(
        iso_utc(F.col("event_time")).alias("timestamp"),
        "cluster_id",
        "consumer_group",
        F.when(tick % 11 != 0, F.col("topic")).alias("topic"),
        "current_lag",
        "read_speed",
        "write_speed",
        "time_to_catchup_seconds",
        "partition_skew_score",
        "lag_24h_avg",
        "lag_percentile_95_24h",
        "partition_count",
        "partitions",
    )
    good = F.to_json(record)
    retyped = F.regexp_replace(
        good, r'"current_lag":\d+', F.concat(F.lit('"current_lag":"'), as_text, F.lit('"'))
    )
    value = F.when(tick % 17 == 0, F.substring(good, 1, 40)).otherwise(F.coalesce(retyped, good))
    return source.select(F.col("consumer_group").alias("key"), "event_time", value.alias("value"))


def framed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spoilt records in registry frames; every 19th frame is wrong, every 23rd partition list lacks a member."""
    records = wire_records(spark, sf_dir)
    tick = F.call_function("div", epoch("event_time"), F.lit(10))
    lacking = F.regexp_replace("value", r'"consumed_offset":\d+,', "")
    framed = messages.encode_framed(F.when(tick % 23 == 0, lacking).otherwise(F.col("value")), 3)
    wrong = F.concat(F.unhex(F.lit("7B")), framed)
    return records.withColumn("value", F.when(tick % 19 == 0, wrong).otherwise(framed))


def telemetry_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table (metric, topic, ts, value) with five metrics per topic."""
    received = F.floor(F.col("value") * 1024)
    source = _chunked(spark, sf_dir).select(
        F.concat(F.lit("topic_"), (F.col("user_id") % 7).cast("string")).alias("topic"),
        "ts",
        "event_id",
        "event_type",
        "value",
        tl.CHUNK,
    )
    summed = tl.running(source, ["topic"], ["ts", "event_id"], sums={"retained": received})

    def sample(metric: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"))

    samples = F.array(
        sample("received_bytes", received),
        sample("sent_bytes", F.floor(F.col("value") * 900)),
        sample("received_records", F.lit(1)),
        sample("sent_records", F.when(F.col("event_type") == "error", 0).otherwise(1)),
        sample("retained_bytes", F.col("retained")),
    )
    return summed.select("topic", "ts", F.inline(samples)).select("metric", "topic", "ts", "value")
