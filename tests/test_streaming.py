"""Streams equal the batch result: file counts, order, restarts, late and repeated rows."""

import pytest
from conftest import SF
from pyspark.sql import functions as F
from tables import at, same

from lagwatch import schemas
from lagwatch.operators import alerts, baseline, correlate, feeds, forecast, rollup, rules
from lagwatch.plans import inputs
from lagwatch.sources import tables
from lagwatch.streaming import jobs, stages

def flush():
    return F.to_timestamp(F.lit("2100-01-01 00:00:00"))


def append(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def run(stage, spark, source, schema, root, per_trigger=None):
    options = {"maxFilesPerTrigger": str(per_trigger)} if per_trigger else {}
    stream = tables.stream_table(spark, source, schema, options=options)
    query = stages.start(stage, stream, root)
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def samples(spark):
    """One group's polls over an hour and a half, with a pause of 30 hours near the end."""
    lag = inputs.consumer_lag(spark, SF).where("consumer_group in ('group_1', 'group_4')")
    late = F.col("poll_time") > at(700)
    moved = F.when(late, F.col("poll_time") + F.expr("INTERVAL 30 HOURS")).otherwise(F.col("poll_time"))
    return lag.withColumn("poll_time", moved).cache()


@pytest.fixture(scope="module")
def metrics(samples):
    return baseline.collect_metrics(rollup.group_rollup(samples)).select(*jobs.FLAT_COLUMNS).cache()


def test_rules_stream_restarts(spark, tmp_path, metrics):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for low, high in ((0, 400), (400, 10**9)):
        append(metrics.where(F.col("event_time").between(F.lit(at(low)), F.lit(at(high - 1)))), source)
        run(jobs.rules_stage(), spark, source, metrics.schema, root)
    append(metrics.limit(1).withColumn("event_time", flush()), source)
    run(jobs.rules_stage(), spark, source, metrics.schema, root)
    run(jobs.rules_stage(), spark, source, metrics.schema, root)  # nothing new
    by_group = rules.detect(
        metrics, [rules.lag_up_rule(), rules.inactive_rule(), rules.rebalance_rule()]
    )
    want = alerts.all_alerts(by_group, correlate.correlation(metrics))
    assert not want.isEmpty()
    assert same(want, stages.output(spark, root, schemas.ALERTS))


def test_forecast_stream_equals_batch(spark, tmp_path, metrics):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    bound = at(800)
    append(metrics.where(F.col("event_time") < F.lit(bound)), source)
    stage = jobs.forecast_stage()
    run(stage, spark, source, metrics.schema, root)
    append(metrics.where(F.col("event_time") >= F.lit(bound)), source)
    append(metrics.limit(1).withColumn("event_time", flush()), source)
    run(stage, spark, source, metrics.schema, root)
    got = stages.output(spark, root, schemas.ALERTS)
    want = forecast.forecast_lag_up(metrics)
    columns = ["alert_id", "severity", "current_lag"]
    assert same(want.select(*columns), got.select(*columns))


def test_failed_batch_is_replaced(spark, tmp_path, metrics):
    """Computing a batch a second time leaves the same files."""
    root = str(tmp_path / "out")
    stage = jobs.settled_stage("again")
    for _ in range(2):
        stages._compute(stage, root, metrics, 0)
    assert same(metrics, stages.output(spark, root, metrics.schema))


def test_feed_stats_and_deduplication(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame([("a", at(1)), ("a", at(1)), ("b", at(2))], "alert_id string, alert_time timestamp")
    append(df, source)
    out = str(tmp_path / "stats")
    events = tables.stream_table(spark, source, df.schema).withColumnRenamed("alert_time", "event_time")
    jobs.feed_stats(events, out, str(tmp_path / "c1")).awaitTermination()
    row = spark.read.parquet(out).first()
    assert (row.total_events, row.last_event_time) == (3, at(2))
    assert feeds.event_feed_stats(df.withColumnRenamed("alert_time", "event_time")).first() == row

    unique = jobs.deduplicated(tables.stream_table(spark, source, df.schema))
    path = str(tmp_path / "unique")
    unique.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c2")).trigger(
        availableNow=True
    ).start(path).awaitTermination()
    assert sorted(r.alert_id for r in spark.read.parquet(path).collect()) == ["a", "b"]
