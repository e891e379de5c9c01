"""Chunked operators equal the same operators over whole-key windows."""

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tables import at, START, same

from lagwatch.operators import alerts, baseline, correlate, forecast, rules, velocity
from lagwatch.operators import timeline as tl


@pytest.fixture(scope="module")
def polls(spark):
    """One group with most rows, a sparse one with gaps longer than a chunk, and peers in topics."""
    rng = random.Random(7)
    rows = []
    for group, count, step in (("hot", 1500, 10), ("warm", 400, 30), ("sparse", 40, 40_000)):
        t, consumed, end = 0, 0, 0
        for _ in range(count):
            t += rng.randint(1, 2 * step)
            end += rng.randint(0, 300)
            consumed = max(0, consumed + rng.choice([0, 0, rng.randint(-20, 400)]))
            rows.append(
                ("c", group, START + timedelta(seconds=t), f"t{len(group) % 2}", end - consumed,
                 consumed, end, 3, rng.random() * 4)
            )
    return spark.createDataFrame(
        rows,
        "cluster_id string, consumer_group string, event_time timestamp, topic string, "
        "current_lag bigint, total_current_offset bigint, total_log_end_offset bigint, "
        "partition_count int, partition_skew_score double",
    ).cache()


@pytest.fixture(scope="module")
def metrics(polls):
    return baseline.collect_metrics(polls).cache()


def whole():
    return Window.partitionBy("consumer_group").orderBy("event_time")


def whole_us():
    return Window.partitionBy("consumer_group").orderBy(F.unix_micros("event_time"))


@pytest.mark.parametrize("seconds", [60, 3600, 40 * tl.DAY])
def test_running(polls, seconds):
    chunked = polls.withColumn(tl.CHUNK, tl.time_chunk(F.col("event_time"), seconds))
    got = tl.running(
        chunked, ["consumer_group"], ["event_time"], number="n", sums={"s": F.col("current_lag")}
    ).drop(tl.CHUNK)
    want = polls.withColumn("n", F.row_number().over(whole()).cast("long")).withColumn(
        "s", F.sum("current_lag").over(whole())
    )
    assert same(got, want)


@pytest.mark.parametrize("seconds", [60, 3600, 40 * tl.DAY])
def test_previous_row_across_gaps(polls, seconds):
    got = velocity.with_previous(polls, ["event_time", "current_lag"], seconds=seconds)
    got = tl.own_rows(got.withColumn("p", F.col("_prev.current_lag")), "_prev")
    assert same(got, polls.withColumn("p", F.lag("current_lag").over(whole())))


@pytest.mark.parametrize("seconds", [3600, 4 * tl.DAY])
def test_average_equals_sliding_frame(polls, seconds):
    got = baseline.lag_average(polls, seconds=tl.DAY, chunk_seconds=seconds)
    frame = whole_us().rangeBetween(-tl.DAY * tl.SECOND, 0)
    want = polls.withColumn("lag_24h_avg", F.avg("current_lag").over(frame))
    joined = got.join(
        want.select("consumer_group", "event_time", F.col("lag_24h_avg").alias("w")),
        ["consumer_group", "event_time"],
    )
    assert joined.count() == polls.count()
    assert joined.where(F.abs(F.col("lag_24h_avg") - F.col("w")) > 1e-9).isEmpty()


def test_percentile_brute_force(polls):
    got = baseline.lag_percentile(polls, seconds=3600, chunk_seconds=1800).toPandas()
    assert len(got) == polls.count()
    for _, group in got.groupby("consumer_group"):
        group = group.sort_values("event_time")
        times = group["event_time"].to_numpy()
        lags = group["current_lag"].to_numpy()
        for i, found in enumerate(group["lag_percentile_95_24h"]):
            frame = np.sort(lags[: i + 1][times[: i + 1] >= times[i] - np.timedelta64(3600, "s")])
            assert found == frame[min(int(len(frame) * 0.95), len(frame) - 1)]


@pytest.mark.parametrize("n,index", [(1, 0), (19, 18), (20, 19), (21, 19), (100, 95)])
def test_percentile_index(n, index):
    values = np.arange(n)[::-1].copy()
    got = baseline.sliding_quantile(np.arange(n), values, 10**9, 0.95)
    assert got[-1] == np.sort(values)[index]


@pytest.mark.parametrize("seconds", [300, 7200])
def test_rules_do_not_depend_on_the_chunk(metrics, seconds):
    both = [rules.inactive_rule(), rules.rebalance_rule(min_zeros=1, bucket=20)]
    got = rules.detect(metrics, both, chunk_seconds=seconds)
    want = rules.detect(metrics, both, chunk_seconds=400 * tl.DAY)
    assert not want.isEmpty()
    assert same(got, want)


@pytest.mark.parametrize("block", [101, 500])
def test_moving_average_blocks(metrics, block):
    got = rules.moving_avg_spike(metrics, block=block)
    mean = F.avg("read_speed").over(whole().rowsBetween(-100, 0))
    want = metrics.withColumn("m", mean).where(F.col("read_speed") > F.col("m") * 2)
    key = ["consumer_group", "event_time"]
    assert same(got.select(*key), want.select(*key))


def test_forecast_blocks(metrics):
    def scored(block):
        found = forecast.forecast(metrics, "current_lag", chunk_rows=block)
        score = F.round("anomaly_data.anomaly_score", 6).alias("score")
        return found.select("consumer_group", "event_time", score)

    assert same(scored(128), scored(100_000))


@pytest.mark.parametrize("seconds", [300, 3600])
def test_correlation_counts_distinct_groups(spark, seconds):
    """Against a plain collect_set over the whole topic, with one group in two clusters."""
    rng = random.Random(3)
    rows = []
    for cluster, group in (("a", "g1"), ("b", "g1"), ("a", "g2"), ("a", "g3"), ("a", "g4")):
        for _ in range(200):
            rows.append(
                (START + timedelta(seconds=rng.randint(0, 1500) * 10), cluster, group, "t",
                 rng.randint(0, 9), 1.0, 1.0, 0.0, 1.0, 0.0, rng.choice([0.0, 0.0, 200.0]), False)
            )
    table = spark.createDataFrame(
        rows,
        "event_time timestamp, cluster_id string, consumer_group string, topic string, "
        "current_lag bigint, read_speed double, write_speed double, time_to_catchup_seconds double, "
        "partition_skew_score double, lag_24h_avg double, lag_velocity double, "
        "is_falling_behind boolean",
    ).dropDuplicates(["event_time", "cluster_id", "consumer_group"])
    got = correlate.correlation(table, bucket=20, chunk_seconds=seconds)
    frame = (
        Window.partitionBy("topic")
        .orderBy(F.unix_micros("event_time"))
        .rangeBetween(-300 * tl.SECOND, 0)
    )
    group = F.col("consumer_group")
    want = (
        table.withColumn("a", F.size(F.collect_set(F.when(correlate.degraded(), group)).over(frame)))
        .withColumn("n", F.size(F.collect_set(group).over(frame)))
        .where((F.col("a") >= 2) & (F.col("lag_velocity") > 100))
        .where(rules.in_gate(F.col("event_time"), 20))
        .groupBy("event_time", "cluster_id", "a", "n")
        .agg(F.sum("current_lag").alias("lag"))
    )
    found = got.select(
        F.col("alert_time").alias("event_time"),
        "cluster_id",
        F.get_json_object("context", "$.affected_groups").cast("int").alias("a"),
        F.get_json_object("context", "$.total_groups_on_topic").cast("int").alias("n"),
        F.col("current_lag").alias("lag"),
    )
    assert want.count() > 20
    assert same(found, want)


def test_alert_correlation_brute_force(metrics):
    found = rules.threshold_lag_up(metrics, min_lag=0, ratio=0.9).cache()
    got = alerts.correlate_alerts(found, lookback=120, chunk_seconds=300)
    times = found.select("topic", "alert_time").distinct()
    pairs = times.alias("t").join(
        found.select("topic", F.col("alert_time").alias("u"), "consumer_group").alias("a"), "topic"
    ).where("u between alert_time - interval 2 minutes and alert_time")
    want = (
        pairs.groupBy("topic", "alert_time")
        .agg(
            F.count(F.lit(1)).alias("recent_alerts"),
            F.array_sort(F.collect_set("consumer_group")).alias("correlated_groups"),
        )
        .where("recent_alerts >= 3")
    )
    assert not want.isEmpty()
    assert same(want, got)


def test_measured_seconds(polls):
    assert tl.measured_seconds(polls, "event_time", 1000) > tl.measured_seconds(
        polls, "event_time", 10
    )
    assert tl.measured_seconds(polls, "event_time", 1) >= 1


def test_clusters_are_separate_timelines(spark):
    """Like-named groups of two clusters give what each gives alone."""
    rows = [
        {"t": 10 * i, "cluster_id": c, "current_lag": lag + i, "total_current_offset": 100 * i,
         "total_log_end_offset": 100 * i + lag + i}
        for c, lag in (("a", 5), ("b", 5000))
        for i in range(6)
    ]
    polls = spark.createDataFrame(rows).select(
        "cluster_id", F.lit("g").alias("consumer_group"), F.timestamp_seconds("t").alias("event_time"),
        "current_lag", "total_current_offset", "total_log_end_offset",
    )

    def values(df):
        measured = baseline.lag_percentile(baseline.collect_metrics(df))
        columns = ("read_speed", "lag_velocity", "lag_24h_avg", "lag_percentile_95_24h")
        return {(r.cluster_id, r.event_time): tuple(r[c] for c in columns) for r in measured.collect()}

    alone = {}
    for cluster in ("a", "b"):
        alone |= values(polls.where(F.col("cluster_id") == cluster))
    assert values(polls) == alone and len(alone) == 12


@pytest.mark.parametrize(("lookback", "chunk"), [(60, 100), (120, 300), (120, 100_000), (7, 3_600)])
def test_correlated_groups_against_brute_force(spark, lookback, chunk):
    """Runs and gaps of many groups; null groups count as alerts but are no group, null topics are one topic."""
    rng = random.Random(lookback)
    rows = []
    for topic in ("a", "b", None):
        for group in ("g1", "g2", "g3", "g4", None):
            now = rng.randrange(50)
            for _ in range(40):
                now += rng.choice((1, 5, 20, lookback, lookback + 1, 5 * lookback))
                rows += [(topic, group, at(now))] * rng.choice((1, 1, 2))
    table = spark.createDataFrame(rows, "topic string, consumer_group string, alert_time timestamp")
    want = {}
    for topic, _, now in rows:
        near = [g for t, g, a in rows if t == topic and 0 <= (now - a).total_seconds() <= lookback]
        if len(near) >= 3:
            want[topic, now] = (len(near), sorted({g for g in near if g}))
    found = alerts.correlate_alerts(table, lookback=lookback, chunk_seconds=chunk).collect()
    assert len(found) == len(want)
    assert {(r.topic, r.alert_time): (r.recent_alerts, list(r.correlated_groups)) for r in found} == want


def test_correlated_groups_join_by_slices(spark):
    """No list over a frame: groups come from an equi-join, a long run of alerts is few intervals."""
    rows = [("t", "g", at(10 * i)) for i in range(2_000)]
    table = spark.createDataFrame(rows, "topic string, consumer_group string, alert_time timestamp")
    runs = alerts._presence(table, 300, 3_600)
    assert runs.count() == 6
    text = alerts.correlate_alerts(table)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert "collect_set" not in "".join(line for line in text.splitlines() if "Window [" in line)
