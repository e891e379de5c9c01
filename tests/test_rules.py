"""Scenario tables, boundaries and scalar traps."""

import json

import pytest
from pyspark.sql import functions as F
from tables import at, metric_rows, poll_rows

from lagwatch.functions import expr
from lagwatch.operators import alerts, correlate, feeds, forecast, rollup, rules, telemetry, velocity
from lagwatch.operators.baseline import collect_metrics


def kinds(df):
    return sorted(r[0] for r in df.select("severity").collect())


def test_quiet_data_raises_nothing(spark):
    quiet = metric_rows(spark, [{"t": 10 * i} for i in range(300)])
    found = rules.detect(
        quiet,
        [rules.lag_up_rule(), rules.lag_spike_rule(), rules.inactive_rule(), rules.rebalance_rule()],
    )
    assert found.isEmpty()
    assert correlate.correlation(quiet).isEmpty()
    for rule in (
        forecast.forecast_lag_up, forecast.forecast_speed_down, forecast.forecast_hot_partition
    ):
        assert rule(quiet).isEmpty()


def test_lag_spike(spark):
    rows = [{"t": 10 * i, "current_lag": 2000 + (37 * i) % 101 - 50, "lag_velocity": 1.0,
             "lag_24h_avg": 2000.0} for i in range(110)]
    rows.append({"t": 1100, "current_lag": 45_000, "lag_velocity": 43_000.0, "lag_24h_avg": 2391.0})
    table = metric_rows(spark, rows)
    (alert,) = rules.threshold_lag_up(table).collect()
    assert (alert.severity, alert.anomaly_score) == ("critical", 1.0)
    assert alert.alert_id == f"arima_lag_up_g_{1704067200 + 1100}"
    assert json.loads(alert.context)["lag_vs_avg_ratio"] == 18.82
    (alert,) = forecast.forecast_lag_up(table).collect()
    assert (alert.severity, alert.alert_time) == ("critical", at(1100))
    assert [r.alert_time for r in rules.threshold_lag_spike(table).collect()] == [at(1100)]


def test_slow_consumer(spark):
    rows = [{"t": 10 * i, "read_speed": 100.0 + (7 * i) % 11} for i in range(110)]
    rows += [{"t": 1100 + 10 * i, "read_speed": 10.0} for i in range(12)]
    found = forecast.forecast_speed_down(metric_rows(spark, rows)).orderBy("alert_time").collect()
    assert found[0].alert_time == at(1100)
    assert json.loads(found[0].context)["actual_speed"] == 10.0


def test_hot_partition(spark):
    rows = [{"t": 10 * i, "partition_skew_score": 1.0 + (i % 5) / 100, "partition_count": 6}
            for i in range(90)]
    rows.append({"t": 900, "partition_skew_score": 4.8, "partition_count": 6})
    (alert,) = forecast.forecast_hot_partition(metric_rows(spark, rows)).collect()
    assert alert.alert_time == at(900)
    assert alert.partition_skew_score == 4.8


def test_rows_kept_out_of_training(spark):
    rows = [{"t": 10 * i, "current_lag": 0 if i % 2 else 2000} for i in range(200)]
    rows.append({"t": 2000, "current_lag": 9000, "lag_velocity": 10.0})
    assert forecast.forecast_lag_up(metric_rows(spark, rows)).count() == 1
    assert forecast.forecast_lag_up(metric_rows(spark, rows[2:])).isEmpty()


@pytest.mark.parametrize("idle,fires", [(60, False), (61, True), (119, True), (120, False)])
def test_inactive_bounds(spark, idle, fires):
    table = metric_rows(
        spark, [{"t": 0, "read_speed": 5.0}, {"t": idle, "read_speed": 0.0, "current_lag": 700}]
    )
    found = rules.threshold_inactive(table).collect()
    assert bool(found) == fires
    if fires:
        context = json.loads(found[0].context)
        assert context["inactive_duration_seconds"] == idle
        assert context["lag_growth"] == 200


def test_inactive_needs_activity_in_the_frame(spark):
    rows = [{"t": 10 * i, "read_speed": 0.0} for i in range(30)]
    assert rules.threshold_inactive(metric_rows(spark, rows)).isEmpty()


def test_rebalance_storm(spark):
    rows = [{"t": 10 * i, "read_speed": 0.0 if i % 2 else 80.0} for i in range(19)]
    found = rules.rebalance_storm(metric_rows(spark, rows)).collect()
    assert [(a.alert_time, a.severity, a.anomaly_score) for a in found] == [
        (at(180), "critical", 0.9)
    ]


def test_gate_first_in_bucket_survives_jitter(spark):
    rows = [{"t": 13 + 17 * i, "read_speed": 0.0 if i % 2 else 80.0} for i in range(40)]
    table = metric_rows(spark, rows)
    found = rules.rebalance_storm(table, gate="first_in_bucket")
    slots = [int((a.alert_time - at(0)).total_seconds()) // 180 for a in found.collect()]
    assert len(slots) == len(set(slots)) >= 3


def test_single_row_has_no_variance(spark):
    one = metric_rows(spark, [{"t": 0, "read_speed": 0.0}])
    assert rules.rebalance_storm(one, min_zeros=1).count() == 1  # mean 0 decides
    assert rules.rebalance_storm(
        metric_rows(spark, [{"t": 0, "read_speed": 1.0}]), min_zeros=0
    ).isEmpty()


@pytest.mark.parametrize(
    "behind,severity,cause", [(2, "warning", "Mixed"), (4, "critical", "Likely producer")]
)
def test_correlation(spark, behind, severity, cause):
    rows = [{"t": 300, "consumer_group": f"g{i}", "is_falling_behind": i < behind,
             "lag_24h_avg": 0.0} for i in range(4)]
    (alert,) = correlate.correlation(metric_rows(spark, rows)).collect()
    context = json.loads(alert.context)
    assert alert.severity == severity
    assert alert.current_lag == 500 * behind
    assert context["root_cause"].startswith(cause)
    assert context["degrading_groups"] == ", ".join(f"g{i}" for i in range(behind))


def test_correlation_once_per_bucket(spark):
    rows = [{"t": 307 + 20 * i, "consumer_group": f"g{i % 2}", "is_falling_behind": True,
             "lag_24h_avg": 0.0} for i in range(30)]
    table = metric_rows(spark, rows)
    assert correlate.correlation(table).count() == 1  # only 607 lies in the first ten seconds
    found = correlate.correlation(table, gate="first_in_bucket").orderBy("alert_time").collect()
    assert [a.alert_time for a in found] == [at(327), at(607)]


def test_configured_rules(spark):
    table = metric_rows(spark, [{"t": 0, "current_lag": 60}])
    chosen = rules.configured(
        {"threshold_lag_spike": {"limit": 50}, "threshold_inactive": {"enabled": False}}
    )
    assert [r.detection_type for r in chosen] == ["THRESHOLD_LAG_SPIKE"]
    assert rules.detect(table, chosen).count() == 1


def test_correlation_window_edge(spark):
    def run(gap):
        rows = [{"t": 600 - gap, "consumer_group": "a", "is_falling_behind": True},
                {"t": 600, "consumer_group": "b", "is_falling_behind": True}]
        return correlate.correlation(metric_rows(spark, rows)).where("alert_time >= '2024-01-01 00:10:00'")

    assert run(300).count() == 1
    assert run(301).isEmpty()


def test_null_average(spark):
    table = metric_rows(spark, [{"t": 0, "current_lag": 5000, "lag_velocity": 1.0, "lag_24h_avg": 0.0}])
    (alert,) = rules.threshold_lag_up(table).collect()
    assert alert.anomaly_score is None
    assert json.loads(alert.context)["lag_vs_avg_ratio"] is None  # kept, not dropped


@pytest.mark.parametrize(
    "lags,score,spread",
    [([7], 0.0, 0), ([0, 0], 0.0, 0), ([10, 30], 1.5, 20), ([80, 4, 4, 4, 4, 4], 4.8, 76),
     ([100, 0, 0, 0, 0, 0], 5.0, 100)],
)
def test_skew(spark, lags, score, spread):
    rows = [("c", "g", "t", i, 0, lag, lag, at(0)) for i, lag in enumerate(lags)]
    table = spark.createDataFrame(
        rows,
        "cluster_id string, consumer_group string, topic string, partition_id int, "
        "current_offset bigint, log_end_offset bigint, lag bigint, poll_time timestamp",
    )
    (row,) = rollup.group_rollup(table).collect()
    assert row.partition_skew_score == pytest.approx(score)
    assert row.partition_skew == spread


def test_rollup_takes_the_first_topic(spark):
    rows = [("c", "g", t, p, 1, 3, 2, at(0)) for t, p in (("b", 0), ("a", 1), ("a", 0))]
    table = spark.createDataFrame(
        rows,
        "cluster_id string, consumer_group string, topic string, partition_id int, "
        "current_offset bigint, log_end_offset bigint, lag bigint, poll_time timestamp",
    )
    (row,) = rollup.group_rollup(table, partitions=True).collect()
    assert (row.topic, row.current_lag, row.partition_count) == ("a", 6, 3)
    assert [(p.partition_id, p.topic) for p in row.partitions] == [(0, "a"), (0, "b"), (1, "a")]
    assert rollup.group_rollup(table, per_topic=True).count() == 2
    assert rollup.explode_partitions(rollup.group_rollup(table, partitions=True)).count() == 3


def test_speeds(spark):
    polls = poll_rows(spark, [("g", 0, 100, 100), ("g", 10, 150, 300), ("g", 30, 90, 500)])
    found = velocity.group_speeds(polls).orderBy("event_time").collect()
    assert [(r.read_speed, r.write_speed) for r in found] == [(0.0, 0.0), (5.0, 20.0), (0.0, 10.0)]
    assert [r.time_to_catchup_seconds for r in found] == [0.0, 30.0, 0.0]


def test_equal_times_do_not_move_the_state(spark):
    polls = poll_rows(spark, [("g", 0, 0, 0), ("g", 10, 50, 50), ("g", 10, 70, 70), ("g", 20, 90, 90)])
    found = velocity.group_speeds(polls, tie=["total_log_end_offset"]).orderBy("event_time")
    assert [r.read_speed for r in found.collect()] == [0.0, 5.0, 4.0]


def test_velocity_modes_and_negative_lag(spark):
    source = metric_rows(
        spark,
        [{"t": 0, "current_lag": 10}, {"t": 5, "current_lag": -1}, {"t": 20, "current_lag": 50}],
    )
    for mode, expected in (("delta", [0.0, 40.0]), ("rate", [0.0, 2.0])):
        found = velocity.format_metrics(source, velocity=mode).orderBy("event_time").collect()
        assert [r.lag_velocity for r in found] == expected
    with pytest.raises(ValueError):
        velocity.velocity_column("other")


def test_average_includes_exactly_24_hours(spark):
    day = 86_400
    polls = poll_rows(spark, [("g", 0, 0, 90), ("g", day, 0, 30), ("g", day + 1, 0, 60)])
    found = collect_metrics(polls).orderBy("event_time").collect()
    assert [r.lag_24h_avg for r in found] == [90.0, 60.0, 45.0]


def test_scalars(spark):
    row = spark.range(1).select(
        expr.least_strict(F.lit(1.0), F.lit(None).cast("double")).alias("least"),
        expr.severity_class(F.lit(None).cast("string")).alias("none"),
        expr.severity_class(F.lit("HIGH")).alias("high"),
        expr.severity_class(F.lit("Low")).alias("low"),
        expr.parse_iso(F.lit("2024-01-01T00:00:01.5Z")).alias("time"),
        expr.parse_iso(F.lit("no time")).alias("bad"),
        expr.iso_utc(F.lit("2024-01-01 00:00:01").cast("timestamp")).alias("whole"),
        expr.iso_utc(F.lit("2024-01-01 00:00:01.25").cast("timestamp")).alias("part"),
        expr.deviation_percent(F.lit(5.0), F.lit(0.0)).alias("deviation"),
        expr.bucket(F.lit(-1), 10).alias("bucket"),
        expr.kilobytes(F.lit(1536)).alias("kb"),
        expr.non_negative(F.lit(-3.0)).alias("clamped"),
    ).first()
    assert row.least is None and row.bad is None and row.deviation is None
    assert (row.none, row.high, row.low) == ("medium", "high", "low")
    assert (row.whole, row.part) == ("2024-01-01T00:00:01Z", "2024-01-01T00:00:01.250000Z")
    assert (row.bucket, row.kb, row.clamped) == (-1, 1.5, 0.0)
    assert row.time.microsecond == 500_000


def test_enrichment_newest_wins_and_keeps_unmatched(spark):
    base = "alert_id string, severity string, alert_time timestamp"
    left = spark.createDataFrame([("a", "info", at(0)), ("b", "info", at(1))], base)
    right = spark.createDataFrame(
        [("a", "old", "LOW", at(5)), ("a", "new", None, at(9)), ("z", "x", "HIGH", at(9))],
        "alert_id string, diagnosis string, severity string, timestamp timestamp",
    )
    found = {r.alert_id: (r.diagnosis, r.severity) for r in alerts.enrich(left, right).collect()}
    assert found == {"a": ("new", "info"), "b": (None, "info")}


def test_compacted_table(spark):
    log = spark.createDataFrame(
        [("a", "1", 0, 0), ("a", "2", 0, 5), ("b", "1", 1, 1), ("b", None, 1, 2)],
        "key string, value string, partition int, offset bigint",
    )
    assert [(r.key, r.value) for r in alerts.compact(log).collect()] == [("a", "2")]


def test_latest_and_unknown_group(spark):
    table = metric_rows(
        spark, [{"t": 0}, {"t": 10, "current_lag": 7}, {"t": 5, "consumer_group": None}]
    )
    found = feeds.latest_per_group(table.select("consumer_group", "event_time", "current_lag"))
    assert {r.consumer_group: r.current_lag for r in found.collect()} == {"g": 7, "unknown": 500}


def test_rule_table_ignores_disabled(spark):
    table = metric_rows(spark, [{"t": 0, "current_lag": 60}, {"t": 10, "current_lag": 200}])
    config = [
        {"detector": "lag", "measure": "current_lag", "enabled": True, "critical": 100, "high": 50},
        {"detector": "off", "measure": "read_speed", "enabled": False, "critical": 0, "high": 0},
    ]
    assert kinds(rules.rule_table(table, config)) == ["critical", "high"]


def test_telemetry_grains(spark):
    samples = spark.createDataFrame(
        [("received_bytes", "t", at(1), 5.0), ("received_bytes", "t", at(59), 7.0),
         ("received_bytes", "t", at(61), 1.0), ("retained_bytes", "t", at(1), 9.0),
         ("retained_bytes", "t", at(30), 4.0)],
        "metric string, topic string, ts timestamp, value double",
    )
    minutes = telemetry.topic_telemetry(samples, "PT1M").orderBy("bucket").collect()
    assert [(r.received_bytes, r.retained_bytes, r.sent_bytes) for r in minutes] == [
        (12.0, 4.0, 0.0), (1.0, 0.0, 0.0)
    ]
    (hour,) = telemetry.topic_telemetry(samples, "PT1H").collect()
    assert hour.received_bytes == 13.0


def test_a_row_at_exactly_the_factor_is_no_spike(spark):
    speeds = [6.8, 29.1, 43.3, 41.0, 39.1, 3.2, 65.0]  # sum 227.5, twice the mean is 65.0; summed as doubles it is less
    metrics = metric_rows(spark, [{"t": 10 * i, "read_speed": s} for i, s in enumerate(speeds)])
    assert rules.moving_avg_spike(metrics).where(F.col("event_time") == F.lit(at(10 * (len(speeds) - 1)))).isEmpty()
    above = metric_rows(spark, [{"t": 10 * i, "read_speed": s} for i, s in enumerate([*speeds[:-1], speeds[-1] + 0.1])])
    assert rules.moving_avg_spike(above).where(F.col("event_time") == F.lit(at(10 * (len(speeds) - 1)))).count() == 1
    huge = metric_rows(spark, [{"t": 10 * i, "read_speed": s * 1e30} for i, s in enumerate([1.0, 1.0, 9.0])])
    assert [r.moving_avg for r in rules.moving_avg_spike(huge).collect()] == [pytest.approx(11e30 / 3)]
