"""Keyed-state streams: equal to batch across restarts, bounded by their windows, evicted when idle."""

from __future__ import annotations

import random
from datetime import timedelta, timezone

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F
from tables import at, metric_rows, same

from lagwatch import schemas
from lagwatch.operators import alerts, baseline, correlate, rollup
from lagwatch.operators.registry import DETECTORS, run_configured
from lagwatch.plans import inputs
from lagwatch.sources import tables
from lagwatch.streaming import keyed, stages

LAG = "cluster_id string, consumer_group string, topic string, partition_id int, current_offset long, log_end_offset long, lag long, poll_time timestamp"


def append(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def polls(seed, group, count, step):
    """Polls of two partitions, ``step`` seconds apart on average."""
    rng, rows, t, ends = random.Random(seed), [], 0, [1_000, 2_000]
    for _ in range(count):
        t += rng.randint(step // 2, step * 3 // 2)
        for p in (0, 1):
            ends[p] += rng.randint(0, 500)
            lag = rng.choice([0, 5, 5, 40, rng.randint(0, 900)])
            rows.append(("c", group, f"t{p}", p, ends[p] - lag, ends[p], lag, at(t)))
    return rows


def run_metrics(spark, source, schema, root, **parameters):
    query = keyed.start(keyed.metric_records(tables.stream_table(spark, source, schema), **parameters), "event_time", root)
    query.awaitTermination()
    return query


def test_records_beyond_24_hours_equal_batch_across_restarts(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = polls(1, "a", 260, 1_200) + polls(2, "b", 200, 1_500)  # three days and more
    samples = spark.createDataFrame(rows, LAG)
    for low, high in ((0, 90_000), (90_000, 200_000), (200_000, 10**7)):
        part = samples.where(F.col("poll_time").between(F.lit(at(low)), F.lit(at(high) - timedelta(microseconds=1))))
        append(part, source)
        append(samples.where(F.col("poll_time") <= F.lit(at(9_000))), source)  # delivered again, or late
        run_metrics(spark, source, samples.schema, root)
    end = max(r[-1] for r in rows) - timedelta(seconds=30)
    want = baseline.lag_percentile(baseline.collect_metrics(rollup.group_rollup(samples)))
    want = want.where(F.col("event_time") <= F.lit(end))
    found = stages.output(spark, root, schemas.METRICS_FLATTENED)
    assert same(found, want)
    older = want.alias("w").join(want.alias("v"), F.expr("w.consumer_group = v.consumer_group AND v.event_time < w.event_time - INTERVAL 24 HOURS"), "left_semi")
    assert older.count() > want.count() / 2  # most rows have an expired one behind them


def test_the_window_equals_the_sliding_quantile():
    rng = np.random.default_rng(8)
    times = np.cumsum(rng.integers(1, 50, 3_000))
    values = rng.integers(0, 60, 3_000)
    window = keyed.Window(2_000)
    got, means = [], []
    for i, (t, v) in enumerate(zip(times.tolist(), values.tolist(), strict=True)):
        if i == 1_500:  # as after a restart
            kept = [np.frombuffer(x, np.int64).tolist() for x in window.kept()]
            assert len(kept[0]) == len(window.ascending) < 200
            window = keyed.Window(2_000, *kept)
        window.add(t, v)
        got.append(window.quantile(0.95))
        means.append(window.mean())
    assert got == baseline.sliding_quantile(times, values, 2_000, 0.95).tolist()
    for i in (0, 700, 2_999):
        inside = values[: i + 1][times[: i + 1] >= times[i] - 2_000]
        assert means[i] == pytest.approx(inside.mean())


def test_idle_groups_are_evicted_and_state_does_not_grow(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    samples = spark.createDataFrame(polls(1, "idle", 5, 10) + polls(2, "busy", 800, 60), LAG)
    held, sizes = [], []
    for low, high in ((0, 10_000), (10_000, 20_000), (20_000, 30_000), (30_000, 10**6)):
        append(samples.where(F.col("poll_time").between(F.lit(at(low)), F.lit(at(high - 1)))), source)
        query = run_metrics(spark, source, samples.schema, root, seconds=600, idle_seconds=20_000)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        sizes.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert held == [2, 2, 1, 1]
    assert sum(sizes) == samples.count()  # every sample is read once, history never again
    assert stages.output(spark, root, schemas.METRICS_FLATTENED).where("consumer_group = 'idle'").count() == 5


def test_state_is_bounded_by_the_window():
    history = keyed.GroupHistory(600, None)
    sizes = []
    for i in range(5_000):
        history.waiting[i * 10_000_000] = {("t", 0): (i, i + 5, 5)}
        list(history.due(i * 10_000_000, 0.95))
        history = keyed.GroupHistory(600, history.kept())
        sizes.append(len(history.kept()))
    assert max(sizes[100:]) - min(sizes[100:]) < 40


def test_late_rows_are_kept_apart_over_many_batches(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "event_time timestamp, n int"
    for batch in range(6):
        rows = [(at(batch * 100), batch)] + ([(at(1), 99)] * 7 + [(at(batch * 100 - 120), 98), (None, 97)] if batch else [])
        append(spark.createDataFrame(rows, schema), source)
        append(spark.createDataFrame([(at(batch * 100 - 20), 96)], schema), source)  # within the delay
        stream = tables.stream_table(spark, source, spark.createDataFrame([], schema).schema)
        keyed.split_late(stream, "event_time", root).awaitTermination()
    late = stages.read_dated(spark, f"{root}/late", "_date=*", spark.createDataFrame([], schema).schema)
    counts = {(r._batch, r.n): r["count"] for r in late.groupBy("_batch", "n").count().collect()}
    assert all(counts[(b, 99)] == 7 for b in range(2, 6))
    assert not any(n in (96, 97) for _, n in counts)
    rows = stages.output(spark, root, spark.createDataFrame([], schema).schema)
    assert rows.where("n = 96").count() == 6 and rows.where("n = 97").count() == 5


def alert(i, t):
    return (f"a{i}", at(t), "x", "info", "c", "g", "t", 5 * i, 1.0, 2.0, 3.0, 0.5, 0.25, '{"k":1}')


def test_the_newest_enrichment_wins_once(spark, tmp_path):
    left, right, root = (str(tmp_path / n) for n in ("a", "e", "out"))
    found = spark.createDataFrame([alert(1, 0), alert(2, 1), alert(3, 2), alert(1, 0), alert(9, 90_000)], schemas.ALERTS)
    more = [
        ("a1", "first", "HIGH", "r1", None, at(60)), ("a1", "second", None, "r2", "{}", at(120)),
        ("a2", "too late", "HIGH", "r", None, at(700)), ("a7", "no alert", None, "r", None, at(5)),
        ("a3", "tie b", None, "r", None, at(30)), ("a3", "tie a", "LOW", "r", None, at(30)),
    ]
    enriched = spark.createDataFrame(more, schemas.ENRICHED_ALERTS)
    held = []
    for low, high in ((0, 100), (100, 10**6)):
        append(found.where(F.col("alert_time").between(F.lit(at(low)), F.lit(at(high - 1)))), left)
        append(enriched.where(F.col("timestamp").between(F.lit(at(low)), F.lit(at(high - 1)))), right)
        rows = keyed.newest_enrichment(
            tables.stream_table(spark, left, found.schema), tables.stream_table(spark, right, enriched.schema)
        )
        query = keyed.start(rows, "alert_time", root)
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = {r.alert_id: (r.severity, r.diagnosis, r.recommended_action) for r in stages.output(spark, root, keyed.ENRICHED).collect()}
    assert got == {"a1": ("info", "second", "r2"), "a2": ("info", None, None), "a3": ("info", "tie b", "r")}
    assert held[-1] == 1  # the alert whose bound has not passed


def test_deletes_have_a_lifetime(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "key string, value string, partition int, offset long, time timestamp"
    hour = 3_600
    steps = [
        [("a", "1", 0, 1, at(0)), ("b", "1", 0, 2, at(0)), ("a", None, 0, 3, at(10))],
        [("a", "old", 0, 2, at(20)), ("b", "2", 0, 5, at(hour)), ("b", "1", 0, 4, at(hour))],
        [("c", "1", 1, 1, at(30 * hour))],
        [("c", "2", 1, 2, at(31 * hour))],
    ]
    held = []
    for step in steps:
        append(spark.createDataFrame(step, schema), source)
        stream = tables.stream_table(spark, source, spark.createDataFrame([], schema).schema)
        query = keyed.start(keyed.compacted(stream, "time"), "time", root)
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    changes = stages.output(spark, root, keyed.CHANGES)
    assert sorted((r.key, r.value or "", r.offset) for r in changes.collect()) == [
        ("a", "", 3), ("b", "1", 2), ("b", "2", 5), ("c", "1", 1), ("c", "2", 2)
    ]
    assert held == [2, 2, 2, 2]  # a's delete is gone a day later, when c has come
    log = spark.createDataFrame([r for s in steps for r in s], schema).drop("time")
    assert same(alerts.compact(log), alerts.compact(changes.drop("time")))


def test_streams_of_the_small_table(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    samples = inputs.consumer_lag(spark, SF).where("consumer_group in ('group_1', 'group_4')").cache()
    append(samples, source)
    run_metrics(spark, source, samples.schema, root)
    found = stages.output(spark, root, schemas.METRICS_FLATTENED)
    assert found.columns == schemas.METRICS_FLATTENED.fieldNames()
    assert found.where("lag_percentile_95_24h is null").isEmpty()


def test_correlation_counts_equal_batch_out_of_order(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    rng = random.Random(5)
    rows = []
    for t in range(0, 3_600, 10):
        for g in range(7):
            if rng.random() < 0.5:
                bad = rng.random() < 0.15
                rows.append({
                    "t": t, "consumer_group": f"g{g}", "topic": f"t{g % 2}", "cluster_id": f"c{g % 3 % 2}",
                    "current_lag": rng.randint(0, 900), "lag_velocity": 200.0 if bad else 0.0,
                    "is_falling_behind": rng.random() < 0.1, "read_speed": float(rng.randint(240, 400)),
                })
    metrics = metric_rows(spark, rows).drop("lag_percentile_95_24h")
    arrives = F.unix_seconds("event_time") + F.pmod(F.xxhash64("event_time", "consumer_group"), F.lit(25))
    ordered = metrics.withColumn("_arrives", arrives).cache()
    start = int(at(0).replace(tzinfo=timezone.utc).timestamp())
    for low, high in ((0, 1_000), (1_000, 1_007), (1_007, 2_500), (2_500, 9_000)):
        part = ordered.where(F.col("_arrives").between(start + low, start + high - 1)).drop("_arrives")
        append(part.union(part.limit(2)), source)  # some are delivered twice
        rows_in = tables.stream_table(spark, source, metrics.schema)
        keyed.start(keyed.correlation(rows_in, min_groups=3, bucket=60), "alert_time", root).awaitTermination()
    end = at(max(r["t"] for r in rows) - 30)
    want = correlate.correlation(metrics, min_groups=3, bucket=60).where(F.col("alert_time") <= F.lit(end))
    found = stages.output(spark, root, schemas.ALERTS)
    assert want.count() > 10
    exact = [c for c in want.columns if c not in ("read_speed", "write_speed", "partition_skew_score")]
    assert same(found.select(*exact), want.select(*exact))


def test_presence_expires_in_order():
    present = keyed.Present(100)
    for group, time in (("a", 0), ("b", 50), ("a", 90)):
        present.see(group, time)
    assert [present.count(t) for t in (90, 150, 151, 190, 191)] == [2, 2, 1, 1, 0]
    assert keyed.Present(100, {"a": 5}).count(105) == 1


def test_configured_detectors(spark):
    metrics = metric_rows(spark, [{"t": 10 * i, "current_lag": 50_000, "lag_velocity": 5.0} for i in range(20)])
    found = run_configured(metrics, {
        "threshold_lag_spike": {"limit": 20_000}, "threshold_lag_up": {"min_lag": 5}, "correlation": {"enabled": False},
        "rule_table": {"rules": [{"detector": "d", "measure": "current_lag", "enabled": True, "critical": 9, "high": 1}]},
        "moving_avg_spike": {"value": "read_speed"},
    })
    assert set(found) == {"group_rules", "rule_table", "moving_avg_spike"}
    assert {r.detection_type for r in found["group_rules"].collect()} == {"THRESHOLD_LAG_SPIKE", "arima_lag_up"}
    assert found["rule_table"].count() == 20
    assert len(DETECTORS) == 10
    with pytest.raises(ValueError, match="unknown detectors: nothing"):
        run_configured(metrics, {"nothing": {}})
