"""Plans: nothing that turns a key into one task, a table into a broadcast, a row into Python."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lagwatch.operators import baseline, correlate, feeds, rules, telemetry, velocity
from lagwatch.plans import inputs
from lagwatch.session import stage_table


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "1000")
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark):
    return stage_table(inputs.metrics(spark, SF), "plan_metrics")


@pytest.fixture(scope="module")
def polls(spark):
    return inputs.polled(spark, SF)


STREAMS = {"stream_metrics", "stream_rules", "stream_late_rows"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STREAMS))
def test_no_pairs_and_no_single_partition(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_threshold_rule_is_a_filtered_scan(table):
    text = plan(rules.threshold_lag_up(table))
    assert "Exchange" not in text
    assert "GreaterThan(current_lag,1000)" in text
    assert "lag_velocity" in text and "total_log_end_offset" not in text


def test_group_rules_share_one_exchange(table):
    text = plan(rules.detect(table, [rules.lag_up_rule(), rules.inactive_rule(), rules.rebalance_rule()]))
    assert text.count("Exchange hashpartitioning(cluster_id") == 1
    assert "_chunk" in text.split("Exchange hashpartitioning(")[1][:60]
    assert text.count("Sort [") == 1


def test_windows_are_partitioned_by_chunk(table, polls):
    for df in (
        baseline.collect_metrics(polls),
        velocity.format_metrics(table.withColumn("lag_percentile_95_24h", F.lit(0.0))),
        correlate.correlation(table),
    ):
        for line in plan(df).splitlines():
            # windows over the summary carry one row per chunk and order by it
            if "Window [" in line:
                assert "_chunk" in line


def test_rank_limit_before_the_shuffle(spark):
    bucketed = telemetry.topic_telemetry(inputs.telemetry_samples(spark, SF), "PT1H")
    assert "WindowGroupLimit" in plan(telemetry.last_points(bucketed))


def test_feeds_take_ordered(table):
    assert "TakeOrderedAndProject" in plan(feeds.recent(table, 100, ["event_time", "consumer_group"]))
