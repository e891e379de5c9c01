"""Input of the registered streams in bounded parts, files per date, what passes the percentile unread."""

import os

from conftest import SF
from pyspark.sql import functions as F
from tables import at, same

import __spark_entry__ as entry
from lagwatch import schemas
from lagwatch.operators import baseline
from lagwatch.plans import catalog, inputs
from lagwatch.sources import tables
from lagwatch.streaming import keyed, sinks, stages


def test_parts_are_bounded_and_in_the_order_of_arrival(spark):
    rows = [(i, at(i // 3)) for i in range(9_000)]
    table = spark.createDataFrame(rows, "n long, t timestamp")
    other = table.where("n % 7 = 0").withColumnRenamed("t", "u")
    parts, (left, right) = catalog._arrivals([(table, "t", ""), (other, "u", "")], 20, 1_000)
    assert parts == 11
    assert same(left.drop("_part"), table) and same(right.drop("_part"), other)
    both = left.unionByName(right.withColumnRenamed("u", "t")).groupBy("_part")
    bounds = sorted(both.agg(F.count("n").alias("c"), F.min("t").alias("low"), F.max("t").alias("high")).collect())
    assert max(b.c for b in bounds) < 1_300
    for before, after in zip(bounds, bounds[1:], strict=False):
        assert (before.high - after.low).total_seconds() < 20  # less than any watermark delay: nothing is late
    assert catalog._arrivals([(table.limit(0), "t", "")], 20, 1_000)[1][0].isEmpty()


def test_streams_that_go_on_give_every_row(spark):
    polls = inputs.polled(spark, SF).cache()
    assert entry.queries()["stream_metric_record"](spark, SF).count() == polls.count()
    newest = polls.agg(F.max("event_time")).first()[0]
    assert newest.strftime("%Y-%m-%dT%H:%M:%SZ") in {
        r.event_time for r in entry.queries()["stream_metric_record"](spark, SF).select("event_time").collect()
    }


def test_a_date_has_few_files(spark, tmp_path):
    rows = spark.range(4_000).select("id", F.timestamp_seconds(F.col("id") * 40 + 1_704_067_200).alias("t")).repartition(40)
    stages.write_dated(rows, "t", str(tmp_path / "a"), 0)
    sinks.write_batch(rows, "t", str(tmp_path / "b"), 0)
    for name in ("a", "b"):
        files = [f for _, _, found in os.walk(tmp_path / name) for f in found if f.endswith(".parquet")]
        assert spark.read.parquet(str(tmp_path / name)).count() == 4_000
        assert len(files) <= 2 * stages.PARTS_OF_A_DATE


def test_alerts_share_keys(spark, tmp_path):
    left, right, root = (str(tmp_path / n) for n in ("a", "e", "out"))
    found = [(f"a{i}", at(i), "x", "info", "c", "g", "t", i, 1.0, 2.0, 3.0, 0.5, 0.25, "{}") for i in range(300)]
    spark.createDataFrame(found, schemas.ALERTS).coalesce(1).write.parquet(left)
    more = [(f"a{i}", f"d{i}", None, "r", None, at(i + 1)) for i in range(0, 300, 2)]
    spark.createDataFrame(more, schemas.ENRICHED_ALERTS).coalesce(1).write.parquet(right)
    rows = keyed.newest_enrichment(
        tables.stream_table(spark, left, schemas.ALERTS), tables.stream_table(spark, right, schemas.ENRICHED_ALERTS),
        within=60, buckets=4,
    )
    query = keyed.start(rows, "alert_time", root)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    got = {r.alert_id: r.diagnosis for r in stages.output(spark, root, keyed.ENRICHED).collect()}
    assert got == {f"a{i}": f"d{i}" if i % 2 == 0 else None for i in range(300 - 1 - 70 + 1)}


def test_nested_columns_pass_the_percentile_unconverted(spark):
    polls = inputs.group_polls(spark, SF, partitions=True).limit(50).cache()
    made = baseline.lag_percentile(polls)
    assert "FlatMapGroupsInArrow" in made._jdf.queryExecution().executedPlan().toString()
    assert same(made.drop("lag_percentile_95_24h"), polls)
