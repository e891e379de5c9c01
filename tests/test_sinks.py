"""Dated sinks: batches that run again, pruning, expiry, records split while streaming."""

import json
import os
from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T
from tables import START, at

from lagwatch.sources import messages, tables
from lagwatch.streaming import sinks

DAY = 86_400
ROWS = T.StructType([T.StructField("k", T.StringType()), T.StructField("t", T.TimestampType())])


def rows(spark, *days, key="a"):
    return spark.createDataFrame([(key, None if d is None else at(d * DAY + 5)) for d in days], ROWS)


def held(spark, path, **bounds):
    return sorted((r.t, r.k) for r in sinks.scan(spark, path, ROWS, "t", **bounds).where("t IS NOT NULL").collect())


def test_a_batch_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    assert held(spark, path) == []
    sinks.write_batch(rows(spark, 0, 1), "t", path, 0, ["k"])
    sinks.write_batch(rows(spark, 1, 2), "t", path, 1)
    before = held(spark, path)
    assert len(before) == 4
    sinks.write_batch(rows(spark, 1, 2), "t", path, 1)
    sinks.write_batch(rows(spark, 0, 1), "t", path, 0, ["k"])
    assert held(spark, path) == before
    sinks.write_batch(rows(spark), "t", path, 2)
    assert held(spark, path) == before


def test_bounds_prune_dates(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_batch(rows(spark, *range(6)), "t", path, 0)
    since, until = at(2 * DAY), at(4 * DAY)
    assert [t for t, _ in held(spark, path, since=since, until=until)] == [at(2 * DAY + 5), at(3 * DAY + 5)]
    scan = sinks.scan(spark, path, ROWS, "t", since, until)
    scan.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "event_date" in filters and ">=" in filters and "<=" in filters


def test_expired_dates_are_deleted(spark, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.drop_expired(spark, path) == []
    sinks.write_batch(rows(spark, 0, 1, 2, 8, 9, None), "t", path, 0)
    first = START.date()
    assert sinks.drop_expired(spark, path, 7) == [first, first + timedelta(days=1)]
    assert [t for t, _ in held(spark, path)] == [at(d * DAY + 5) for d in (2, 8, 9)]
    left = {name for name in os.listdir(path) if name.startswith("event_date=2")}
    assert left == {f"event_date={first + timedelta(days=d)}" for d in (2, 8, 9)}
    assert sinks.scan(spark, path, ROWS, "t").count() == 4  # rows without a time stay
    assert sinks.drop_expired(spark, path, 7) == []
    assert sinks.drop_expired(spark, path, 7, date(2030, 1, 1)) == [first + timedelta(days=d) for d in (2, 8, 9)]
    assert held(spark, path) == []


def test_stream_splits_records_across_restarts(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = T.StructType([T.StructField("n", T.LongType())])
    texts = [json.dumps({"n": 1}), json.dumps({"n": "1"}), "{", json.dumps({"n": 2})]
    for part, day in ((texts[:2], 0), (texts[2:], 1)):
        made = spark.createDataFrame([(t, at(day * DAY)) for t in part], "value string, t timestamp")
        framed = made.withColumn("value", messages.encode_framed(F.col("value"), 1))
        wrong = framed.limit(1).withColumn("value", F.unhex(F.lit("FF")))
        framed.union(wrong).write.mode("append").parquet(source)
        stream = tables.stream_table(spark, source, framed.schema)
        sinks.start_checked(stream, schema, {"n": "integer"}, "t", root, framed=True).awaitTermination()
    kept = T.StructType([T.StructField("t", T.TimestampType()), *schema])
    assert {(r.t, r.n) for r in sinks.scan(spark, f"{root}/table", kept, "t").collect()} == {(at(0), 1), (at(DAY), 2)}
    bad = sinks.scan(spark, f"{root}/quarantine", T.StructType([*kept.fields[:1], T.StructField("reason", T.StringType())]), "t")
    reasons = sorted((r.reason, r.t) for r in bad.collect())
    assert reasons == [("frame", at(0)), ("frame", at(DAY)), ("malformed", at(DAY)), ("type:n", at(0))]
