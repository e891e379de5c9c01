"""Decoding, schema checks, table definitions."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagwatch import schemas
from lagwatch.functions.expr import json_object
from lagwatch.operators import feeds
from lagwatch.sources import messages, tables
from tables import at

REQUIRED = {"name": "string", "size": "integer", "rate": "number", "on": "boolean", "parts": "array"}
GOOD = '{"name":"x","size":3,"rate":1.5,"on":true,"parts":[{"size":"s"}]}'


def test_reasons(spark):
    cases = {
        GOOD: None,
        GOOD.replace("1.5", "2"): None,
        GOOD.replace("1.5", "1e3"): None,
        GOOD.replace('"size":3', '"size":"3"'): "type:size",
        GOOD.replace('"size":3,', ""): "missing:size",
        GOOD.replace('"name":"x"', '"name":5'): "type:name",
        GOOD.replace('"on":true', '"on":null'): "type:on",
        GOOD.replace('[{"size":"s"}]', "{}"): "type:parts",
        GOOD[:20]: "malformed",
        "[1]": "malformed",
        "": "malformed",
    }
    df = spark.createDataFrame([(text,) for text in cases], "value string")
    found = {r.value: r.reason for r in messages.check(df, REQUIRED).collect()}
    assert found == cases


def minimal(required):
    """The least record that the table accepts."""
    least = {"string": "x", "integer": 0, "number": 0.5, "boolean": False}
    return {name: [minimal(kind[0])] if isinstance(kind, list) else least[kind] for name, kind in required.items()}


def test_bootstrap_record_is_valid(spark):
    record = json.dumps(minimal(schemas.METRICS_FLATTENED_REQUIRED) | {"event_time": "2024-01-01T00:00:00Z"})
    df = spark.createDataFrame([(record,)], "value string")
    valid, bad = messages.validate(
        df, schemas.METRICS_FLATTENED, schemas.METRICS_FLATTENED_REQUIRED
    )
    assert bad.isEmpty()
    assert valid.first().event_time == at(0)


NESTED = {"id": "string", "parts": [{"n": "integer", "inner": [{"on": "boolean"}]}]}


def test_reasons_inside_arrays(spark):
    good = {"id": "x", "parts": [{"n": 1, "inner": [{"on": True}]}, {"n": 2, "inner": []}]}

    def spoilt(change):
        record = json.loads(json.dumps(good))
        change(record)
        return json.dumps(record)

    cases = {
        json.dumps(good): None,
        spoilt(lambda r: r.update(parts=[])): None,
        spoilt(lambda r: r["parts"][1].pop("n")): "missing:parts[].n",
        spoilt(lambda r: r["parts"][1].update(n="2")): "type:parts[].n",
        spoilt(lambda r: r["parts"].append(7)): "type:parts[]",
        spoilt(lambda r: r["parts"].append(None)): "type:parts[]",
        spoilt(lambda r: r["parts"][0]["inner"].append({})): "missing:parts[].inner[].on",
        spoilt(lambda r: r["parts"][0]["inner"].append([])): "type:parts[].inner[]",
        spoilt(lambda r: r["parts"][0].update(inner=3)): "type:parts[].inner",
        spoilt(lambda r: (r.pop("id"), r["parts"][0].pop("n"))): "missing:id",
        spoilt(lambda r: r.update(parts=None)): "type:parts",
    }
    df = spark.createDataFrame([(text,) for text in cases], "value string")
    assert {r.value: r.reason for r in messages.check(df, NESTED).collect()} == cases


def test_every_declared_member_is_required(spark):
    required = schemas.METRICS_SOURCE_REQUIRED
    least = minimal(required)
    lacking = {f"missing:{name}": {k: v for k, v in least.items() if k != name} for name in required}
    for name in schemas.PARTITION_DETAIL_REQUIRED:
        part = {k: v for k, v in least["partitions"][0].items() if k != name}
        lacking[f"missing:partitions[].{name}"] = least | {"partitions": [part]}
    rows = [(reason, json.dumps(record)) for reason, record in lacking.items()]
    df = spark.createDataFrame([*rows, (None, json.dumps(least))], "want string, value string")
    valid, bad = messages.validate(df, schemas.METRICS_SOURCE, required)
    assert {(r.want, r.reason) for r in bad.collect()} == {(w, w) for w in lacking}
    assert valid.count() == 1


def test_frames(spark):
    text = json.dumps(minimal(NESTED)).encode()
    cases = [
        (b"\x00\x00\x00\x00\x07" + text, None),
        (b"\x01\x00\x00\x00\x07" + text, "frame"),
        (text, "frame"),
        (b"\x00\x00\x07", "frame"),
        (b"", "frame"),
        (None, "frame"),
        (b"\x00\x00\x00\x00\x07", "malformed"),
        (b"\x00\x00\x00\x00\x07{", "malformed"),
    ]
    df = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate(cases)], "i int, value binary, want string")
    assert all(r.reason == r.want for r in messages.check(df, NESTED, framed=True).collect())
    back = messages.decode_framed(df, T.StructType([T.StructField("id", T.StringType())]))
    assert {r.i: (r.schema_id, r.id) for r in back.collect()} == {
        i: (7 if w != "frame" else None, "x" if w is None else None) for i, (_, w) in enumerate(cases)
    }


def test_dispatch_leaves_out_what_is_no_object(spark):
    values = ['{"a":1}', "{}", "{", "[]", "3", "", None]
    df = spark.createDataFrame([("t", 0, i, "k", v) for i, v in enumerate(values)], schemas.RAW_MESSAGES)
    rows = messages.dispatch(df, "t", T.StructType([T.StructField("a", T.LongType())])).collect()
    assert {(r._offset, r.a) for r in rows} == {(0, 1), (1, None)}


def test_framed_round_trip(spark):
    schema = "a int, b string"
    df = spark.createDataFrame([(1, "x"), (2, None)], schema)
    framed = df.select(messages.encode_framed(F.to_json(F.struct("a", "b")), 300).alias("value"))
    assert bytes(framed.first().value)[:5] == b"\x00\x00\x00\x01\x2c"
    back = messages.decode_framed(framed, df.schema)
    assert {(r.a, r.b, r.schema_id) for r in back.collect()} == {(1, "x", 300), (2, None, 300)}


def test_open_schema(spark):
    text = '{"timestamp":"t","consumer_group":"g","message_count":2,"phase":"burst","n":7}'
    (row,) = messages.parse_event(spark.createDataFrame([(text,)], "value string")).collect()
    assert row.message_count == 2 and row.scenario_name is None
    assert row.extra == {"phase": "burst", "n": "7"}


def test_empty_scenario_is_baseline(spark):
    df = spark.createDataFrame([("lag_spike",), ("",), (None,)], "s string")
    kinds = [r[0] for r in df.select(messages.event_type(F.col("s"))).collect()]
    assert kinds == ["anomaly_injection", "baseline_event", "baseline_event"]


def test_json_object_keeps_nulls(spark):
    (row,) = spark.range(1).select(json_object(a=F.lit(None).cast("int"), b=F.lit(1))).collect()
    assert row[0] == '{"a":null,"b":1}'


def test_tables(spark, tmp_path):
    tables.drop_table(spark, "lw_alerts")
    tables.create_table(spark, "lw_alerts", schemas.ALERTS)
    tables.create_table(spark, "lw_alerts", schemas.ALERTS)
    assert spark.table("lw_alerts").schema == schemas.ALERTS
    tables.drop_table(spark, "lw_alerts")
    assert not spark.catalog.tableExists("lw_alerts")

    df = spark.createDataFrame(
        [("a", at(0)), ("a", at(8 * 86_400)), ("b", at(9 * 86_400))], "k string, event_time timestamp"
    )
    path = str(tmp_path / "dated")
    tables.write_by_date(df, path, "event_time", "k", partitions=2)
    back = spark.read.parquet(path)
    assert back.count() == 3 and "event_date" in back.columns
    assert feeds.retain(back, "event_time", 7).count() == 2
    options = tables.message_bus_options("h:1", ["a", "b"], "latest")
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "latest"
