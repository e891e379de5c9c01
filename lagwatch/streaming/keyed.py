"""Event-time operators on Spark's keyed state, with timers that emit and evict.

Each operator is one stateful function per key. Rows wait in the state until the watermark has passed them
and are then worked off in event-time order, so the result does not depend on how the input was cut
into batches. Timers are event-time timers of the state store: one for the next row that waits and, when
none does, one for the eviction of the key. What a batch reads is the state of the keys it touches, whose
size is bounded by the operator's window, never by the length of the history.

* :func:`metric_records`: previous poll and 24 hours of lags per (cluster, group);
* :func:`correlation`: last time per group of a topic, in the order of these times;
* :func:`newest_enrichment`: alerts that wait with their newest enrichment, by a bucket of alert ids;
* :func:`compacted`: last value per key, deletes kept for a lifetime, changes as output.
"""

from __future__ import annotations

import json
import pickle
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lagwatch import schemas
from lagwatch.operators import correlate
from lagwatch.operators.rollup import SKEW_CAP
from lagwatch.operators.rules import in_gate
from lagwatch.operators.timeline import DAY, SECOND
from lagwatch.streaming.stages import STATE_STORE, write_dated

DELAY = "30 seconds"
IDLE_SECONDS = 7 * DAY
_STATE = "kept binary"


# --- 24 hours of lags -------------------------------------------------------------------------


class Window:
    """Values of the last ``width`` microseconds with their sum and order statistic.

    A row is inserted into a sorted list and an expired one is taken out again, so each row costs two
    searches, however long the window is.
    """

    def __init__(self, width: int, times: Sequence[int] = (), values: Sequence[int] = ()):
        self.width, self.times, self.values = width, list(times), list(values)
        self.ascending, self.total, self.expired = sorted(self.values), sum(self.values), 0

    def add(self, time: int, value: int) -> None:
        self.times.append(time)
        self.values.append(value)
        insort(self.ascending, value)
        self.total += value
        while self.times[self.expired] < time - self.width:
            gone = self.values[self.expired]
            del self.ascending[bisect_left(self.ascending, gone)]
            self.total -= gone
            self.expired += 1

    def mean(self) -> float:
        return self.total / len(self.ascending)

    def quantile(self, q: float) -> float:
        n = len(self.ascending)
        return float(self.ascending[min(int(q * n), n - 1)])

    def kept(self) -> tuple[bytes, bytes]:
        return tuple(np.array(x[self.expired :], np.int64).tobytes() for x in (self.times, self.values))


class GroupHistory:
    """What is known of one (cluster, group): polls that wait, the previous poll, 24 hours of lags."""

    def __init__(self, seconds: float, kept: bytes | None):
        self.waiting: dict[int, dict[tuple[str, int], tuple[int, int, int]]] = {}
        self.previous: tuple[int, int, int, int] | None = None
        times = values = ()
        if kept:
            self.waiting, self.previous, (times, values) = pickle.loads(kept)
            times, values = (np.frombuffer(x, np.int64).tolist() for x in (times, values))
        self.lags = Window(int(seconds * SECOND), times, values)

    def kept(self) -> bytes:
        return pickle.dumps((self.waiting, self.previous, self.lags.kept()))

    def receive(self, batch: pd.DataFrame) -> None:
        """Partition samples; of a sample delivered again the first stays."""
        if batch.empty:
            return
        times = batch["poll_time"].astype("int64") // _unit(batch["poll_time"])
        columns = ("topic", "partition_id", "current_offset", "log_end_offset", "lag")
        for time, topic, partition, *numbers in zip(times.tolist(), *(batch[c].tolist() for c in columns), strict=True):
            self.waiting.setdefault(time, {}).setdefault((topic, partition), tuple(numbers))

    def due(self, watermark: int, quantile: float) -> Iterator[dict[str, Any]]:
        """Metric records of the polls that the watermark has passed, in event-time order."""
        for time in sorted(t for t in self.waiting if t <= watermark):
            yield self._record(time, self.waiting.pop(time), quantile)

    def _record(self, time: int, samples: Mapping, quantile: float) -> dict[str, Any]:
        lags = [lag for _, _, lag in samples.values()]
        offset, end, lag = (sum(s[i] for s in samples.values()) for i in range(3))
        read = write = velocity = 0.0
        if self.previous:
            before, was_offset, was_end, was_lag = self.previous
            seconds = (time - before) / SECOND
            read, write = max((offset - was_offset) / seconds, 0.0), max((end - was_end) / seconds, 0.0)
            velocity = float(lag - was_lag)
        self.previous = (time, offset, end, lag)
        self.lags.add(time, lag)
        even = len(lags) < 2 or lag == 0
        return {
            "event_time": time,
            "topic": min(topic for topic, _ in samples),
            "current_lag": lag,
            "read_speed": read,
            "write_speed": write,
            "time_to_catchup_seconds": lag / read if read > 0 else 0.0,
            "partition_skew_score": 0.0 if even else min(max(lags) / (lag / len(lags)), SKEW_CAP),
            "lag_24h_avg": self.lags.mean(),
            "lag_percentile_95_24h": self.lags.quantile(quantile),
            "partition_count": len(lags),
            "lag_velocity": velocity,
            "speed_ratio": read / write if write > 0 else 1.0,
            "is_falling_behind": read < write,
        }


def _unit(times: pd.Series) -> int:
    """Parts of the series' time unit in a microsecond."""
    return {"ns": 1_000, "us": 1}[times.dt.unit]


def _timer(state: GroupState, micros: int) -> None:
    """Event-time timer that fires once the watermark has passed ``micros``."""
    state.setTimeoutTimestamp(max(-(-micros // 1_000), state.getCurrentWatermarkMs() + 1))


def metric_records(
    samples: DataFrame,
    delay: str = DELAY,
    seconds: float = DAY,
    quantile: float = 0.95,
    idle_seconds: float = IDLE_SECONDS,
) -> DataFrame:
    """Partition samples as a stream to complete metric records, one per group and poll.

    A group that sends nothing for ``idle_seconds`` is evicted.
    """
    out = schemas.METRICS_FLATTENED
    names = out.fieldNames()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        history = GroupHistory(seconds, state.get[0] if state.exists else None)
        for batch in batches:
            history.receive(batch)
        watermark = state.getCurrentWatermarkMs() * 1_000
        rows = list(history.due(watermark, quantile))
        last = history.previous[0] if history.previous else None
        gone = last is not None and last + int(idle_seconds * SECOND) <= watermark
        if gone and not history.waiting:
            state.remove()
        else:
            state.update((history.kept(),))
            _timer(state, min(history.waiting, default=0) or last + int(idle_seconds * SECOND))
        if rows:
            made = pd.DataFrame(rows).assign(cluster_id=key[0], consumer_group=key[1])
            made["event_time"] = pd.to_datetime(made["event_time"], unit="us")
            yield made[names]

    return (
        samples.withWatermark("poll_time", delay)
        .groupBy("cluster_id", "consumer_group")
        .applyInPandasWithState(step, out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


# --- distinct groups of a topic ---------------------------------------------------------------


class Present:
    """Groups seen within the last ``width`` microseconds.

    They are kept in the order of their last time, so those to expire stand in front, and there is one
    entry per group however many rows it sends.
    """

    def __init__(self, width: int, last: Mapping[str, int] | None = None):
        self.width, self.last = width, dict(last or {})

    def see(self, group: str, time: int) -> None:
        self.last.pop(group, None)
        self.last[group] = time

    def count(self, time: int) -> int:
        gone = []
        for group, seen in self.last.items():
            if seen >= time - self.width:
                break
            gone.append(group)
        for group in gone:
            del self.last[group]
        return len(self.last)


_COUNTED = (
    "alert_time timestamp, cluster_id string, consumer_group string, topic string, current_lag long, read_speed double, "
    "write_speed double, time_to_catchup_seconds double, partition_skew_score double, affected_groups long, "
    "total_groups long, _groups string"
)


def correlation(
    metrics: DataFrame, delay: str = DELAY, lookback: float = 300, min_groups: int = 2, bucket: int = 300
) -> DataFrame:
    """Metric rows as a stream to the alerts of :func:`lagwatch.operators.correlate.correlation`.

    Rows of a topic wait until the watermark has passed them; those of one moment are counted together.
    A topic without rows for the look-back has no state.
    """
    width = int(lookback * SECOND)
    numbers = ("current_lag", "read_speed", "write_speed", "time_to_catchup_seconds", "partition_skew_score")
    flags = {
        "_degraded": F.coalesce(correlate.degraded(), F.lit(False)),
        "_wanted": F.coalesce(F.col("is_falling_behind") | (F.col("lag_velocity") > 100), F.lit(False))
        & in_gate(F.col("event_time"), bucket),
    }
    columns = ["cluster_id", "consumer_group", *numbers, *flags]

    def moment(topic: str, time: int, rows: list[tuple], degraded: Present, present: Present) -> Iterator[dict]:
        for _, group, *_, is_degraded, _ in rows:
            present.see(group, time)
            if is_degraded:
                degraded.see(group, time)
        affected, total = degraded.count(time), present.count(time)
        if affected < min_groups:
            return
        by_cluster: dict[str, list[tuple]] = {}
        for row in rows:
            if row[-1]:
                by_cluster.setdefault(row[0], []).append(row)
        for cluster, own in by_cluster.items():
            groups = sorted({r[1] for r in own})
            values = dict(zip(numbers, zip(*(r[2:7] for r in own), strict=True), strict=True))

            def mean(name: str, values: dict = values) -> float | None:
                known = [v for v in values[name] if not pd.isna(v)]
                return sum(known) / len(known) if known else None

            yield {
                "alert_time": time, "cluster_id": cluster, "consumer_group": groups[0], "topic": topic,
                "current_lag": sum(values["current_lag"]), "read_speed": mean("read_speed"),
                "write_speed": mean("write_speed"),
                "time_to_catchup_seconds": max(values["time_to_catchup_seconds"]),
                "partition_skew_score": mean("partition_skew_score"),
                "affected_groups": affected, "total_groups": total, "_groups": ", ".join(groups),
            }

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, *last = pickle.loads(state.get[0]) if state.exists else ({}, None, None)
        degraded, present = (Present(width, x) for x in last)
        for batch in (b for b in batches if not b.empty):
            times = (batch["event_time"].astype("int64") // _unit(batch["event_time"])).tolist()
            for time, *row in zip(times, *(batch[c].tolist() for c in columns), strict=True):
                waiting.setdefault(time, {}).setdefault((row[0], row[1]), tuple(row))
        watermark = state.getCurrentWatermarkMs() * 1_000
        found = [
            alert
            for time in sorted(t for t in waiting if t <= watermark)
            for alert in moment(key[0], time, list(waiting.pop(time).values()), degraded, present)
        ]
        ends = max(present.last.values(), default=0) + width
        if not waiting and ends <= watermark:
            state.remove()
        else:
            state.update((pickle.dumps((waiting, degraded.last, present.last)),))
            _timer(state, min(waiting, default=ends))
        if found:
            made = pd.DataFrame(found)
            made["alert_time"] = pd.to_datetime(made["alert_time"], unit="us")
            yield made

    rows = metrics.withColumns(flags).select("event_time", "topic", *columns)
    counted = rows.withWatermark("event_time", delay).groupBy("topic").applyInPandasWithState(
        step, _COUNTED, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return correlate.topic_alerts(counted)


# --- two inputs in one state ------------------------------------------------------------------

ENRICHED = T.StructType(
    [*schemas.ALERTS.fields, *[f for f in schemas.ENRICHED_ALERTS if f.name not in ("alert_id", "severity")]]
)


def newest_enrichment(
    alerts: DataFrame, enriched: DataFrame, delay: str = "10 seconds", within: float = 600, buckets: int = 512
) -> DataFrame:
    """Alerts with the newest enrichment that comes within ``within`` seconds of event time.

    Every alert is emitted once, when the watermark has passed its bound: bare if nothing came. Of a
    redelivered alert the first stays. Enrichments without an alert are dropped after the same time.
    Alert ids share ``buckets`` keys by hash, so that a call of Python serves many alerts, not one.
    """
    types = {f.name: f.dataType for f in ENRICHED}
    width = int(within * SECOND)

    def text(df: DataFrame, names: Sequence[str]) -> F.Column:
        return F.to_json(F.struct(*[_plain(F.col(c), df.schema[c].dataType).alias(c) for c in names]))

    none = F.lit(None).cast("string")
    left = alerts.select(
        "alert_id", F.col("alert_time").alias("at"), text(alerts, schemas.ALERTS.fieldNames()).alias("alert"), none.alias("enrichment")
    )
    names = [f.name for f in schemas.ENRICHED_ALERTS if f.name != "alert_id"]
    right = enriched.select(
        "alert_id", F.col("timestamp").alias("at"), none.alias("alert"), text(enriched, names).alias("enrichment")
    )

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = pickle.loads(state.get[0]) if state.exists else {}
        for batch in (b for b in batches if not b.empty):
            times = (batch["at"].astype("int64") // _unit(batch["at"])).tolist()
            columns = (batch[c].tolist() for c in ("alert_id", "alert", "enrichment"))
            for at, alert_id, own, more in zip(times, *columns, strict=True):
                alert, best = known.get(alert_id, (None, []))
                if own is not None and alert is None:
                    known[alert_id] = ((at, own), best)
                elif more is not None:
                    known[alert_id] = (alert, [*best, (at, json.loads(more)["diagnosis"] or "", more)])
        watermark, waiting, due, ends = state.getCurrentWatermarkMs() * 1_000, {}, [], []
        for alert_id, (alert, best) in known.items():
            if alert:  # then only the newest can still be emitted
                best = sorted(b for b in best if alert[0] <= b[0] <= alert[0] + width)[-1:]
            end = (alert[0] if alert else min(at for at, _, _ in best)) + width
            if end > watermark:
                waiting[alert_id] = (alert, best)
                ends.append(end)
            elif alert:
                row = json.loads(alert[1])
                if best:
                    newest = json.loads(best[0][2])
                    row |= {k: v for k, v in newest.items() if k != "severity" or v is not None}
                due.append(row)
        if waiting:
            state.update((pickle.dumps(waiting),))
            _timer(state, min(ends))
        elif state.exists:
            state.remove()
        if due:
            yield _typed(due, types)

    both = left.unionByName(right).withWatermark("at", delay)
    both = both.withColumn("bucket", F.pmod(F.xxhash64("alert_id"), F.lit(buckets)))
    return both.groupBy("bucket").applyInPandasWithState(
        step, ENRICHED, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def _plain(column: F.Column, kind: T.DataType) -> F.Column:
    return F.unix_micros(column) if isinstance(kind, T.TimestampType) else column


def _typed(rows: list[dict], types: Mapping[str, T.DataType]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=list(types))
    for name, kind in types.items():
        if isinstance(kind, T.TimestampType):
            made[name] = pd.to_datetime(made[name], unit="us")
        elif isinstance(kind, T.LongType):
            made[name] = made[name].astype("Int64")
        elif isinstance(kind, T.DoubleType):
            made[name] = made[name].astype("float64")
    return made


# --- compacted table --------------------------------------------------------------------------

CHANGES = T.StructType([*schemas.AGENT_MEMORY.fields, T.StructField("time", T.TimestampType())])


def compacted(log: DataFrame, time: str, delay: str = DELAY, lifetime: float = DAY) -> DataFrame:
    """Changes of the compacted table: the newest record of a key by (partition, offset), deletes included.

    A delete stays in the state for ``lifetime`` seconds of event time, so that an older value that comes
    late does not bring the key back; then the key has no state. Values stay until they are deleted.
    """
    names = CHANGES.fieldNames()
    types = {f.name: f.dataType for f in CHANGES}

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = pickle.loads(state.get[0]) if state.exists else None
        newest = known
        for batch in (b for b in batches if not b.empty):
            times = (batch["time"].astype("int64") // _unit(batch["time"])).tolist()
            values = [None if pd.isna(v) else v for v in batch["value"]]
            places = zip(batch["partition"].tolist(), batch["offset"].tolist(), strict=True)
            for place, at, value in zip(places, times, values, strict=True):
                if newest is None or place > newest[0]:
                    newest = (place, at, value)
        place, at, value = newest
        ends = at + int(lifetime * SECOND)
        if value is None and ends <= state.getCurrentWatermarkMs() * 1_000:
            state.remove()
        else:
            state.update((pickle.dumps(newest),))
            if value is None:
                _timer(state, ends)
        if newest != known:
            row = {"key": key[0], "value": value, "partition": place[0], "offset": place[1], "time": at}
            yield _typed([row], types)[names].astype({"partition": "int32"})

    return (
        log.withColumn("time", F.col(time)).withWatermark("time", delay)
        .groupBy("key")
        .applyInPandasWithState(step, CHANGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


# --- sinks ------------------------------------------------------------------------------------


def start(rows: DataFrame, time: str, root: str, trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Write a stream to ``root``/out, dated and named by batch; a batch that runs again replaces its files."""
    return run(rows, lambda df, batch: write_dated(df, time, f"{root}/out", batch), root, trigger, name)


def run(
    rows: DataFrame, sink: Callable[[DataFrame, int], None], root: str, trigger: str | None = None, name: str | None = None
) -> StreamingQuery:
    spark = rows.sparkSession
    for setting, value in STATE_STORE.items():
        spark.conf.set(setting, value)
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
    if name:
        writer = writer.queryName(name)
    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.foreachBatch(sink).trigger(**timing).start()


def batch_watermark(spark, root: str, batch: int) -> int:
    """Watermark in microseconds under which a batch runs, as Spark's own offset log of the query has it."""
    lines = [r.value for r in spark.read.text(f"{root}/checkpoint/offsets/{batch}").collect()]
    return next(json.loads(line)["batchWatermarkMs"] for line in lines if "batchWatermarkMs" in line) * 1_000


def split_late(stream: DataFrame, time: str, root: str, delay: str = DELAY, trigger: str | None = None) -> StreamingQuery:
    """Rows behind the watermark to ``root``/late, all others to ``root``/out, each by batch, before any aggregation.

    The late rows themselves are kept, as often as they came, so their number is exact over any number of
    batches and restarts.
    """

    def sink(df: DataFrame, batch: int) -> None:
        mark = F.timestamp_micros(F.lit(batch_watermark(df.sparkSession, root, batch)).cast("long"))
        write_dated(df.where(F.col(time) <= mark), time, f"{root}/late", batch)
        write_dated(df.where(~F.coalesce(F.col(time) <= mark, F.lit(False))), time, f"{root}/out", batch)

    return run(stream.withWatermark(time, delay), sink, root, trigger)
