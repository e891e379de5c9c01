"""Event-time stages: settle, look back, compute, append.

Structured Streaming has no row or range windows. A stage therefore splits the work:

* *settle* (stateful, JVM only): a watermarked aggregation on (primary key, time). It removes
  redelivered rows, drops and counts rows behind the watermark, and hands on a row only when the
  watermark has passed it. Its state is the rows of one watermark delay. The key contains the
  time, so a group with many rows is spread over all state partitions.
* *compute* (``foreachBatch``): settled rows arrive in event-time order from batch to batch, so
  what a frame looks back on has already been written. The batch reads its look-back from the
  stage's own history, runs the batch operator on both and keeps the new rows.

A frame bounded in time reads the history of ``lookback`` seconds; a frame bounded in rows (or
the previous row, however old) reads the ``tail`` last rows per key, kept as a small table per
batch. Every write goes to a directory named by the batch id and replaces it, so a batch that is
run again after a failure leaves the same files: with the checkpoint, exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lagwatch.operators.alerts import upsert_latest
from lagwatch.operators.timeline import SECOND
from lagwatch.session import configure

Transform = Callable[[DataFrame], DataFrame]

# State on local disk with incremental checkpoints instead of on the heap.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

PARTS_OF_A_DATE = 8


@dataclass(frozen=True)
class Stage:
    """``prepare`` turns settled input rows into history rows, ``transform`` history into output.

    ``keys`` with ``time`` is the primary key of the input. ``history_keys`` and ``history_time``
    name the frame's partition and order in the history, ``out_time`` the time of output rows.
    """

    name: str
    keys: Sequence[str]
    time: str
    transform: Transform
    history_keys: Sequence[str]
    history_time: str
    out_time: str
    prepare: Transform = lambda df: df
    delay: str = "30 seconds"
    lookback: float = 0
    tail: int = 0


def settle(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """One row per (keys, time), handed on once the watermark has passed it."""
    rest = [c for c in stream.columns if c not in (*keys, time)]
    pick = F.max(F.struct(*rest)).alias("_row")
    grouped = stream.withWatermark(time, delay).groupBy(*keys, time).agg(pick)
    return grouped.select(*keys, time, "_row.*").select(*stream.columns)


def start(stage: Stage, stream: DataFrame, root: str, trigger: str | None = None) -> StreamingQuery:
    """Start the stage under ``root``. Without a trigger interval it ends with the input."""
    spark = configure(stream.sparkSession)
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    writer = (
        settle(stream, stage.keys, stage.time, stage.delay)
        .writeStream.queryName(stage.name)
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(lambda df, batch: _compute(stage, root, df, batch))
    )
    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.trigger(**timing).start()


def output(spark: SparkSession, root: str, schema: T.StructType, table: str = "out") -> DataFrame:
    """The stage's output table, empty if nothing was found yet."""
    found = read_dated(spark, f"{root}/{table}", "_date=*", schema)
    return spark.createDataFrame([], schema) if found is None else found.drop("_date", "_batch")


def _compute(stage: Stage, root: str, settled: DataFrame, batch: int) -> None:
    spark = configure(settled.sparkSession)
    prepared = stage.prepare(settled)
    schema, history = prepared.schema, f"{root}/history"
    write_dated(prepared, stage.history_time, history, batch)
    new = read_dated(spark, history, f"_date=*/_batch={batch}", schema)
    if new is None:
        _write_tail(stage, root, spark.createDataFrame([], schema), batch)
        return

    new = new.drop("_date", "_batch")
    times = F.unix_micros(stage.history_time)
    low, high = new.agg(F.min(times), F.max(times)).first()
    since = low - int(stage.lookback * SECOND)
    context = new
    if stage.lookback:
        dates = ",".join(_dates(since, high))
        earlier = read_dated(spark, history, f"_date={{{dates}}}", schema).where(
            (F.col("_batch") < batch) & (F.col(stage.history_time) >= _moment(since))
        )
        context = context.unionByName(earlier.drop("_date", "_batch"))
    if stage.tail and batch:
        older = spark.read.schema(schema).parquet(f"{root}/tail/{batch - 1}")
        if stage.lookback:
            older = older.where(F.col(stage.history_time) < _moment(since))
        context = context.unionByName(older)
    found = stage.transform(context).where(F.col(stage.out_time) >= _moment(low))
    write_dated(found, stage.out_time, f"{root}/out", batch)
    _write_tail(stage, root, new, batch)


def _moment(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("long"))


def _dates(first: int, last: int) -> list[str]:
    """UTC dates from one time in microseconds to another."""
    begin, end = (datetime.fromtimestamp(us / SECOND, timezone.utc).date() for us in (first, last))
    return [str(begin + timedelta(days=i)) for i in range((end - begin).days + 1)]


def date_part(time: str) -> Column:
    """The part of a date that a row is written with: a date has few files, and no date is one task."""
    return F.pmod(F.hour(time), F.lit(PARTS_OF_A_DATE))


def write_dated(df: DataFrame, time: str, path: str, batch: int) -> None:
    """Replace the rows of this batch; dates first, so that look-backs list few directories."""
    dated = df.withColumn("_date", F.to_date(time)).withColumn("_batch", F.lit(batch).cast("long"))
    dated = dated.repartition(F.col("_date"), date_part(time))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "_date", "_batch"
    ).parquet(path)


def read_dated(
    spark: SparkSession, path: str, pattern: str, schema: T.StructType
) -> DataFrame | None:
    """Rows of the directories that match, None if there are none."""
    full = T.StructType([*schema.fields]).add("_date", T.DateType()).add("_batch", T.LongType())
    reader = spark.read.schema(full).option("basePath", path)
    try:
        return reader.parquet(f"{path}/{pattern}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _write_tail(stage: Stage, root: str, new: DataFrame, batch: int) -> None:
    """The last rows per key after this batch, from those before it and the new ones."""
    if not stage.tail:
        return
    spark = new.sparkSession
    known = new
    if batch:
        before = spark.read.schema(new.schema).parquet(f"{root}/tail/{batch - 1}")
        known = new.unionByName(before)
    if stage.tail == 1:
        rest = [c for c in new.columns if c not in stage.history_keys]
        order = [stage.history_time, *[c for c in rest if c != stage.history_time]]
        kept = upsert_latest(known, stage.history_keys, order)
    else:
        newest = Window.partitionBy(*stage.history_keys).orderBy(F.col(stage.history_time).desc())
        ranked = known.withColumn("_rank", F.row_number().over(newest))
        kept = ranked.where(F.col("_rank") <= stage.tail).drop("_rank")
    kept.write.mode("overwrite").parquet(f"{root}/tail/{batch}")
