"""Dated tables as stream sinks: each batch once, bad records apart, expired dates deleted.

A table is a folder partitioned by (event_date, batch_id). A batch that runs again after a failure
replaces its own files, so together with the checkpoint every row is there exactly once. Rows without
a time go to the null date, which never expires.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lagwatch.sources import messages
from lagwatch.streaming.keyed import run
from lagwatch.streaming.stages import date_part

DATE, BATCH = "event_date", "batch_id"
DAYS = 7


def write_batch(df: DataFrame, time: str, path: str, batch: int, spread: Sequence[str] = ()) -> None:
    """Replace what the table holds of this batch.

    Rows are dealt by date and part of the day, so that files per date stay few. With ``spread`` they are
    dealt by date, these columns and the minute, and a hot key is not one task.
    """
    dated = df.withColumns({DATE: F.to_date(time), BATCH: F.lit(batch).cast("long")})
    if spread:
        dated = dated.repartition(F.col(DATE), *[F.col(c) for c in spread], F.minute(time))
    else:
        dated = dated.repartition(F.col(DATE), date_part(time))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DATE, BATCH).parquet(path)


def scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    time: str,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Rows of the table from ``since`` up to, not including, ``until``; dates outside are not read.

    A table nothing was written to yet is empty.
    """
    full = T.StructType([*schema.fields]).add(DATE, T.DateType()).add(BATCH, T.LongType())
    try:
        rows = spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if since is not None:
        rows = rows.where((F.col(time) >= F.lit(since)) & (F.col(DATE) >= F.lit(since.date())))
    if until is not None:
        rows = rows.where((F.col(time) < F.lit(until)) & (F.col(DATE) <= F.lit(until.date())))
    return rows.select(*schema.fieldNames())


def start(
    rows: DataFrame, time: str, root: str, spread: Sequence[str] = (), trigger: str | None = None
) -> StreamingQuery:
    """Append a stream to the table ``root``/table."""
    return run(rows, lambda df, batch: write_batch(df, time, f"{root}/table", batch, spread), root, trigger)


def start_checked(
    records: DataFrame,
    schema: T.StructType,
    required: messages.Required,
    time: str,
    root: str,
    value: str = "value",
    framed: bool = False,
    trigger: str | None = None,
) -> StreamingQuery:
    """Typed records to ``root``/table, all others with their reason to ``root``/quarantine.

    A bad record never fails the query. Both tables are dated by ``time``, a column beside the value,
    since the value of a bad record has no time to rely on.
    """

    def sink(df: DataFrame, batch: int) -> None:
        checked = messages.check(df, required, value, framed).persist()
        try:
            write_batch(messages.typed(checked, schema, value, framed), time, f"{root}/table", batch)
            bad = checked.where(F.col("reason").isNotNull())
            write_batch(bad, time, f"{root}/quarantine", batch)
        finally:
            checked.unpersist()

    return run(records, sink, root, trigger)


def drop_expired(spark: SparkSession, path: str, days: int = DAYS, newest: date | None = None) -> list[date]:
    """Delete the dates of a table that ended more than ``days`` before ``newest``; returns them.

    ``newest`` is the table's own newest date unless given. Only folder names are read, never rows. Run it
    again after a failure: what is gone is not listed any more.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = {}
    for status in files.listStatus(root):
        named = re.fullmatch(rf"{DATE}=(\d{{4}}-\d\d-\d\d)", status.getPath().getName())
        if named:
            found[date.fromisoformat(named[1])] = status.getPath()
    if not found:
        return []
    bound = (newest or max(found)) - timedelta(days=days)
    expired = sorted(day for day in found if day < bound)
    for day in expired:
        files.delete(found[day], True)
    return expired
