"""Batch and streaming scans, table definitions, keyed writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WATERMARKS = {"metrics": "30 seconds", "alerts": "10 seconds"}


def scan_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Unbounded scan of a folder of files, from the earliest one."""
    return spark.readStream.schema(schema).format(fmt).options(**(options or {})).load(path)


def message_bus_options(
    servers: str, topics: Sequence[str], starting: str = "earliest"
) -> dict[str, str]:
    """Reader options: jobs start at the earliest offset, live feeds at the latest."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }


def stream_topics(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The same stream from a message bus; needs Spark's public Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """CREATE TABLE IF NOT EXISTS with an explicit schema."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    split = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{split}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_by_date(df: DataFrame, path: str, time: str, key: str, partitions: int | None = None) -> None:
    """Append to a table partitioned by date.

    Rows are spread by (date, key, minute): files per date stay few, and a hot key is not one task.
    """
    dated = df.withColumn("event_date", F.to_date(time))
    spread = [F.col("event_date"), F.col(key), F.minute(time)]
    spread_df = dated.repartition(partitions, *spread) if partitions else dated.repartition(*spread)
    spread_df.write.mode("append").partitionBy("event_date").parquet(path)
