"""Topic and cluster telemetry: time buckets, pivots, series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwatch.functions.expr import kilobytes, or_zero

# The query API's granularities and the metric names.
GRAINS = {
    "PT1M": "1 minute",
    "PT5M": "5 minutes",
    "PT15M": "15 minutes",
    "PT1H": "1 hour",
    "P1D": "1 day",
}
COUNTERS = ("received_bytes", "sent_bytes", "received_records", "sent_records")
GAUGES = ("retained_bytes", "active_connections")


def _last(value: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), F.struct(F.col("ts"), value)))


def telemetry(
    samples: DataFrame,
    grain: str = "PT1M",
    by: Sequence[str] = ("topic",),
    metrics: Sequence[str] = (*COUNTERS, "retained_bytes"),
) -> DataFrame:
    """One row per bucket with a column per metric: counters summed, gauges by their last value.

    One pass and one partial aggregation replace a query per metric; a hot topic is combined
    before the shuffle and then spread over its buckets.
    """
    wanted = samples.where(F.col("metric").isin(*metrics))
    slot = F.window("ts", GRAINS[grain])["start"].alias("bucket")
    if "topic" not in by:  # a gauge of several topics is the sum of each topic's last value
        each = telemetry(samples, grain, [*by, "topic"], metrics)
        return each.groupBy(*by, "bucket").agg(*[F.sum(m).alias(m) for m in metrics])

    def measure(name: str) -> Column:
        value = F.when(F.col("metric") == name, F.col("value"))
        return or_zero(_last(value) if name in GAUGES else F.sum(value)).alias(name)

    return wanted.groupBy(*by, slot).agg(*[measure(m) for m in metrics])


def topic_telemetry(samples: DataFrame, grain: str = "PT1M") -> DataFrame:
    return telemetry(samples, grain, ["topic"])


def cluster_telemetry(
    samples: DataFrame, grain: str = "PT1M",
    metrics: Sequence[str] = ("received_bytes", "sent_bytes"),
) -> DataFrame:
    """All topics together, with the throughput in both directions."""
    out = telemetry(samples, grain, [], metrics)
    return out.withColumn("throughput", F.col("received_bytes") + F.col("sent_bytes"))


def query(
    samples: DataFrame,
    metric: str,
    filters: Mapping[str, str] | None = None,
    interval: str = "15 minutes",
    limit: int = 1000,
) -> DataFrame:
    """Newest samples of a metric under equality filters within the interval, oldest first."""
    found = samples.where(F.col("metric") == metric)
    for column, value in (filters or {}).items():
        found = found.where(F.col(column) == value)
    end = found.agg(F.max("ts")).scalar()
    within = found.where(F.col("ts") >= end - F.expr(f"INTERVAL {interval}"))
    order = ["ts", *[c for c in samples.columns if c != "ts"]]
    return within.orderBy(*[F.col(c).desc() for c in order]).limit(limit).orderBy(*order)


def latest_values(samples: DataFrame, by: Sequence[str] = ("topic", "metric")) -> DataFrame:
    """Last value of every series, 0 if it has none."""
    newest = F.max_by("value", F.struct("ts", "value"))
    return samples.groupBy(*by).agg(or_zero(newest).alias("value"))


def series(bucketed: DataFrame, value: str, by: Sequence[str] = ("topic",)) -> DataFrame:
    """Series as one ordered array per key; a bucketed series is as long as its span, not its rows."""
    point = F.struct(F.col("bucket").alias("timestamp"), or_zero(F.col(value)).alias("value"))
    return bucketed.groupBy(*by).agg(F.sort_array(F.collect_list(point)).alias(value))


def normalised(bucketed: DataFrame, value: str, by: str = "topic") -> DataFrame:
    """Percent of the series maximum, at most 100. The maximum joins back as one row per series."""
    top = bucketed.groupBy(by).agg(F.max(value).alias("_top"))
    share = F.least(F.lit(100.0), F.try_divide(F.col(value), F.col("_top")) * 100)
    percent = F.when(F.col("_top") != 0, share)
    return bucketed.join(top, by).select(by, "bucket", value, percent.alias("percent"))


def last_points(bucketed: DataFrame, n: int = 15, by: str = "topic") -> DataFrame:
    """Last ``n`` points per topic; the rank limit is applied before the shuffle as well."""
    newest = Window.partitionBy(by).orderBy(F.col("bucket").desc())
    return bucketed.withColumn("_rank", F.row_number().over(newest)).where(
        F.col("_rank") <= n
    ).drop("_rank")


def compare(values: DataFrame) -> DataFrame:
    """Chart rows per topic: bytes as kilobytes with two decimals, records as they are."""
    return values.select(
        "topic",
        kilobytes(F.col("received_bytes")).alias("received_kb"),
        kilobytes(F.col("sent_bytes")).alias("sent_kb"),
        F.col("received_records").alias("records_in"),
        F.col("sent_records").alias("records_out"),
    )
