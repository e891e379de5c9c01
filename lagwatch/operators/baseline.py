"""24-hour baselines and the collector's complete record."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagwatch.operators import timeline as tl
from lagwatch.operators import velocity as v

WINDOW_SECONDS = tl.DAY


def average_column(keys: Sequence[str], seconds: float = WINDOW_SECONDS) -> Column:
    """Mean lag of the last 24 hours, both ends included, on the shared chunk window."""
    window = tl.over(keys)
    total = tl.trailing_sum(F.col("current_lag"), window, seconds)
    count = tl.trailing_sum(F.lit(1), window, seconds)
    return total / count


def lag_average(
    df: DataFrame, keys: Sequence[str] = v.GROUP, seconds: float = WINDOW_SECONDS,
    chunk_seconds: int = v.CHUNK_SECONDS,
) -> DataFrame:
    spread = tl.spread_time(df, "event_time", chunk_seconds, before=seconds)
    return tl.own_rows(spread.withColumn("lag_24h_avg", average_column(keys, seconds)))


def sliding_quantile(
    times: np.ndarray, values: np.ndarray, width: int, quantile: float
) -> np.ndarray:
    """Order statistic ``min(int(q * n), n - 1)`` of every trailing window.

    ``times`` ascend. The values' ranks are split bit by bit from the highest; at each bit all
    windows at once count their members with a zero there and follow the side that holds the
    wanted one, so the work is one pass of arrays per bit.
    """
    stop = np.arange(1, len(values) + 1)
    start = np.searchsorted(times, times - width)
    wanted = np.minimum((quantile * (stop - start)).astype(np.int64), stop - start - 1)
    distinct, ranks = np.unique(values, return_inverse=True)
    found = np.zeros(len(values), np.int64)
    for bit in reversed(range(len(distinct).bit_length())):
        one = (ranks >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~one)])
        low, high = zeros[start], zeros[stop]
        up = wanted >= high - low
        found |= up.astype(np.int64) << bit
        wanted = np.where(up, wanted - (high - low), wanted)
        start = np.where(up, zeros[-1] + start - low, low)
        stop = np.where(up, zeros[-1] + stop - high, high)
        ranks = np.concatenate([ranks[~one], ranks[one]])
    return distinct[found].astype(float)


def lag_percentile(
    df: DataFrame,
    keys: Sequence[str] = v.GROUP,
    seconds: float = WINDOW_SECONDS,
    quantile: float = 0.95,
    chunk_seconds: int = v.CHUNK_SECONDS,
) -> DataFrame:
    """Add lag_percentile_95_24h.

    Spark has no exact order statistic over a sliding frame short of collecting the frame for
    every row, so this runs on (key, chunk plus one window) as Arrow tables; columns that it does not read,
    nested ones too, pass through unconverted.
    """
    width = int(seconds * tl.SECOND)
    schema = T.StructType([*df.schema.fields, T.StructField("lag_percentile_95_24h", T.DoubleType())])
    names = df.columns

    def quantiles(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows[tl.US].to_numpy(), kind="stable")
        times, values = (rows[c].to_numpy()[order] for c in (tl.US, "current_lag"))
        found = sliding_quantile(times, values, width, quantile)
        own = rows[tl.OWN].to_numpy()[order].astype(bool)
        kept = rows.select(names).take(order[own])
        return kept.append_column("lag_percentile_95_24h", pa.array(found[own], pa.float64()))

    spread = tl.spread_time(df, "event_time", chunk_seconds, before=seconds)
    return spread.groupBy(*keys, tl.CHUNK).applyInArrow(quantiles, schema)


def lag_baseline(df: DataFrame, hours: float = 24, q: float = 0.95) -> DataFrame:
    """Both baselines; use :func:`lag_average` alone where the percentile is not read."""
    return lag_percentile(lag_average(df, seconds=hours * 3600), seconds=hours * 3600, quantile=q)


def collect_metrics(
    polls: DataFrame,
    keys: Sequence[str] = v.GROUP,
    velocity: str = "delta",
    chunk_seconds: int = v.CHUNK_SECONDS,
) -> DataFrame:
    """Group polls to complete metric rows without the percentile.

    Speeds, velocity and the 24-hour average share one chunked window: one exchange, one sort.
    """
    previous = ["event_time", "total_current_offset", "total_log_end_offset", "current_lag"]
    base = v.with_previous(
        polls, previous, keys, seconds=chunk_seconds, before=WINDOW_SECONDS
    )
    measured = base.withColumns(
        {
            **v.speed_columns(),
            "lag_velocity": v.velocity_column(velocity),
            "lag_24h_avg": average_column(keys),
        }
    )
    return tl.own_rows(measured, "_prev").withColumns(v.derived_columns())
