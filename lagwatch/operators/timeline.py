"""Windows over long per-key timelines, cut so that no key becomes one task.

``Window.partitionBy(key)`` puts a key's whole history into one task. A key may hold a third
of all rows, so every ordered operator here partitions by (key, chunk) instead and gets what a
chunk needs from its neighbours in one of two exact ways:

* *overlap*: a bounded look-back or look-ahead copies rows of the neighbouring chunks
  (:func:`spread_time`, :func:`spread_rows`); rows outside the own chunk are dropped afterwards;
* *carry*: an unbounded prefix (row number, running sum, previous row) is computed inside the
  chunk and continued from a per-chunk summary, which has one row per (key, chunk) and is
  combined before its shuffle (:func:`running`, :func:`carry_last`).

Results do not depend on the chunk length; it only sets how much work one task gets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwatch.functions.expr import bucket

CHUNK = "_chunk"
OWN = "_own"
US = "_us"
ROW = "_row"

SECOND = 1_000_000
DAY = 86_400


def time_chunk(time: Column, seconds: int) -> Column:
    return bucket(F.unix_micros(time), seconds * SECOND)


def spread_time(
    df: DataFrame, time: str, seconds: int, before: float = 0, after: float = 0
) -> DataFrame:
    """Add the chunk, an own flag and the time in microseconds.

    A row also goes to every later chunk that looks back ``before`` seconds onto it and to every
    earlier chunk that looks ahead ``after`` seconds.
    """
    width = seconds * SECOND
    out = df.withColumn(US, F.unix_micros(time))
    home = bucket(F.col(US), width)
    if not before and not after:
        return out.withColumn(CHUNK, home).withColumn(OWN, F.lit(True))
    first = bucket(F.col(US) - int(after * SECOND), width)
    last = bucket(F.col(US) + int(before * SECOND), width)
    return out.withColumn(CHUNK, F.explode(F.sequence(first, last))).withColumn(
        OWN, F.col(CHUNK) == home
    )


def spread_rows(df: DataFrame, row: str, length: int, before: int) -> DataFrame:
    """The same for frames counted in rows: blocks of ``length`` consecutive row numbers."""
    home = bucket(F.col(row), length)
    last = bucket(F.col(row) + before, length)
    return df.withColumn(CHUNK, F.explode(F.sequence(home, last))).withColumn(
        OWN, F.col(CHUNK) == home
    )


def own_rows(df: DataFrame, *extra: str) -> DataFrame:
    """Keep each row once and drop the helper columns."""
    return df.where(OWN).drop(CHUNK, OWN, US, *extra)


def over(keys: Sequence[str]):
    """The shared window: one exchange and one sort serve every frame on it."""
    return Window.partitionBy(*keys, CHUNK).orderBy(US)


def seconds_range(window, seconds: float):
    """RANGE frame of the last ``seconds``, peers of the current row included."""
    return window.rangeBetween(-int(seconds * SECOND), Window.currentRow)


def trailing_sum(value: Column, window, seconds: float) -> Column:
    """Sum over a wide RANGE frame as a difference of two prefix sums.

    A sliding frame costs its length for every row; both prefixes here grow by one row at a time.
    Exact for integer values.
    """
    everything = window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    expired = window.rangeBetween(Window.unboundedPreceding, -int(seconds * SECOND) - 1)
    return F.sum(value).over(everything) - F.coalesce(F.sum(value).over(expired), F.lit(0))


def trailing_rows(value: str, window, rows: int) -> Column:
    """Sum over the last ``rows`` rows and the current one, as :func:`trailing_sum`; for exact types."""
    everything = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expired = window.rowsBetween(Window.unboundedPreceding, -rows - 1)
    return F.coalesce(F.sum(value).over(everything), F.lit(0)) - F.coalesce(F.sum(value).over(expired), F.lit(0))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    number: str | None = None,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Row number from 1 and running sums over ``order`` within ``keys``.

    ``df`` carries a :data:`CHUNK` column that grows with the first ``order`` column. Inside a
    chunk the prefix comes from a window; the start value of each chunk is the sum of the chunk
    totals before it.
    """
    sums = dict(sums or {})
    totals = df.groupBy(*keys, CHUNK).agg(
        F.count(F.lit(1)).alias("_total_n"),
        *[F.sum(value).alias(f"_total_{name}") for name, value in sums.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    names = ["n", *sums]
    starts = totals.select(
        *keys,
        CHUNK,
        *[
            F.coalesce(F.sum(f"_total_{name}").over(earlier), F.lit(0)).alias(f"_start_{name}")
            for name in names
        ],
    )
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    prefix = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.join(starts, [*keys, CHUNK])
    if number:
        out = out.withColumn(number, F.row_number().over(inside) + F.col("_start_n"))
    for name, value in sums.items():
        out = out.withColumn(name, F.sum(value).over(prefix) + F.col(f"_start_{name}"))
    return out.drop(*[f"_start_{name}" for name in names])


def carry_last(
    df: DataFrame, keys: Sequence[str], time: str, seconds: int, columns: Sequence[str], name: str
) -> DataFrame:
    """Per (key, chunk): ``columns`` of the last row before the chunk, as struct ``name``.

    Numeric columns are picked one by one, so that the summary is a hash aggregation without a
    sort of its input.
    """
    last = (
        df.select(*keys, F.col(time), *[c for c in columns if c != time])
        .withColumn(CHUNK, time_chunk(F.col(time), seconds))
        .groupBy(*keys, CHUNK)
        .agg(*[F.max_by(c, F.col(time)).alias(f"_last_{c}") for c in columns])
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK)
    values = F.struct(*[F.col(f"_last_{c}").alias(c) for c in columns])
    return last.select(*keys, CHUNK, F.lag(values).over(earlier).alias(name))


def number_by_time(
    df: DataFrame, keys: Sequence[str], time: str, row: str = ROW, seconds: int = DAY
) -> DataFrame:
    """Row number per key in time order; each (key, time) occurs once."""
    chunked = df.withColumn(CHUNK, time_chunk(F.col(time), seconds))
    return running(chunked, keys, [time], number=row).drop(CHUNK)


def measured_seconds(df: DataFrame, time: str, target_rows: int) -> int:
    """Chunk length for raw rows of unknown density.

    The busiest minute, counted over all keys together, bounds the rows of any (key, minute).
    The answer is one row on the driver.
    """
    per_minute = df.groupBy(time_chunk(F.col(time), 60).alias("minute")).count()
    busiest = per_minute.agg(F.max("count")).first()[0] or 1
    if busiest <= target_rows:
        return min(60 * (target_rows // busiest), 366 * DAY)
    return max(1, 60 * target_rows // busiest)
