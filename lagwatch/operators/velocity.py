"""Speeds, lag velocity and the formatting projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwatch import schemas
from lagwatch.functions.expr import non_negative, or_zero, ratio_or
from lagwatch.operators import timeline as tl

#: A like-named group of another cluster is another timeline.
GROUP = ("cluster_id", "consumer_group")
CHUNK_SECONDS = 4 * tl.DAY


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*")


def with_previous(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = GROUP,
    time: str = "event_time",
    seconds: int = CHUNK_SECONDS,
    before: float = 0,
) -> DataFrame:
    """Add struct ``_prev`` with ``columns`` of the row before, and keep the chunk columns.

    The previous row may be arbitrarily old: the first row of a chunk takes it from the carry.
    ``before`` widens the chunks for callers that put further frames on the same window.
    """
    carried = tl.carry_last(df, keys, time, seconds, columns, "_carried")
    spread = tl.spread_time(df, time, seconds, before=before)
    inside = F.lag(F.struct(*columns)).over(tl.over(keys))
    return (
        spread.join(carried, [*keys, tl.CHUNK], "left")
        .withColumn("_prev", F.coalesce(inside, F.col("_carried")))
        .drop("_carried")
    )


def elapsed_seconds(time: str = "event_time") -> Column:
    return (F.unix_micros(time) - F.unix_micros(f"_prev.{time}")) / tl.SECOND


def speed_columns() -> dict[str, Column]:
    """Messages per second read and written since the previous poll; 0 on the first."""

    def speed(offset: str) -> Column:
        moved = F.col(offset) - F.col(f"_prev.{offset}")
        return F.coalesce(non_negative(F.try_divide(moved, elapsed_seconds())), F.lit(0.0))

    return {"read_speed": speed("total_current_offset"), "write_speed": speed("total_log_end_offset")}


def derived_columns() -> dict[str, Column]:
    lag, read, write = F.col("current_lag"), F.col("read_speed"), F.col("write_speed")
    return {
        "time_to_catchup_seconds": ratio_or(lag, read, 0.0),
        "speed_ratio": ratio_or(read, write, 1.0),
        "is_falling_behind": read < write,
    }


def velocity_column(mode: str = "delta") -> Column:
    """Change of lag since the previous sample, plain or per second; 0 on the first."""
    change = (F.col("current_lag") - F.col("_prev.current_lag")).cast("double")
    if mode == "rate":
        change = F.try_divide(change, elapsed_seconds())
    elif mode != "delta":
        raise ValueError(f"velocity mode must be delta or rate, not {mode!r}")
    return F.coalesce(change, F.lit(0.0))


def group_speeds(
    polls: DataFrame, keys: Sequence[str] = GROUP, tie: Sequence[str] = ()
) -> DataFrame:
    """Add read_speed, write_speed and time_to_catchup_seconds.

    With ``tie`` given, polls with equal times are first reduced to the earliest by it: a poll
    without elapsed time does not move the state.
    """
    if tie:
        polls = keep_first(polls, [*keys, "event_time"], tie)
    offsets = ["event_time", "total_current_offset", "total_log_end_offset"]
    with_prev = with_previous(polls, offsets, keys)
    out = tl.own_rows(with_prev.withColumns(speed_columns()), "_prev")
    catchup = derived_columns()["time_to_catchup_seconds"]
    return out.withColumn("time_to_catchup_seconds", catchup)


#: Columns of a raw record that the flattened record keeps.
FORMATTED = tuple(
    c for c in schemas.METRICS_FLATTENED.fieldNames() if c not in ("lag_velocity", "speed_ratio", "is_falling_behind")
)


def format_metrics(
    source: DataFrame, velocity: str = "delta", keys: Sequence[str] = GROUP
) -> DataFrame:
    """Raw metrics to the flattened feature table all rules read.

    Negative lags are dropped before the previous row is looked up, as a WHERE clause is.
    """
    valid = source.where(F.col("current_lag") >= 0).select(*FORMATTED)
    with_prev = with_previous(valid, ["event_time", "current_lag"], keys)
    out = tl.own_rows(with_prev.withColumn("lag_velocity", velocity_column(velocity)), "_prev")
    derived = derived_columns()
    return out.select(
        *FORMATTED,
        "lag_velocity",
        derived["speed_ratio"].alias("speed_ratio"),
        derived["is_falling_behind"].alias("is_falling_behind"),
    )
