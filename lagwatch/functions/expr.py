"""Scalar expressions whose null and rounding rules the rules depend on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def bucket(value: Column, width: int) -> Column:
    """Floor division on integers, exact below zero as well."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def least_strict(*cols: Column) -> Column:
    """LEAST that is null as soon as one argument is (Spark's skips nulls)."""
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(known, F.least(*cols))


def non_negative(value: Column) -> Column:
    """max(0, x), null for null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def ratio_or(numerator: Column, denominator: Column, otherwise: float) -> Column:
    """numerator / denominator where the denominator is positive, else a constant."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator)).otherwise(
        F.lit(otherwise)
    )


def deviation_percent(actual: Column, predicted: Column) -> Column:
    return F.round(F.try_divide(F.abs(actual - predicted), predicted) * 100, 2)


def ladder(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose threshold is exceeded; null falls to ``otherwise``."""
    out = F
    for threshold, label in steps:
        out = out.when(value > threshold, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def json_object(**fields: Column) -> Column:
    """JSON object that keeps null members."""
    members = [value.alias(name) for name, value in fields.items()]
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def alert_id(prefix: str, key: Column, time: Column) -> Column:
    """Deterministic id, so that a replay overwrites instead of duplicating."""
    return F.concat(F.lit(prefix), key, F.lit("_"), F.unix_seconds(time).cast("string"))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to timestamp, null when it does not parse."""
    return F.try_to_timestamp(text)


def iso_utc(time: Column) -> Column:
    """ISO-8601 with a fraction only when there is one."""
    whole = F.date_format(time, ISO + "'Z'")
    fraction = F.date_format(time, ISO + ".SSSSSS'Z'")
    return F.when(F.unix_micros(time) % 1_000_000 == 0, whole).otherwise(fraction)


def severity_class(severity: Column) -> Column:
    """Three display classes; unknown and null count as medium."""
    low = F.lower(severity)
    return (
        F.when(low.isin("critical", "high"), "high").when(low == "low", "low").otherwise("medium")
    )


def kilobytes(size: Column) -> Column:
    return F.round(size / 1024, 2)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
